"""The operators bound to the driver's tables, by their registered names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldwatch.llm.bpe_codec import codec_digests
from fieldwatch.llm.chat_format import format_examples, read_back
from fieldwatch.llm.collocations import collocations
from fieldwatch.llm.common import documents, table
from fieldwatch.llm.exact_dedup import exact_groups
from fieldwatch.llm.language_id import identify
from fieldwatch.llm.line_dedup import line_report
from fieldwatch.llm.packing import pack_documents
from fieldwatch.llm.quality_rules import STATS, judge
from fieldwatch.llm.simhash_dedup import simhash_components
from fieldwatch.llm.spelling_variants import variants, word_counts
from fieldwatch.llm.substring_dedup import window_report
from fieldwatch.llm.suffix_dedup import repeat_digests
from fieldwatch.llm.token_counts import token_counts


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text."""
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every text that repeat a document with a smaller id."""
    return window_report(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every text and the verdict on it."""
    return judge(documents(spark, sf_dir), table(spark, sf_dir, "labels")).select(
        "doc_id", *STATS, "base_failed", "kept", "score")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_components(documents(spark, sf_dir))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, keeper and digest of every document."""
    return exact_groups(documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return identify(documents(spark, sf_dir))


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of what they decode to."""
    return codec_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every text that strings of 200 bytes repeat."""
    return repeat_digests(documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of lines of every text that have occurred before."""
    return line_report(documents(spark, sf_dir))


#: a conversation whose texts are made of the template's own control strings
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the training examples of every conversation hold, read back from them."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
                                conversations.schema)
    return read_back(format_examples(conversations.unionByName(own)))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every frequent word."""
    return variants(word_counts(documents(spark, sf_dir)))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    return collocations(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_substring_dedup, op3_packing, op4_quality_rules, op5_simhash_dedup, op6_exact_dedup,
    op7_language_id, op8_bpe_codec, op9_suffix_dedup, op10_line_dedup, op11_chat_format, op12_spelling_variants,
    op13_collocations)}
