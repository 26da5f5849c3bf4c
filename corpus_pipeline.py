"""The corpus pipeline: quality rules, exact dedup, SimHash near-dedup, substring
dedup, packing, each stage one of the training-data operators.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame``. Its result is
written as Parquet and read back as the next stage's ``docs``, so a lost executor
costs a stage at most its own work. All stages but the last return the columns of
their input, further columns included, whatever their names; the last returns the
pieces of the packed sequences.

Cases, stage by stage: a null or empty text has no words, so quality rules drop it;
should one reach a later stage it counts as empty, equal to other empty texts (exact
dedup), of fingerprint zero (SimHash dedup), unchanged (substring dedup), a document
of its closing token alone (packing). A null id loses every tie and counts as larger
than all others. Of rows that repeat an id and a text, exact dedup keeps one; rows
that repeat an id with other texts are documents of their own. A very long text is
treated whole. An empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldwatch.llm.common import documents, materialise, table
from fieldwatch.llm.exact_dedup import drop_duplicates
from fieldwatch.llm.packing import pack_documents
from fieldwatch.llm.quality_rules import keep_good
from fieldwatch.llm.simhash_dedup import drop_near_duplicates
from fieldwatch.llm.substring_dedup import remove_windows


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest keep."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_duplicates(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the word windows that a smaller id has."""
    return remove_windows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences that hold all tokens of the documents."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("simhash_dedup", simhash_dedup),
          ("substring_dedup", substring_dedup), ("packing", packing)]

#: neither an isolation forest nor SimHash over XXH64 can be said in SQL; tests/llm
#: holds the pipeline to brute-force versions of its stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
