"""Operator 1: token counts by a map-side two-tier lookup.

Tier one is a table ``pre-token -> number of tokens`` of the corpus's frequent
pre-tokens. It has at most ``frequent`` entries (a fixed bound, whatever the
size of the corpus) and is broadcast. Tier two is a cache in each Python worker
that encodes a miss once and is emptied down to tier one when it is full. Every
document is then counted in the task that reads it: no pre-token is shuffled.

The table comes from one pass over all documents in which each task keeps a
bounded summary (the ``summary`` most frequent pre-tokens seen so far, pruned
after each batch); only these summaries are merged. The table affects speed
alone: a pre-token outside it is encoded by the library, so counts are exact.

Cases: a null text counts as empty (0 bytes, 0 tokens); a null or repeated
doc_id passes through, one row out per row in; an empty table gives no rows;
other columns are not read, so their names cannot clash. A text is split in one
go, so memory follows the longest text.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import worker_store
from fieldwatch.llm.tokenizer import Pretokens, load_tokenizer, tokenizer_text

FREQUENT = 65_536
SUMMARY = 16_384
WORKER_CACHE = 400_000
LONGEST_CACHED = 64


class TokenLengths(dict):
    """pre-token -> token count. Starts as the frequent table; misses are encoded
    by the library and kept until ``limit`` entries, then dropped together."""

    def __init__(self, frequent: dict, tokenizer, limit: int):
        super().__init__(frequent)
        self.frequent, self.tokenizer, self.limit = frequent, tokenizer, limit

    def __missing__(self, pretoken: str) -> int:
        n = len(self.tokenizer.encode(pretoken, add_special_tokens=False).ids)
        if len(pretoken) <= LONGEST_CACHED:
            if len(self) >= self.limit:
                self.clear()
                self.update(self.frequent)
            self[pretoken] = n
        return n


def _summaries(spec: str, summary: int):
    """Task function: its most frequent pre-tokens with their counts."""

    def run(batches):
        split = Pretokens(spec).split
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(split(text) or ())
                if len(seen) > 16 * summary:
                    seen = Counter(dict(seen.most_common(4 * summary)))
        top = [(t, n) for t, n in seen.most_common(summary) if n > 1 and len(t) <= LONGEST_CACHED]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in top], pa.string()),
                                          pa.array([n for _, n in top], pa.int64())], ["pretoken", "n"])

    return run


def _lengths(spec: str):
    """Task function: token counts of the table's pre-tokens."""

    def run(batches):
        tokenizer = load_tokenizer(spec)
        for batch in batches:
            words = batch.column(0)
            encoded = tokenizer.encode_batch(words.to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays([words, pa.array([len(e.ids) for e in encoded], pa.int32())],
                                             ["pretoken", "length"])

    return run


def frequent_lengths(docs: DataFrame, spec: str, text_col: str, frequent: int = FREQUENT,
                     summary: int = SUMMARY) -> dict[str, int]:
    """The bounded table: at most ``frequent`` pre-tokens with their token counts."""
    texts = docs.select(F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    summaries = texts.mapInArrow(_summaries(spec, summary), "pretoken string, n long")
    top = (summaries.groupBy("pretoken").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "pretoken").limit(frequent).select("pretoken"))
    rows = top.mapInArrow(_lengths(spec), "pretoken string, length int").toArrow()
    return dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()))


def _counts(spec: str, frequent, name: str, cache: int):
    def run(batches):
        store = worker_store("token lengths")
        if store.get("name") != name:  # another corpus or tokenizer: start again from its table
            store.clear()
            store.update(name=name, lengths=TokenLengths(frequent.value, load_tokenizer(spec), cache))
        lengths, tokenizer, split = store["lengths"].__getitem__, load_tokenizer(spec), Pretokens(spec).split

        def count(text: str | None) -> int:
            if not text:
                return 0
            pretokens = split(text)
            if pretokens is None:
                return len(tokenizer.encode(text, add_special_tokens=False).ids)
            return sum(map(lengths, pretokens))

        for batch in batches:
            text = batch.column(1)
            n = pa.array([count(t) for t in text.to_pylist()], pa.int64())
            size = pc.fill_null(pc.cast(pc.binary_length(text), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), size, n], ["id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, frequent: int = FREQUENT, cache: int = WORKER_CACHE) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``over_limit`` (more than ``limit`` tokens)."""
    spark = docs.sparkSession
    spec = tokenizer_text(tokenizer_path)
    lengths = spark.sparkContext.broadcast(frequent_lengths(docs, spec, text_col, frequent))
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _counts(spec, lengths, f"{id(lengths)}:{lengths._jbroadcast.id()}", cache),
        f"id {id_type}, n_bytes long, n_tokens long")
    return rows.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                       (F.col("n_tokens") > limit).alias("over_limit"))
