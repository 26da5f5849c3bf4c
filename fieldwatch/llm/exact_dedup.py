"""Operator 6: exact deduplication by skew-safe combining, native DataFrame code.

Two texts are equal when they are identical after every character of
``[\\x20\\x09-\\x0D]`` is deleted. Of equal texts the row with the most code
points in its original text stays, then the one with the smallest id.

1. Deduplicate locally: rows are grouped by (digest, salt, whole normalised
   text) with a salt taken from the task that read them, so the map-side half of
   the aggregation leaves one row per content and task, however often it occurs.
2. Merge the salted digest groups: the exchange deals those rows by (digest,
   salt, content), so a content that fills a third of the table meets in
   ``salts`` places, with at most one row from each task.
3. Combine the salt winners globally by (digest, whole normalised text).

The grouping key holds the full content at each stage, so equal digests alone
never merge texts. Rows then find their group by digest; should two contents
ever share a SHA-256 digest, the query fails with that message instead of
mixing them.

Cases: a null text counts as empty; all empty and white-space texts are one
group; a null id loses ties (ids are compared with nulls last) and may only be
the keeper of a group without other ids or by its length; rows that repeat an
id and a text count in ``group_size`` each, and one of them stays; an empty
table gives no rows; other columns are carried by ``drop_duplicates`` untouched,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.llm.common import SPACES, free_name, materialise, text_of

SALTS = 16


def normalised(text):
    """The text without white space."""
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return (docs.select(F.col(id_col).alias("id"), F.char_length(text).alias("size"), normalised(text).alias("norm"))
            .withColumn("sha", F.sha2(F.col("norm"), 256)))


def _groups(rows: DataFrame, salts: int) -> DataFrame:
    """One row per content: digest, keeper's id and size, number of rows."""
    order = F.struct((-F.col("size")).alias("minus"), F.col("id").isNull().alias("none"), F.col("id").alias("id"))
    salted = (rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
              .groupBy("sha", "salt", "norm").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n")))
    combined = salted.groupBy("sha", "norm").agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    per_digest = combined.groupBy("sha").agg(F.count(F.lit(1)).alias("contents"), F.min("best").alias("best"),
                                             F.sum("n").alias("n"))
    clash = F.raise_error(F.concat(F.lit("two contents share the digest "), F.col("sha")))
    return per_digest.select(
        F.when(F.col("contents") > 1, clash).otherwise(F.col("sha")).alias("sha"),
        F.col("best.id").alias("keep_id"), (-F.col("best.minus")).alias("keep_size"), F.col("n").alias("group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``, dropped ones too: the id, ``keep_id``,
    ``group_size``, ``kept`` and ``text_sha256`` of the normalised text."""
    rows = _digests(docs, id_col, text_col)
    groups = materialise(_groups(rows, salts), "exact-groups")
    # both sides are plain exchanges, so a digest with a third of the rows is split
    found = rows.select("id", "size", "sha").join(groups, "sha")
    best = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("size") == F.col("keep_size"))
    # one key of both, so that the join above it is free to split a digest
    same = Window.partitionBy(F.concat_ws("/", "sha", F.col("id").cast("string"))).orderBy(F.desc("size"))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size",
                        (best & (F.row_number().over(same) == 1)).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = materialise(_groups(_digests(docs, id_col, text_col), salts), "exact-groups")
    sha, kid, size = keys = [free_name(docs, f"_{n}") for n in ("sha", "kid", "size")]
    # a null id as a value of its own: plain equalities, one partitioning for both steps
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("none"))
    keep = groups.select(F.col("sha").alias(sha), name("keep_id").alias(kid), F.col("keep_size").alias(size))
    tagged = docs.withColumns({sha: F.sha2(normalised(text_of(text_col)), 256), kid: name(id_col),
                               size: F.char_length(text_of(text_col))})
    hits = tagged.join(keep, keys, "left_semi")
    # rows that repeat an id and a text: one stays (partitioned like the join, so no
    # further exchange of the texts)
    return hits.dropDuplicates(keys).select(*docs.columns)
