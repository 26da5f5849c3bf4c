"""Exact percentiles (linear interpolation) that scale with skewed groups.

Spark's ``percentile``/``median`` aggregate keeps a value->count map per group;
a group holding a third of all rows would put all its distinct values in one
task's memory. Here, at every size:

1. rows are first combined map-side to (group, value, count), so repeated values
   (clamped metrics, millisecond legs) cost one row however often they occur;
2. that table is range-partitioned on (group, value): a hot group is spread over
   many partitions, and rows are distinct, so no tie can pile up in one;
3. counts per (partition, group) give each partition's rank offset, a running sum
   inside the partition the global ranks of every value;
4. one aggregation picks the values at the two ranks around each percentile.

This is the definition used by numpy's default, Spark's ``percentile`` and
DuckDB's ``quantile_cont``.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.operators.ordered import PID, ordered_layout


def _pct_name(p: float) -> str:
    s = f"{p * 100:g}".replace(".", "_")
    return f"p{s}"


def value_counts(df: DataFrame, groups: list[str], value: str, count: str = "_n") -> DataFrame:
    """(groups, value, count) of the non-NULL values, combined map-side."""
    v = df.select(*groups, F.col(value).cast("double").alias(value)).filter(F.col(value).isNotNull())
    return v.groupBy(*groups, value).agg(F.count(F.lit(1)).alias(count))


def weighted_percentiles(counts: DataFrame, groups: list[str], value: str, percentiles, names=None,
                         count: str = "_n", num_partitions: int | None = None) -> DataFrame:
    """One row per group (NULL groups included) with a column per percentile, for
    rows ``(groups, value, count)``; a value may stand in several rows of a group."""
    names = list(names) if names else [_pct_name(p) for p in percentiles]
    merged = counts.groupBy(*groups, F.col(value).alias("_v")).agg(F.sum(count).alias("_n"))
    laid = ordered_layout(merged, groups, ["_v"], num_partitions)
    runs = laid.groupBy(PID, *groups).agg(F.sum("_n").alias("_cnt"))
    whole = Window.partitionBy(*groups)
    runs = runs.select(F.col(PID).alias("_rp"), *[F.col(g).alias(f"_r_{g}") for g in groups],
                       (F.sum("_cnt").over(whole.orderBy(PID)) - F.col("_cnt")).alias("_offset"),
                       F.sum("_cnt").over(whole).alias("_total"))
    inside = Window.partitionBy(PID, *groups).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    same = [F.col(PID) == F.col("_rp"), *[F.col(g).eqNullSafe(F.col(f"_r_{g}")) for g in groups]]
    ranked = (laid.withColumn("_end", F.sum("_n").over(inside))
              .join(runs, functools.reduce(operator.and_, same))
              .withColumn("_stop", F.col("_offset") + F.col("_end"))
              .withColumn("_start", F.col("_stop") - F.col("_n")))
    aggs = []
    for k, p in enumerate(percentiles):
        at = F.lit(float(p)) * (F.col("_total") - 1)
        for side, rank in (("a", F.floor(at)), ("b", F.ceil(at))):
            aggs.append(F.max(F.when((rank >= F.col("_start")) & (rank < F.col("_stop")), F.col("_v")))
                        .alias(f"_{side}{k}"))
    picked = ranked.groupBy(*groups).agg(F.max("_total").alias("_total"), *aggs)
    frac = [F.lit(float(p)) * (F.col("_total") - 1) for p in percentiles]
    return picked.select(*groups, *[
        (F.col(f"_a{k}") + (f - F.floor(f)) * (F.col(f"_b{k}") - F.col(f"_a{k}"))).alias(n)
        for k, (f, n) in enumerate(zip(frac, names))])


def exact_percentiles(df: DataFrame, groups: list[str], value: str, percentiles, names=None,
                      num_partitions: int | None = None) -> DataFrame:
    """One row per group with a column per percentile (NULL values ignored)."""
    return weighted_percentiles(value_counts(df, groups, value), groups, value, percentiles, names,
                                num_partitions=num_partitions)


def approx_median(df: DataFrame, groups: list[str], value: str, name: str = "median", accuracy: int = 10_000
                  ) -> DataFrame:
    """A4, approximate: a mergeable rank sketch per group (relative rank error
    1 / ``accuracy``) instead of exact ranks: one aggregation, no layout."""
    return df.groupBy(*groups).agg(
        F.percentile_approx(F.col(value).cast("double"), 0.5, accuracy).alias(name))
