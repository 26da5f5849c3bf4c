"""Pipeline evaluation: recent-document scan (S8), bad-record skip (P20),
latency legs (P21), latency statistics (A2), counter rates (W5), rate summary
(A3), and the per-index union (U2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.config import LATENCY_LOOKBACK_HOURS, LATENCY_PERCENTILES
from fieldwatch.operators.quantiles import value_counts, weighted_percentiles
from fieldwatch.session import checkpoint_dir

LEGS = {
    # leg name -> (later stamp, earlier stamp), all epoch ms
    "lat_gw_kafka": ("ts_kafka_ingest", "gateway_ts"),
    "lat_kafka_spark": ("ts_before_es", "ts_kafka_ingest"),
    "lat_spark_es": ("created_ms", "ts_before_es"),
    "lat_e2e": ("created_ms", "gateway_ts"),
}


def recent(docs: DataFrame, as_of, hours: int = LATENCY_LOOKBACK_HOURS, ts: str = "created_at") -> DataFrame:
    """Documents created within ``hours`` before ``as_of`` (a timestamp
    literal or column); the predicate reaches the Parquet scan."""
    as_of_c = F.lit(as_of).cast("timestamp") if not hasattr(as_of, "_jc") else as_of
    return docs.filter(F.col(ts) >= as_of_c - F.expr(f"INTERVAL {int(hours)} HOURS"))


def latency_rows(docs: DataFrame) -> DataFrame:
    """P20: keep documents whose four stamps are all present and readable."""
    return (docs.withColumn("gateway_ts", (F.col("gateway_ts")).try_cast("long"))
            .withColumn("ts_kafka_ingest", (F.col("ts_kafka_ingest")).try_cast("long"))
            .withColumn("ts_before_es", (F.col("ts_before_es")).try_cast("long"))
            .withColumn("created_at", F.col("created_at").cast("timestamp"))
            .dropna(subset=["gateway_ts", "ts_kafka_ingest", "ts_before_es", "created_at"]))


def latency_legs(rows: DataFrame) -> DataFrame:
    """The four legs in seconds."""
    r = rows.withColumn("created_ms", F.unix_millis(F.col("created_at")))
    return r.select("*", *[((F.col(a) - F.col(b)) / F.lit(1000.0)).alias(n) for n, (a, b) in LEGS.items()]) \
        .drop("created_ms")


def latency_stats(legs: DataFrame, percentiles=LATENCY_PERCENTILES, num_partitions=None) -> DataFrame:
    """A2: per index and leg: count, mean, P50/P90/P95 (linear interpolation),
    min, max. Legs are unpivoted with ``stack`` and combined map-side to
    (index, leg, seconds, count); all seven statistics follow from that table."""
    names = list(LEGS)
    stack = "stack({n}, {args}) as (leg, seconds)".format(
        n=len(names), args=", ".join(f"'{n}', {n}" for n in names))
    checkpoint_dir(legs.sparkSession)
    counts = value_counts(legs.selectExpr("index", stack), ["index", "leg"], "seconds").checkpoint(eager=True)
    basic = counts.groupBy("index", "leg").agg(
        F.sum("_n").alias("count"), (F.sum(F.col("seconds") * F.col("_n")) / F.sum("_n")).alias("avg"),
        F.min("seconds").alias("min"), F.max("seconds").alias("max"))
    pct_names = [f"p{int(round(p * 100))}" for p in percentiles]
    pct = weighted_percentiles(counts, ["index", "leg"], "seconds", percentiles, pct_names,
                               num_partitions=num_partitions)
    pct = pct.withColumnsRenamed({"index": "_i", "leg": "_l"})
    same = F.col("index").eqNullSafe(F.col("_i")) & F.col("leg").eqNullSafe(F.col("_l"))
    return basic.join(pct, same).select("index", "leg", "count", "avg", *pct_names, "min", "max")


def counter_rate(samples: DataFrame) -> DataFrame:
    """Per index, docs/s between consecutive counter samples:
    delta(total) / (delta(time_ms) / 1000), 0 when delta(time_ms) <= 0; the
    first sample has no delta. The window runs over the sample table (one row
    per index and sampling instant), not over documents."""
    w = Window.partitionBy("index").orderBy("sample_ts")
    d_docs = F.col("total") - F.lag("total").over(w)
    d_ms = F.col("time_ms") - F.lag("time_ms").over(w)
    out = samples.select("index", "sample_ts", d_docs.alias("docs"), d_ms.alias("time_ms"))
    out = out.filter(F.col("docs").isNotNull())
    rate = F.when(F.col("time_ms") > 0, F.col("docs") / (F.col("time_ms") / F.lit(1000.0))).otherwise(F.lit(0.0))
    return out.withColumn("docs_per_sec", rate)


def rate_summary(rates: DataFrame) -> DataFrame:
    """A3: mean / min / max docs/s per index."""
    return rates.groupBy("index").agg(F.avg("docs_per_sec").alias("avg_rate"), F.min("docs_per_sec").alias("min_rate"),
                                      F.max("docs_per_sec").alias("max_rate"))


STAMPS = ["gateway_ts", "ts_kafka_ingest", "ts_before_es", "created_at"]


def union_indices(parts: dict) -> DataFrame:
    """The four stamps of every index's documents with an ``index`` literal.
    Indices have different document schemas; only the stamps are common."""
    out = None
    for name, df in parts.items():
        d = df.select(*STAMPS).withColumn("index", F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out
