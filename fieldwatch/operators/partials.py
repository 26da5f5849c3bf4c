"""Panels from partial aggregates, kept batch by batch.

A micro-batch leaves, beside its documents, how often each value of each panel metric
occurred per farm and gateway (medians need the values), how many documents there
were, and how many alerts each gateway had in each state, all by time bucket. Counts
of equal keys add up, so partials of any batches, in any order, give exactly what the
raw documents give: a panel reads them instead, whatever the documents have grown to.
A table of versions of the same batch replaces itself, so replays count once.

Values repeat (clamped and rounded readings), so partials are far fewer than
documents; where they do not, there is one row a document and metric, as the panel's
own first step would make.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.config import DAY_MS, STATE_CRITICAL, STATE_OFFLINE
from fieldwatch.operators import dashboard as DB

#: the metrics of the saved panels
METRICS = ("light_level_avg", "soil_moisture_avg", "humidity_avg")
RECORDS = "records"


def _bucket(bucket_ms: int):
    return (F.floor(F.col("gateway_ts") / F.lit(bucket_ms)) * F.lit(bucket_ms)).cast("long").alias("bucket")


def telemetry_partials(docs: DataFrame, metrics: tuple = METRICS, bucket_ms: int = DAY_MS) -> DataFrame:
    """(bucket, farm_id, gateway_id, metric, value, n) of documents with farm and gateway:
    value counts of each metric, and the number of documents (metric ``records``, no
    value). One pass; equal rows are combined before the shuffle."""
    each = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics],
                   F.struct(F.lit(RECORDS).alias("metric"), F.lit(None).cast("double").alias("value")))
    return (docs.filter(F.col("farm_id").isNotNull() & F.col("gateway_id").isNotNull())
            .select(_bucket(bucket_ms), "farm_id", "gateway_id", F.inline(each))
            .filter(F.col("value").isNotNull() | (F.col("metric") == RECORDS))
            .groupBy("bucket", "farm_id", "gateway_id", "metric", "value").agg(F.count(F.lit(1)).alias("n")))


def alert_partials(alerts: DataFrame, bucket_ms: int = DAY_MS) -> DataFrame:
    """(bucket, gateway_id, state, n) of alerts with a gateway."""
    return (alerts.filter(F.col("gateway_id").isNotNull())
            .groupBy(_bucket(bucket_ms), "gateway_id", "state").agg(F.count(F.lit(1)).alias("n")))


def write_partials(partials: DataFrame, path: str, batch_id: int) -> None:
    """A batch's partials, in folders of batch and bucket; a replay replaces them."""
    (partials.withColumn("batch_id", F.lit(int(batch_id))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "bucket").parquet(path))


def read_partials(spark: SparkSession, path: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """The partials of all batches, of buckets that start in [start, end): only their folders
    are read."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.filter(F.col("bucket") >= start)
    return df if end is None else df.filter(F.col("bucket") < end)


def _base(partials: DataFrame, metric: str) -> DataFrame:
    own = partials.filter(F.col("metric") == metric)
    if metric == RECORDS:
        return own.groupBy("farm_id", "gateway_id").agg(F.sum("n").alias("_n"))
    return own.groupBy("farm_id", "gateway_id", F.col("value").alias("_v")).agg(F.sum("n").alias("_n"))


def median_by_farm_gateway(partials: DataFrame, metric: str, farm_size: int, gateway_size: int) -> DataFrame:
    """A4 + K1/K2 as ``dashboard.median_by_farm_gateway`` gives it."""
    out = DB.nested_top_of(DB._materialise(_base(partials, metric)), "farm_id", "gateway_id", farm_size, gateway_size)
    return out.select(F.col("outer_label").alias("farm"), F.col("inner_label").alias("gateway"),
                      F.col("value").alias(f"median_{metric}"))


def record_share(partials: DataFrame, farm_size: int, gateway_size: int) -> DataFrame:
    """A5 + K1/K2 as ``dashboard.record_share`` gives it."""
    return DB.shares(DB.nested_top_of(_base(partials, RECORDS), "farm_id", "gateway_id", farm_size, gateway_size, "count"))


def critical_by_gateway(partials: DataFrame, size: int) -> DataFrame:
    """A6 + K3 as ``dashboard.critical_by_gateway`` gives it."""
    hit = F.col("state").isin(STATE_OFFLINE, STATE_CRITICAL)
    per_gw = partials.groupBy("gateway_id").agg(
        F.sum("n").alias("value"), F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("hits"))
    return DB.alphabetical_hits(per_gw, size)
