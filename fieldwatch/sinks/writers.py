"""Sinks (N1-N13): document tables, topic writers, raw logs and archives.

Every writer is distributed (no ``collect``). Micro-batch writers to folders are
idempotent per ``batch_id``: a replayed batch overwrites its own partition
instead of appending duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldwatch.functions.jsonio import rows_to_json
from fieldwatch.functions.scalars import conform
from fieldwatch.sinks.storage import exists
from fieldwatch.streaming.sources import topic_file


def stamp_before_write(df: DataFrame) -> DataFrame:
    """P8 + P9: ``ts_before_es`` (epoch ms just before the write) and
    ``created_at`` (the store's ingest stamp), both from the batch's clock."""
    return (df.withColumn("ts_before_es", F.unix_millis(F.current_timestamp()))
            .withColumn("created_at", F.current_timestamp()))


def ensure_table(spark: SparkSession, path: str, contract: StructType, partition_by: tuple = ()) -> None:
    """Create the target with its schema contract if it does not exist. An
    existing target is left as it is, readable or not; other errors are raised."""
    if exists(spark, path):
        return
    w = spark.createDataFrame([], contract).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_documents(df: DataFrame, path: str, contract: StructType, batch_id: int | None = None) -> None:
    """Conform to the index contract and write Parquet. With a
    ``batch_id`` the batch owns partition ``batch_id=<n>`` (dynamic overwrite),
    so a replay replaces rather than duplicates it."""
    out = conform(stamp_before_write(df), contract)
    w = out.write
    if batch_id is not None:
        out = out.withColumn("batch_id", F.lit(int(batch_id)))
        w = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id"))
    else:
        w = w.mode("append")
    w.parquet(path)


def write_topic(df: DataFrame, topic: str, *, kafka: str | None = None, folder: str | None = None,
                batch_id: int | None = None) -> None:
    """Key-less JSON ``value`` per row (NULL fields left out); to Kafka
    when a broker is given (at least once: a replayed batch is sent again), else
    as NDJSON text under ``folder/topic``, where a batch replaces itself."""
    values = rows_to_json(df)
    if kafka:
        values.write.format("kafka").option("kafka.bootstrap.servers", kafka).option("topic", topic).save()
        return
    target = f"{folder.rstrip('/')}/{topic_file(topic)}"
    if batch_id is not None:
        values = values.withColumn("batch_id", F.lit(int(batch_id)))
        (values.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").text(target))
    else:
        values.write.mode("append").text(target)


def write_raw_log(df: DataFrame, folder: str, bucket_seconds: int = 300, batch_id: int | None = None) -> None:
    """N4 + W6: the JSON of every parsed alert, before validation and dedup,
    in processing-time buckets of ``bucket_seconds`` (the reference rolls its
    log file every 300 s). A batch owns the folder ``batch_id=<n>`` with its
    buckets below, so a replay replaces it whatever the clock says by then."""
    bucket = (F.floor(F.unix_seconds(F.current_timestamp()) / bucket_seconds) * bucket_seconds).cast("long")
    lines = rows_to_json(df).withColumn("bucket", bucket)
    if batch_id is not None:
        (lines.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket")
         .text(f"{folder.rstrip('/')}/batch_id={int(batch_id)}"))
    else:
        lines.write.mode("append").partitionBy("bucket").text(folder)


def write_raw_telemetry(df: DataFrame, folder: str, json_copy: str | None = None, batch_id: int | None = None) -> None:
    """Raw gateway records as Parquet partitioned by day (optional JSON copy).
    A micro-batch owns the folder ``batch_id=<n>``, so a replay replaces it."""
    out = df.withColumn("day", F.to_date(F.timestamp_millis(F.col("gateway_ts"))))
    mode = "append" if batch_id is None else "overwrite"
    own = "" if batch_id is None else f"/batch_id={int(batch_id)}"
    out.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("day").parquet(f"{folder.rstrip('/')}{own}")
    if json_copy:
        (out.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("day")
         .json(f"{json_copy.rstrip('/')}{own}"))


def write_csv(df: DataFrame, path: str) -> None:
    """Result table as CSV with a header, in as many files as tasks."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_notifications(df: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Rendered notifications as a table."""
    if batch_id is not None:
        (df.withColumn("batch_id", F.lit(int(batch_id))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
    else:
        df.write.mode("append").parquet(path)
