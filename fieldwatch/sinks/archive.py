"""Archive jobs (N7, N8) and the scans they start from.

The reference concatenates all raw alert logs into one gzip file and moves raw
Parquet files to object storage, deleting the inputs even when the upload
failed. Here a run first *claims* the finished inputs: it moves them, whole batch
folders at a time, to a folder beside the live one (``<folder>-claimed``). The
archive is written from the claimed inputs in parallel, read back and counted,
and only then is the claimed folder deleted, in one operation. A run that fails
leaves its claim, which the next run takes up. Writers go on undisturbed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldwatch.schemas import RAW_RECORD
from fieldwatch.sinks import storage


def alert_log_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Raw alert log lines with their file and a position that orders the
    lines of a file (split start, then row order inside the split)."""
    df = spark.read.option("recursiveFileLookup", "true").text(folder)
    return df.select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("pos"))


def raw_telemetry_scan(spark: SparkSession, folder: str, schema: StructType = RAW_RECORD) -> DataFrame:
    """Raw gateway records, with an explicit schema."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)


def claim(spark: SparkSession, folder: str, stamp: str) -> str | None:
    """Move the finished inputs of ``folder`` aside; the folder of all claims, or
    None if there is nothing to archive. A batch folder is finished once its
    ``_SUCCESS`` file stands; other files and folders appear only when committed."""
    claims = f"{folder.rstrip('/')}-claimed"
    for path, name, is_folder in storage.children(spark, folder):
        if is_folder and name.startswith("batch_id=") and not storage.exists(spark, f"{path}/_SUCCESS"):
            continue
        storage.move(spark, path, f"{claims}/{stamp}")
    return claims if any(True for _ in storage.children(spark, claims)) else None


def archive_alert_logs(spark: SparkSession, log_folder: str, archive_folder: str, stamp: str,
                       delete_inputs: bool = True) -> int:
    """Sorted concatenation of the raw logs, gzip-compressed, under
    ``archive_folder/alerts_<stamp>``; inputs are deleted only after the archive
    has been read back with the same line count. Returns the line count."""
    claims = claim(spark, log_folder, stamp)
    if claims is None:
        return 0
    logs = alert_log_scan(spark, claims)
    n_in = logs.count()
    target = f"{archive_folder.rstrip('/')}/alerts_{stamp}"
    (logs.repartitionByRange("file", "block", "pos").sortWithinPartitions("file", "block", "pos")
     .select("value").write.mode("overwrite").option("compression", "gzip").text(target))
    n_out = spark.read.text(target).count()
    if n_out != n_in:
        raise RuntimeError(f"alert archive has {n_out} lines, inputs {n_in}; inputs kept in {claims}")
    if delete_inputs:
        storage.delete(spark, claims)
    return n_in


def archive_raw_telemetry(spark: SparkSession, raw_folder: str, archive_folder: str, stamp: str,
                          schema: StructType = RAW_RECORD, delete_inputs: bool = True) -> int:
    """Raw records compacted into a day-partitioned Parquet archive under
    ``archive_folder/run=<stamp>``; inputs deleted after a verified count. Rows are
    rebalanced by day: small days share a task and have a file each, a large day has
    files of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` of shuffled data."""
    claims = claim(spark, raw_folder, stamp)
    if claims is None:
        return 0
    raw = raw_telemetry_scan(spark, claims, schema)
    n_in = raw.count()
    target = f"{archive_folder.rstrip('/')}/run={stamp}"
    out = raw.withColumn("day", F.to_date(F.timestamp_millis(F.col("gateway_ts"))))
    out.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(target)
    n_out = spark.read.parquet(target).count()
    if n_out != n_in:
        raise RuntimeError(f"telemetry archive short: {n_out} < {n_in}; inputs kept in {claims}")
    if delete_inputs:
        storage.delete(spark, claims)
    return n_in
