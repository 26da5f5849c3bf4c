"""Document tables with a past (S8, N1, N2): small batch folders merged by day.

A streaming job writes ``<path>/batch_id=<n>``, small files for ever. ``compact`` takes
all but the newest batches away (into ``<path>-claimed/<stamp>``, one rename each), writes
them as ``<path>-merged/run=<stamp>/day=<n>`` in files of about
``spark.sql.adaptive.advisoryPartitionSizeInBytes``, each in order of time, verifies
the count and deletes the claim. A run is read only once its claim is gone, and a claim
as long as it is there, so rows count once at every step, a failed run included; the
next call finishes it.

``scan`` reads the table with its past; of the merged part only the days asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.config import DAY_MS, LATENCY_LOOKBACK_HOURS
from fieldwatch.sinks import storage

#: batches that stay: the newest one may be written again by a replay
KEEP = 2


def _folders(path: str) -> tuple[str, str, str]:
    path = path.rstrip("/")
    return path, f"{path}-claimed", f"{path}-merged"


def _names(spark: SparkSession, folder: str) -> list[str]:
    return sorted(name for _, name, is_folder in storage.children(spark, folder) if is_folder)


def _day(ts: str):
    """Days since the epoch, whatever the session's time zone."""
    return F.floor(F.unix_millis(F.col(ts)) / F.lit(DAY_MS)).cast("int")


def _batches(spark: SparkSession, folder: str) -> DataFrame | None:
    found = [f"{folder}/{n}" for n in _names(spark, folder) if n.startswith("batch_id=")]
    return spark.read.option("basePath", folder).parquet(*found) if found else None


def compact(spark: SparkSession, path: str, stamp: str, keep: int = KEEP, ts: str = "created_at") -> int:
    """Merge the batches before the newest ``keep``; the number of rows merged."""
    live, claimed, merged = _folders(path)
    numbers = sorted(int(n[9:]) for n in _names(spark, live) if n.startswith("batch_id="))
    for n in numbers[:max(len(numbers) - keep, 0)]:
        storage.move(spark, f"{live}/batch_id={n}", f"{claimed}/{stamp}")
    rows = 0
    for claim in _names(spark, claimed):
        docs = _batches(spark, f"{claimed}/{claim}")
        if docs is None:
            continue
        n_in, target = docs.count(), f"{merged}/run={claim}"
        (docs.withColumn("day", _day(ts)).hint("rebalance", "day").sortWithinPartitions("day", ts)
         .write.mode("overwrite").partitionBy("day").parquet(target))
        n_out = spark.read.schema(docs.schema).parquet(target).count()
        if n_out != n_in:
            raise RuntimeError(f"{n_out} rows of {n_in} merged; inputs kept in {claimed}/{claim}")
        storage.delete(spark, f"{claimed}/{claim}")
        rows += n_in
    return rows


def scan(spark: SparkSession, path: str, start_ms: int | None = None, end_ms: int | None = None,
         ts: str = "created_at") -> DataFrame:
    """The documents of the table and its past, with ``ts`` in [start, end) (epoch ms)."""
    live, claimed, merged = _folders(path)
    claims = _names(spark, claimed)
    parts = [_batches(spark, f) for f in [live, *(f"{claimed}/{c}" for c in claims)]]
    runs = [f"{merged}/{n}" for n in _names(spark, merged) if n[4:] not in claims]
    if runs:
        past = spark.read.option("basePath", merged).parquet(*runs)
        if start_ms is not None:
            past = past.filter(F.col("day") >= start_ms // DAY_MS)
        if end_ms is not None:
            past = past.filter(F.col("day") <= (end_ms - 1) // DAY_MS)
        parts.append(past.drop("run", "day"))
    # a table without batch folders is read as it is
    parts = [p for p in parts if p is not None] or [spark.read.parquet(live)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if start_ms is not None:
        out = out.filter(F.col(ts) >= F.timestamp_millis(F.lit(start_ms)))
    return out if end_ms is None else out.filter(F.col(ts) < F.timestamp_millis(F.lit(end_ms)))


def recent_documents(spark: SparkSession, path: str, as_of_ms: int, hours: int = LATENCY_LOOKBACK_HOURS,
                     ts: str = "created_at") -> DataFrame:
    """S8 over a table with its past: only the folders of the last ``hours`` are read."""
    return scan(spark, path, as_of_ms - hours * 3_600_000, None, ts)
