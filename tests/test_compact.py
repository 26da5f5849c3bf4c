"""Document tables with merged days: no row lost or doubled at any step, few files, pruned scans."""

import os

import pytest
from pyspark.sql import functions as F

from fieldwatch.config import DAY_MS
from fieldwatch.sinks import compact as C


def write(spark, path, n, rows=300):
    """A batch of documents over three days, in many small files."""
    df = spark.range(n * rows, (n + 1) * rows, 1, 12).select(
        F.col("id"), F.timestamp_millis(F.col("id") % 3 * DAY_MS + F.col("id") * 1000 + n * 3 * DAY_MS).alias("created_at"))
    (df.withColumn("batch_id", F.lit(n)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def parquet_files(folder):
    return [f"{d}/{f}" for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")]


def test_compaction(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    for n in range(6):
        write(spark, path, n)
    assert C.compact(spark, path, "s1") == 4 * 300 and C.compact(spark, path, "s1b") == 0
    assert sorted(os.listdir(tmp_path)) == ["docs", "docs-claimed", "docs-merged"]
    assert ids(C.scan(spark, path)) == list(range(1800))
    days = [x for x in os.listdir(f"{path}-merged/run=s1") if x.startswith("day=")]
    assert len(parquet_files(f"{path}-merged")) == len(days)  # one file a day instead of twelve a batch
    write(spark, path, 5)  # a replay of the newest batch
    for n in range(6, 9):
        write(spark, path, n)
    # a run that breaks off after its write: the claim is read, the run is not
    monkeypatch.setattr(C.storage, "delete", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        C.compact(spark, path, "s2")
    monkeypatch.undo()
    assert os.path.isdir(f"{path}-claimed/s2") and os.path.isdir(f"{path}-merged/run=s2")
    assert ids(C.scan(spark, path)) == list(range(2700))
    assert C.compact(spark, path, "s3") == 3 * 300 and os.listdir(f"{path}-claimed") == []
    assert ids(C.scan(spark, path)) == list(range(2700))
    start, end = 4 * DAY_MS + 5000, 7 * DAY_MS
    some = C.scan(spark, path, start, end)
    whole = C.scan(spark, path)
    assert ids(some) == ids(whole.filter((F.unix_millis("created_at") >= start) & (F.unix_millis("created_at") < end)))
    plan = some._jdf.queryExecution().executedPlan().toString()
    pruned = [x for x in plan.split("PartitionFilters: ")[1:] if "day" in x.split("PushedFilters")[0]]
    assert pruned and f">= {start // DAY_MS}" in pruned[0] and f"<= {(end - 1) // DAY_MS}" in pruned[0]
    last = 26 * DAY_MS
    assert ids(C.recent_documents(spark, path, last, 24)) == ids(
        whole.filter(F.unix_millis("created_at") >= last - DAY_MS))


def test_empty(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(0).withColumn("created_at", F.current_timestamp()).write.parquet(path)
    assert C.compact(spark, path, "s") == 0 and C.scan(spark, path).count() == 0
