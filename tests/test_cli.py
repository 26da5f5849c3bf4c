"""The job runner end to end: gateway, cleaning and telemetry jobs, then the
reports over the documents that these jobs wrote."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fieldwatch.config import ALERT_INDEX, RAW_ALERT_TOPIC, RAW_TELEMETRY_TOPIC, TELEMETRY_INDEX
from fieldwatch.operators.evaluation import LEGS
from fieldwatch.plans.pipeline import Pipeline
from fieldwatch.schemas import BRIDGE, PLACE, RAW_RECORD
from fieldwatch.streaming import run
from fieldwatch.streaming.sources import topic_file

SF = "/root/testdata/sf0.001"


def _dims(spark, root):
    place = lambda ids: spark.createDataFrame([(i, 1.0, 2.0) for i in ids], PLACE)
    place(["f"]).write.parquet(f"{root}/dims/farm")
    place(["g"]).write.parquet(f"{root}/dims/gateway")
    place(["a", "b"]).write.parquet(f"{root}/dims/device")
    spark.createDataFrame([("f", "g", "a"), ("f", "g", "b")], BRIDGE).write.parquet(f"{root}/dims/farm_gateway_device")


def _readings(root):
    os.makedirs(f"{root}/in")
    n = 0
    for k in range(6):
        with open(f"{root}/in/r{k}.json", "w") as f:
            for d, temp in (("a", 50.0 if k % 2 else 20.0), ("b", 30.0), ("stranger", 20.0)):
                f.write(json.dumps({"device_id": d, "device_ts": 1_700_000_000_000 + 10_000 * k, "device_ts_iso": "",
                                    "temperature": temp, "humidity": 50.0, "soil_moisture": 50.0,
                                    "light_level": 1000.0, "device_status": "OK"}) + "\n")
                n += 1
            if k == 0:
                f.write("not json\n")
        os.utime(f"{root}/in/r{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    return n


def test_jobs_then_latency_report(spark):
    root = tempfile.mkdtemp(prefix="fw-cli-")
    _dims(spark, root)
    n = _readings(root)
    common = ["--topics", f"{root}/topics", "--dims", f"{root}/dims", "--trigger", "availableNow",
              "--checkpoint", f"{root}/ckpt", "--max-per-trigger", "2"]
    assert run.main(["gateway", "--input", f"{root}/in", "--out", f"{root}/raw", "--out2", f"{root}/rejects",
                     "--cooldown-ms", "5000", "--threshold", "temperature,0,25", *common]) == 0
    alerts = spark.read.text(f"{root}/topics/{topic_file(RAW_ALERT_TOPIC)}").select(
        F.get_json_object("value", "$.device_id").alias("d"), F.get_json_object("value", "$.state").alias("s"))
    states = {(r.d, r.s) for r in alerts.collect()}
    assert ("b", "CRITICAL") in states  # 30 degrees is critical only by the given bounds
    assert not any(d == "stranger" for d, _ in states)
    assert spark.read.parquet(f"{root}/rejects").count() == n // 3 + 1  # the stranger's, and the bad line
    raw = spark.read.parquet(f"{root}/raw")
    assert raw.count() == 2 * n // 3 and set(RAW_RECORD.fieldNames()) <= set(raw.columns)
    assert spark.read.text(f"{root}/topics/{topic_file(RAW_TELEMETRY_TOPIC)}").count() > 0

    for job, index in (("telemetry", TELEMETRY_INDEX), ("alerts", ALERT_INDEX)):
        from fieldwatch.streaming import jobs as J

        waiting, J.await_all = J.await_all, lambda s: [q.awaitTermination() for q in s.streams.active]
        try:
            assert run.main([job, "--out", f"{root}/docs/{index}", "--out2", f"{root}/log", "--starting-offsets", "earliest",
                             *common]) == 0  # the jobs' own default is what comes after their start
        finally:
            J.await_all = waiting
    docs = {i: spark.read.parquet(f"{root}/docs/{i}") for i in (TELEMETRY_INDEX, ALERT_INDEX)}
    assert {"ts_kafka_ingest", "ts_before_es"} <= set(docs[ALERT_INDEX].columns)
    assert run.main(["latency-report", "--input", f"{root}/docs", "--out", f"{root}/lat",
                     "--out2", f"{root}/lat_rows"]) == 0
    rows = spark.read.option("header", True).csv(f"{root}/lat_rows")
    assert rows.count() == sum(d.count() for d in docs.values())
    assert set(LEGS) <= set(rows.columns)
    stats = spark.read.option("header", True).csv(f"{root}/lat")
    assert stats.count() == 2 * len(LEGS) and {"index", "leg", "p50", "p95"} <= set(stats.columns)
    assert {r["index"] for r in stats.collect()} == {TELEMETRY_INDEX, ALERT_INDEX}


def test_gateway_keeps_late_telemetry(spark):
    """With --late-telemetry every reading is published, open, or a row of that table."""
    root = tempfile.mkdtemp(prefix="fw-cli-")
    _dims(spark, root)
    _readings(root)
    late = {"device_id": "a", "device_ts": 1_700_000_000_000, "temperature": 20.0}  # behind 50 s of windows
    with open(f"{root}/in/r9.json", "w") as f:
        f.write(json.dumps(late) + "\n")
    os.utime(f"{root}/in/r9.json", (1_700_000_100, 1_700_000_100))
    assert run.main(["gateway", "--input", f"{root}/in", "--topics", f"{root}/topics", "--dims", f"{root}/dims",
                     "--trigger", "availableNow", "--checkpoint", f"{root}/ckpt", "--max-per-trigger", "2",
                     "--window-ms", "10000", "--late-telemetry", f"{root}/late"]) == 0
    rows = spark.read.parquet(f"{root}/late").collect()
    assert [(r.device_id, r.device_ts) for r in rows if r.device_ts is not None] == [("a", 1_700_000_000_000)]
    assert len(rows) == 2  # and the line that is no JSON, which no window takes
    messages = [json.loads(r.value) for r in spark.read.text(f"{root}/topics/{topic_file(RAW_TELEMETRY_TOPIC)}").collect()]
    published = {(m["device_id"], m["gateway_ts"]): m["count"] for m in messages}
    # the newest reading is 50 s after the first: windows that end 10 s or more before it are published
    assert published == {(d, 1_700_000_000_000 + 10_000 * k): 1 for d in "ab" for k in range(1, 5)}


def test_streaming_jobs_refuse_a_made_up_checkpoint_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return None if key == "spark.checkpoint.dir" else spark.conf.get(key, default)

    class Session:
        conf = Conf()

    class Args:
        checkpoint, job = None, "alerts"

    with pytest.raises(SystemExit):
        run._checkpoint(Session(), Args())


def test_speed_report(spark):
    p = Pipeline(spark, SF)
    root = tempfile.mkdtemp(prefix="fw-cli-")
    p.counter_samples.write.parquet(f"{root}/samples")
    assert run.main(["speed-report", "--input", f"{root}/samples", "--out", f"{root}/rates",
                     "--out2", f"{root}/summary"]) == 0
    summ = spark.read.option("header", True).csv(f"{root}/summary")
    assert summ.count() == 2  # every index is kept
