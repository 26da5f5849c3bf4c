"""Sinks and archives: idempotent per-batch writes, create-if-absent,
verify-before-delete archives, and the watermarked window aggregate."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from fieldwatch.config import FIXTURE_PARAMS
from fieldwatch.plans.pipeline import Pipeline
from fieldwatch.schemas import TELEMETRY_DOC
from fieldwatch.sinks import archive as AR
from fieldwatch.sinks import writers as W

SF = "/root/testdata/sf0.001"


def test_documents_idempotent_per_batch(spark):
    p = Pipeline(spark, SF, FIXTURE_PARAMS)
    root = tempfile.mkdtemp(prefix="fw-docs-")
    W.ensure_table(spark, f"{root}/t", TELEMETRY_DOC)
    W.ensure_table(spark, f"{root}/t", TELEMETRY_DOC)  # second call leaves it alone
    assert spark.read.parquet(f"{root}/t").count() == 0
    docs = p.enriched_telemetry
    n = docs.count()
    for _ in range(2):  # a replayed batch overwrites its own partition
        W.write_documents(docs, f"{root}/docs", TELEMETRY_DOC, batch_id=7)
    out = spark.read.parquet(f"{root}/docs")
    assert out.count() == n
    assert out.filter(F.col("created_at").isNull() | F.col("ts_before_es").isNull()).count() == 0
    assert dict(out.dtypes)["temperature_avg"] == "float" and dict(out.dtypes)["count"] == "int"


def test_ensure_table_never_touches_what_it_cannot_read(spark):
    """One unreadable file must not cost the table its rows."""
    root = tempfile.mkdtemp(prefix="fw-n12-")
    schema = spark.range(0).schema
    spark.range(100).repartition(4).write.parquet(f"{root}/t")
    before = sorted(os.listdir(f"{root}/t"))
    broken = next(f for f in before if f.endswith(".parquet"))
    with open(f"{root}/t/{broken}", "wb") as f:
        f.write(b"not parquet")
    W.ensure_table(spark, f"{root}/t", schema)
    assert sorted(os.listdir(f"{root}/t")) == before
    W.ensure_table(spark, f"{root}/new", schema)
    assert spark.read.parquet(f"{root}/new").count() == 0


def test_raw_log_replay_in_a_later_bucket_replaces_the_batch(spark):
    """The bucket is the clock's, the batch owns its rows."""
    root = tempfile.mkdtemp(prefix="fw-w6-")
    df = spark.createDataFrame([("d1", 1)], "device_id string, n int")
    for seconds in (300, 7):  # another bucket length: another bucket folder
        W.write_raw_log(df, f"{root}/log", seconds, batch_id=4)
    W.write_raw_log(df, f"{root}/log", 300, batch_id=5)
    assert spark.read.text(f"{root}/log").count() == 2


def test_raw_records_survive_archive_runs_between_batches(spark):
    """N5 then N8, twice: the stream goes on after its files were archived."""
    from fieldwatch.schemas import RAW_RECORD
    from fieldwatch.streaming import jobs as J

    root = tempfile.mkdtemp(prefix="fw-n5-")
    os.makedirs(f"{root}/in")
    total = 0
    for k in range(3):
        rows = [("d", 1000 * k + j, "t", 1.0, 2.0, 3.0, 4.0, "OK", "g", 1000 * k + j, "t") for j in range(5 + k)]
        spark.createDataFrame(rows, RAW_RECORD).coalesce(1).write.mode("append").parquet(f"{root}/in")
        records = spark.readStream.schema(RAW_RECORD).parquet(f"{root}/in")
        J.start_raw_telemetry_sink(records, f"{root}/raw", f"{root}/ckpt", "availableNow").awaitTermination()
        total += AR.archive_raw_telemetry(spark, f"{root}/raw", f"{root}/archive", f"r{k}")
        assert AR.archive_raw_telemetry(spark, f"{root}/raw", f"{root}/archive", f"r{k}b") == 0
    assert total == 5 + 6 + 7 == spark.read.parquet(f"{root}/archive").count()


def test_archive_files_follow_the_bytes_not_the_tasks(spark):
    """40 input files of 3 days become one file a day; with a small target size a
    large day is cut into several."""
    from fieldwatch.schemas import RAW_RECORD

    root, day = tempfile.mkdtemp(prefix="fw-n8-"), 86_400_000
    rows = [(f"d{j}", 1000 * j, "t", 1.0, j * 1.37, 3.0, 4.0, "OK", "g", (0 if j % 10 else 1 + j % 20 // 10) * day + j, "t")
            for j in range(20_000)]
    files = lambda r: {d: sum(x.endswith(".parquet") for x in os.listdir(f"{root}/archive/run={r}/{d}"))
                       for d in os.listdir(f"{root}/archive/run={r}") if d.startswith("day=")}
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for run, size in (("r1", "64m"), ("r2", "100k")):
        df = spark.createDataFrame(rows, RAW_RECORD).repartition(40)
        W.write_raw_telemetry(df, f"{root}/raw-{run}", batch_id=0)
        spark.conf.set(key, size)
        try:
            assert AR.archive_raw_telemetry(spark, f"{root}/raw-{run}", f"{root}/archive", run) == len(rows)
        finally:
            spark.conf.unset(key)
    assert files("r1") == {"day=1970-01-01": 1, "day=1970-01-02": 1, "day=1970-01-03": 1}
    assert 2 <= files("r2")["day=1970-01-01"] <= 30 and files("r2")["day=1970-01-02"] <= 3


def test_archive_takes_up_the_claim_of_a_failed_run(spark):
    root = tempfile.mkdtemp(prefix="fw-claim-")
    os.makedirs(f"{root}/logs/batch_id=1/bucket=0")
    with open(f"{root}/logs/batch_id=1/bucket=0/part-0.txt", "w") as f:
        f.write("a\nb\n")
    assert AR.claim(spark, f"{root}/logs", "s0") is None  # no _SUCCESS: still being written
    open(f"{root}/logs/batch_id=1/_SUCCESS", "w").close()
    assert AR.claim(spark, f"{root}/logs", "s1")  # and the run fails here
    with open(f"{root}/logs/raw_alert_9.log", "w") as f:
        f.write("c\n")
    assert AR.archive_alert_logs(spark, f"{root}/logs", f"{root}/archive", "s2") == 3


def test_alert_archive_is_sorted_by_file(spark):
    """K4: lines in the order of their files, and of their places in them."""
    root = tempfile.mkdtemp(prefix="fw-k4-")
    os.makedirs(f"{root}/logs")
    want = []
    for i in range(4):
        lines = [f"file {i} line {j:03d}" for j in range(50)]
        want += lines
        with open(f"{root}/logs/raw_alert_{i}.log", "w") as f:
            f.write("\n".join(lines) + "\n")
    AR.archive_alert_logs(spark, f"{root}/logs", f"{root}/archive", "k4")
    got = []
    for part in sorted(glob.glob(f"{root}/archive/alerts_k4/part-*")):
        got += [r.value for r in spark.read.text(part).collect()]
    assert got == want


def test_alert_log_archive_verifies_then_deletes(spark):
    root = tempfile.mkdtemp(prefix="fw-logs-")
    os.makedirs(f"{root}/logs")
    lines = 0
    for i in range(3):
        with open(f"{root}/logs/raw_alert_{1000 + i}.log", "w") as f:
            for j in range(5 + i):
                f.write(f'{{"device_id":"d{i}","n":{j}}}\n')
                lines += 1
    n = AR.archive_alert_logs(spark, f"{root}/logs", f"{root}/archive", "20240101_0000")
    assert n == lines
    assert spark.read.text(f"{root}/archive/alerts_20240101_0000").count() == lines
    assert glob.glob(f"{root}/archive/alerts_20240101_0000/*.gz")
    assert not glob.glob(f"{root}/logs/*.log")


def test_raw_telemetry_archive(spark):
    p = Pipeline(spark, SF, FIXTURE_PARAMS)
    root = tempfile.mkdtemp(prefix="fw-raw-")
    from fieldwatch.operators import telemetry as T
    raw = T.raw_records(p.raw_readings, p.dev_gw, FIXTURE_PARAMS.window_ms).drop("event_id")
    raw.write.parquet(f"{root}/raw")
    n = raw.count()
    assert AR.archive_raw_telemetry(spark, f"{root}/raw", f"{root}/archive", "r1") == n
    assert spark.read.parquet(f"{root}/archive/run=r1").count() == n
    assert not glob.glob(f"{root}/raw/*.parquet")


def test_gateway_window_stream_matches_batch(spark):
    """ST5: windows the watermark has closed equal the batch statistics."""
    from fieldwatch.functions.timefmt import ntz_of_ms
    from fieldwatch.operators import telemetry as T
    from fieldwatch.streaming import jobs as J

    p = Pipeline(spark, SF, FIXTURE_PARAMS)
    root = tempfile.mkdtemp(prefix="fw-win-")
    r = p.raw_readings.withColumn("event_time", ntz_of_ms(F.col("device_ts")).cast("timestamp"))
    r.repartition(1).orderBy("device_ts").write.parquet(f"{root}/in")
    stream = spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    q = J.start_gateway_telemetry(stream, p.dev_gw, f"{root}/topics", f"{root}/ckpt", params=FIXTURE_PARAMS,
                                  trigger="availableNow")
    q.awaitTermination()
    from fieldwatch.functions import jsonio
    from fieldwatch.config import RAW_TELEMETRY_TOPIC
    from fieldwatch.streaming.sources import topic_file
    got = jsonio.parse_telemetry(spark.read.text(f"{root}/topics/{topic_file(RAW_TELEMETRY_TOPIC)}")) \
        .select("device_id", "gateway_ts", "count")
    exp = p.telemetry.select("device_id", "gateway_ts", "count")
    n = got.count()
    assert n > 0.8 * exp.count()  # every window but the last ones, which the watermark has not closed
    assert got.exceptAll(exp).count() == 0


def test_late_rows_dropped_and_counted(spark):
    """ST9: a reading later than the watermark is dropped from the windowed
    aggregate and counted in the query progress."""
    import json
    from fieldwatch.config import Params
    from fieldwatch.streaming import jobs as J

    p = Params(window_ms=10_000)
    root = tempfile.mkdtemp(prefix="fw-late-")
    os.makedirs(f"{root}/in")
    base = 1_700_000_000_000
    # Spark judges lateness against the previous batch's watermark, so the
    # late reading comes two batches after the one that moves the watermark
    batches = [[("d1", base + 1_000), ("d1", base + 2_000)],
               [("d1", base + 95_000)],           # moves the watermark far ahead
               [("d1", base + 96_000)],           # closes window [0 s, 10 s)
               [("d1", base + 3_000)]]            # belongs to the closed window: late
    for i, rows in enumerate(batches):
        path = f"{root}/in/part-{i}.json"
        with open(path, "w") as f:
            for d, ms in rows:
                f.write(json.dumps({"device_id": d, "device_ts": ms, "temperature": 20.0, "humidity": 50.0,
                                    "soil_moisture": 50.0, "light_level": 1000.0}) + "\n")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    schema = ("device_id string, device_ts long, temperature double, humidity double, soil_moisture double, "
              "light_level double")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{root}/in")
              .withColumn("event_time", F.timestamp_millis("device_ts")))
    dev_gw = spark.createDataFrame([("d1", "g1")], "device_id string, gateway_id string")
    q = J.start_gateway_telemetry(stream, dev_gw, f"{root}/topics", f"{root}/ckpt", params=p,
                                  watermark="10 seconds", trigger="availableNow")
    q.awaitTermination()
    from fieldwatch.config import RAW_TELEMETRY_TOPIC
    from fieldwatch.functions import jsonio
    from fieldwatch.streaming.sources import topic_file
    out = jsonio.parse_telemetry(spark.read.text(f"{root}/topics/{topic_file(RAW_TELEMETRY_TOPIC)}")).collect()
    dropped = sum(int(op.numRowsDroppedByWatermark) for pr in q.recentProgress for op in pr.stateOperators)
    assert dropped == 1
    first = [r for r in out if r.gateway_ts == base + 10_000]
    assert len(first) == 1 and first[0]["count"] == 2  # the late reading did not reopen the window
