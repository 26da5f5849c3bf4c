"""Streaming = batch: the same operators over files split into several
micro-batches give the batch answer, and a restart from the checkpoint adds
nothing."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from fieldwatch.config import CLEANED_ALERT_TOPIC, FIXTURE_PARAMS
from fieldwatch.functions import jsonio
from fieldwatch.plans.pipeline import Pipeline
from fieldwatch.schemas import TELEMETRY_MSG
from fieldwatch.streaming import jobs as J
from fieldwatch.streaming.sources import topic_batch, topic_file, topic_stream

SF = "/root/testdata/sf0.001"


def _write_chunks(df, folder, key, n):
    """Write JSON lines into n files, ordered by ``key`` (one file per micro-batch)."""
    os.makedirs(folder, exist_ok=True)
    pdf = df.toPandas().sort_values(key, kind="stable").reset_index(drop=True)
    size = max(1, -(-len(pdf) // n))
    for i in range(n):
        chunk = pdf.iloc[i * size:(i + 1) * size]
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w") as f:
            for v in chunk["value"]:
                f.write(v + "\n")
        # arrival order = file age: give the files increasing modification times
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return len(pdf)


def test_alert_cleanup_stream_equals_batch(spark):
    p = Pipeline(spark, SF, FIXTURE_PARAMS)
    src = jsonio.rows_to_json(p.fleet_alerts.drop("seq").orderBy("gateway_ts", "device_id")) \
        .withColumn("gts", F.get_json_object("value", "$.gateway_ts").cast("long"))
    root = tempfile.mkdtemp(prefix="fw-stream-")
    n = _write_chunks(src, f"{root}/in", "gts", 4)
    assert n > 0
    loc = J.LocationCache(lambda: p.locations)
    size = sum(os.path.getsize(f"{root}/in/{x}") for x in os.listdir(f"{root}/in"))
    stream = topic_stream(spark, "alerts", folder=f"{root}/in", starting_offsets="earliest", max_bytes=size // 5)
    batches = []
    for _ in range(2):  # second run restarts from the checkpoint and must add nothing
        raw_q, q = J.start_alert_cleanup(stream, loc, f"{root}/docs", f"{root}/rawlog", f"{root}/ckpt",
                                         topic_folder=f"{root}/topics", dedup_window=FIXTURE_PARAMS.dedup_window,
                                         trigger="0 seconds")
        for each in (q, raw_q):
            each.processAllAvailable()
        batches.append(sum(p.numInputRows > 0 for p in q.recentProgress))
        for each in (q, raw_q):
            each.stop()
    assert batches[0] >= 5 and batches[1] == 0  # batches end inside files
    docs = spark.read.parquet(f"{root}/docs")
    got = {(r.device_id, r.gateway_ts, r.state) for r in docs.collect()}
    exp = {(r.device_id, r.gateway_ts, r.state) for r in p.deduped_alerts.collect()}
    assert docs.count() == len(exp)
    assert got == exp
    assert spark.read.text(f"{root}/rawlog").count() == n  # every parsed row, once
    # S3: the cleaned topic read as a bounded table
    topic = topic_batch(spark, CLEANED_ALERT_TOPIC, folder=f"{root}/topics/{topic_file(CLEANED_ALERT_TOPIC)}")
    assert topic.count() == len(exp)
    assert docs.filter(F.col("created_at").isNull()).count() == 0
    assert docs.filter(F.col("farm_id").isNull()).count() == 0  # fleet alerts come from registered devices


def test_telemetry_enrichment_stream_equals_batch(spark):
    p = Pipeline(spark, SF, FIXTURE_PARAMS)
    src = jsonio.rows_to_json(p.telemetry.select(*[f.name for f in TELEMETRY_MSG.fields]))
    root = tempfile.mkdtemp(prefix="fw-tele-")
    with open(f"{root}/bad.json", "w") as f:  # an unparsable message is kept as an all-NULL row
        f.write("not json\n")
    src = src.withColumn("gts", F.get_json_object("value", "$.gateway_ts").cast("long"))
    n = _write_chunks(src, f"{root}/in", "gts", 3)
    os.replace(f"{root}/bad.json", f"{root}/in/bad.json")
    os.utime(f"{root}/in/bad.json", (1_700_000_000 - 10, 1_700_000_000 - 10))
    stream = topic_stream(spark, "telemetry", folder=f"{root}/in", starting_offsets="earliest")
    q = J.start_telemetry_enrichment(stream, J.LocationCache(lambda: p.locations), f"{root}/docs", f"{root}/ckpt",
                                     trigger="availableNow")
    q.awaitTermination()
    docs = spark.read.parquet(f"{root}/docs")
    assert docs.count() == n + 1
    exp = p.enriched_telemetry.select("device_id", "gateway_ts", "farm_id", "count")
    got = docs.filter(F.col("device_id").isNotNull()).select("device_id", "gateway_ts", "farm_id", "count")
    assert got.exceptAll(exp.withColumn("count", F.col("count").cast("int"))).count() == 0
    # stamps are ordered: ingest <= before-write <= created
    bad = docs.filter(F.col("device_id").isNotNull()
                      & ((F.col("ts_kafka_ingest") > F.col("ts_before_es"))
                         | (F.col("ts_before_es") > F.unix_millis(F.col("created_at")))))
    assert bad.count() == 0


def test_notifier_stream(spark):
    p = Pipeline(spark, SF, FIXTURE_PARAMS)
    from fieldwatch.schemas import CLEANED_ALERT
    src = jsonio.rows_to_json(p.cleaned_alerts.select(*[f.name for f in CLEANED_ALERT.fields]))
    root = tempfile.mkdtemp(prefix="fw-notify-")
    _write_chunks(src, f"{root}/in", "value", 2)
    stream = topic_stream(spark, CLEANED_ALERT_TOPIC, folder=f"{root}/in", starting_offsets="earliest")
    q = J.start_notifier(stream, p.routes, f"{root}/out", f"{root}/unrouted", f"{root}/ckpt", trigger="availableNow")
    q.awaitTermination()
    from fieldwatch.operators import notify as N
    assert spark.read.parquet(f"{root}/out").count() == N.notifications(p.cleaned_alerts, p.routes).count()
    assert spark.read.parquet(f"{root}/unrouted").count() == N.unrouted_alerts(p.cleaned_alerts, p.routes).count()


def test_gateway_alert_stream_equals_batch(spark):
    """ST7: readings arriving in micro-batches that cut windows anywhere give
    the batch fleet alerts for every window the watermark has closed; the
    state table carries devices across batches."""
    from fieldwatch.config import RAW_ALERT_TOPIC
    from fieldwatch.schemas import ALERT_MSG

    p = Pipeline(spark, SF, FIXTURE_PARAMS)
    cols = ["device_id", "gateway_ts", "state", "details", F.col("event_id").alias("seq")]
    src = jsonio.rows_to_json(p.readings.select(*cols)) \
        .withColumn("gts", F.get_json_object("value", "$.gateway_ts").cast("long"))
    root = tempfile.mkdtemp(prefix="fw-gw-")
    n = _write_chunks(src, f"{root}/in", "gts", 5)  # chunks of equal size: windows are split
    schema = "device_id string, gateway_ts long, state string, details array<string>, seq long"
    stream = (spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{root}/in")
              .select(F.from_json("value", schema).alias("m")).select("m.*"))
    q = J.start_gateway_alerts(stream, p.dev_gw, f"{root}/state", f"{root}/ckpt", params=FIXTURE_PARAMS,
                               topic_folder=f"{root}/topics", trigger="availableNow")
    q.awaitTermination()
    out = jsonio.parse_json(spark.read.text(f"{root}/topics/{topic_file(RAW_ALERT_TOPIC)}"), ALERT_MSG)
    got = {(r.device_id, r.gateway_ts, r.state) for r in out.collect()}
    last = src.agg(F.max("gts")).first()[0]  # the newest window is still open at the end
    exp = {(r.device_id, r.gateway_ts, r.state) for r in p.fleet_alerts.filter(F.col("gateway_ts") < last).collect()}
    assert n > 0 and len(exp) > 100
    assert got == exp


def test_gateway_alerts_drop_late_readings(spark):
    """ST7: a reading for a window the watermark already closed is dropped;
    alerts equal the batch answer without it."""
    import json
    from fieldwatch.config import Params, RAW_ALERT_TOPIC
    from fieldwatch.operators import alerts as A
    from fieldwatch.schemas import ALERT_MSG

    P = Params(window_ms=10, cooldown_ms=20, recovery_ms=5, offline_ms=30)
    b = 1000
    parts = [[("a", b + 10, "CRITICAL", 1), ("b", b + 10, "OK", 2), ("a", b + 20, "OK", 3)],
             [("a", b + 30, "CRITICAL", 4), ("b", b + 40, "CRITICAL", 5)],
             [("a", b + 10, "CRITICAL", 6),   # late: window b+10 was folded two batches ago
              ("b", b + 60, "OK", 7), ("a", b + 70, "OK", 8)]]
    root = tempfile.mkdtemp(prefix="fw-gwlate-")
    os.makedirs(f"{root}/in")
    for i, rows in enumerate(parts):
        path = f"{root}/in/part-{i}.json"
        with open(path, "w") as f:
            for d, t, s, q in rows:
                f.write(json.dumps({"device_id": d, "gateway_ts": t, "state": s, "details": [], "seq": q}) + "\n")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    schema = "device_id string, gateway_ts long, state string, details array<string>, seq long"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{root}/in")
    dev_gw = spark.createDataFrame([("a", "g"), ("b", "g"), ("c", "g")], "device_id string, gateway_id string")
    q = J.start_gateway_alerts(stream, dev_gw, f"{root}/state", f"{root}/ckpt", params=P,
                               topic_folder=f"{root}/topics", trigger="availableNow", late_path=f"{root}/late",
                               merge_every=2)
    q.awaitTermination()
    # ST9: the late reading is a row of its own, once, whole
    late = spark.read.parquet(f"{root}/late").collect()
    assert [(r.device_id, r.gateway_ts, r.state, r.seq, r.batch_id) for r in late] == [("a", b + 10, "CRITICAL", 6, 2)]
    assert late[0].closed_upto >= b + 10
    out = jsonio.parse_json(spark.read.text(f"{root}/topics/{topic_file(RAW_ALERT_TOPIC)}"), ALERT_MSG)
    got = {(r.device_id, r.gateway_ts, r.state) for r in out.collect()}
    on_time = [r for p in parts for r in p if r[3] != 6]
    rdf = spark.createDataFrame([(d, t, s, [], q) for d, t, s, q in on_time],
                                "device_id string, gateway_ts long, state string, details array<string>, event_id long")
    exp = {(r.device_id, r.gateway_ts, r.state) for r in A.fleet_alerts(rdf, dev_gw, P).collect()
           if r.gateway_ts < b + 70}  # the newest window is still open
    assert got == exp and len(exp) > 3


def test_gateway_alerts_stop_when_their_state_is_gone(spark):
    """ST7: a lost or unreadable state version stops the query, it never resets it;
    versions older than the last two are removed."""
    import json
    import shutil

    import pytest

    from fieldwatch.config import Params

    root = tempfile.mkdtemp(prefix="fw-gwstate-")
    os.makedirs(f"{root}/in")
    schema = "device_id string, gateway_ts long, state string, details array<string>, seq long"
    dev_gw = spark.createDataFrame([("a", "g")], "device_id string, gateway_id string")

    def feed(k):
        path = f"{root}/in/part-{k}.json"
        with open(path, "w") as f:
            f.write(json.dumps({"device_id": "a", "gateway_ts": 1000 + 10 * k, "state": "CRITICAL", "details": [],
                                "seq": k}) + "\n")
        os.utime(path, (1_700_000_000 + k * 10, 1_700_000_000 + k * 10))

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{root}/in")
        q = J.start_gateway_alerts(stream, dev_gw, f"{root}/state", f"{root}/ckpt",
                                   params=Params(window_ms=10, cooldown_ms=20, recovery_ms=5, offline_ms=30),
                                   topic_folder=f"{root}/topics", trigger="availableNow")
        q.awaitTermination()

    for k in range(4):
        feed(k)
    run()
    assert sorted(os.listdir(f"{root}/state/mark")) == ["v=2", "v=3"]
    shutil.move(f"{root}/state/state/delta/v=3", f"{root}/lost")
    feed(4)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        run()
    assert not os.path.exists(f"{root}/state/mark/v=4")
    shutil.move(f"{root}/lost", f"{root}/state/state/delta/v=3")
    run()
    assert os.path.exists(f"{root}/state/mark/v=4")


def test_location_cache_expires_and_reloads_when_empty(spark):
    """One load within the lifetime, a new one after it, and at once while empty."""
    now, loads = [0.0], []

    def loader():
        loads.append(now[0])
        return spark.range(0 if len(loads) == 1 else 3)

    cache = J.LocationCache(loader, ttl_s=100, reload_if_empty=True, clock=lambda: now[0])
    assert cache.get().count() == 0
    now[0] = 1.0
    assert cache.get().count() == 3  # was empty
    now[0] = 90.0
    assert cache.get() is cache.get() and len(loads) == 2
    now[0] = 102.0
    cache.get()
    assert loads == [0.0, 1.0, 102.0]
    strict = J.LocationCache(lambda: spark.range(0), ttl_s=100, clock=lambda: now[0])
    assert strict.get() is strict.get()  # an empty dimension is kept where that is asked for


def test_progress_samples_feed_the_rate(spark):
    """S11 on a live query: cumulative counters, usable by counter_rate."""
    from fieldwatch.operators import evaluation as E

    root = tempfile.mkdtemp(prefix="fw-progress-")
    for k in range(3):
        spark.range(10 * (k + 1)).coalesce(1).write.mode("append").parquet(f"{root}/in")
    q = (spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{root}/in").writeStream
         .queryName("live").foreachBatch(lambda b, n: b.count()).option("checkpointLocation", f"{root}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    samples = J.progress_samples(q)
    totals = [s["total"] for s in samples]
    assert totals == sorted(totals) and totals[-1] == 60 and all(s["index"] == "live" for s in samples)
    df = spark.createDataFrame([(s["index"], s["sample_ts"], s["total"], s["time_ms"]) for s in samples],
                               "index string, sample_ts string, total long, time_ms long")
    assert E.counter_rate(df).count() == len(samples) - 1


def test_file_topics_keep_the_order_of_lines(spark):
    root = tempfile.mkdtemp(prefix="fw-order-")
    for k, name in enumerate(["b", "a"]):
        with open(f"{root}/{name}.json", "w") as f:
            f.write("".join(f"{name}{j}\n" for j in range(500)))
        os.utime(f"{root}/{name}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    q = (topic_stream(spark, "t", folder=root, starting_offsets="earliest").writeStream.format("memory").queryName("lines")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = [r.value for r in spark.table("lines").orderBy("seq").collect()]
    assert got == [f"b{j}" for j in range(500)] + [f"a{j}" for j in range(500)]


def test_a_dimension_that_has_not_changed_is_not_loaded_again(spark, tmp_path):
    """Unchanged sources keep their copy; of 20 changed ones the last two copies stay."""
    from fieldwatch.sinks.storage import fingerprint

    now, loads = [0.0], []
    source = f"{tmp_path}/dim"
    spark.range(1).coalesce(1).write.parquet(source)

    def loader():
        loads.append(now[0])
        return spark.read.parquet(source)

    cache = J.LocationCache(loader, ttl_s=10, clock=lambda: now[0], fingerprint=lambda: fingerprint(spark, source))
    first = cache.get()
    for _ in range(3):
        now[0] += 11
        assert cache.get() is first
    assert len(loads) == 1
    for k in range(20):
        spark.range(1).coalesce(1).write.mode("append").parquet(source)
        now[0] += 11
        assert cache.get().count() == k + 2
    assert len(loads) == 21 and len(cache.copies) == 2 and all(os.path.isdir(p.removeprefix("file:")) for p in cache.copies)
    parent = os.path.dirname(cache.copies[0].removeprefix("file:"))
    assert sum(x.startswith("locations-") for x in os.listdir(parent)) <= 2 + 20  # other tests' copies lie there too


def test_counters_outlast_the_query(spark, tmp_path):
    """More batches than the progress list holds, and a restart: cumulative counters that
    never fall, and the rates of exactly these batches."""
    from fieldwatch.operators import evaluation as E

    folder, samples = f"{tmp_path}/t", f"{tmp_path}/samples"
    os.makedirs(folder)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "3")
    locations = spark.createDataFrame([], Pipeline(spark, SF).locations.schema)
    try:
        for part in range(2):
            with open(f"{folder}/f{part}", "w") as f:
                f.write("".join(json.dumps({"device_id": f"d{k}", "gateway_ts": k}) + "\n" for k in range(40)))
            os.utime(f"{folder}/f{part}", (1_700_000_000, 1_700_000_000))
            stream = topic_stream(spark, "t", folder=folder, starting_offsets="earliest", max_bytes=220)
            q = J.start_telemetry_enrichment(stream, J.LocationCache(lambda: locations), f"{tmp_path}/docs",
                                             f"{tmp_path}/ckpt", trigger="0 seconds", counters=samples)
            q.processAllAvailable()
            q.stop()
    finally:
        spark.conf.unset(key)
    counters = J.counter_table(spark, samples)
    rows = counters.orderBy("sample_ts").collect()
    totals = [r.total for r in rows]
    assert len(rows) >= 10 and totals == sorted(totals) and totals[-1] == 80 == spark.read.parquet(f"{tmp_path}/docs").count()
    assert [r.time_ms for r in rows] == sorted(r.time_ms for r in rows)
    rates = E.counter_rate(counters)
    assert rates.agg(F.sum("docs")).first()[0] == totals[-1] - totals[0]
    summary = E.rate_summary(rates).collect()
    assert len(summary) == 1 and summary[0].min_rate > 0
