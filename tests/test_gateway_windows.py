"""ST5 with late readings kept: every reading is in one published window, in an open
one, or a row of the late table, whatever the micro-batches, and also on replay."""

import json
import math
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from fieldwatch.config import METRICS, RAW_TELEMETRY_TOPIC, Params
from fieldwatch.operators import telemetry as T
from fieldwatch.streaming import jobs as J
from fieldwatch.streaming.sources import topic_file
from fieldwatch.streaming.versions import KeyedVersions

SCHEMA = "device_id string, device_ts long, " + ", ".join(f"{m} double" for m in METRICS) + ", seq long"
P = Params(window_ms=10)
BASE = 1_700_000_000_000


def batches_of(seed, n_batches=5, rows=40):
    """Readings whose times mostly grow, some far behind, some without a time or a value."""
    rng, out, seq = random.Random(seed), [], 0
    for b in range(n_batches):
        part = []
        for _ in range(rows):
            seq += 1
            t = BASE + b * 30 + rng.randrange(35) - (rng.randrange(20, 120) if rng.random() < 0.2 else 0)
            values = {m: None if rng.random() < 0.2 else 20 + rng.random() for m in METRICS}
            part.append({"device_id": rng.choice(["a", "b", "c", "unknown"]),
                         "device_ts": None if rng.random() < 0.03 else t, "seq": seq, **values})
        out.append(part)
    return out


def simulate(batches, lateness):
    """(late (seq, batch, closed_upto), published {(device, end): rows}, open ones), in plain Python."""
    seen = closed = None
    open_, done, late = {}, {}, []
    for i, rows in enumerate(batches):
        for r in rows:
            end = None if r["device_ts"] is None else (r["device_ts"] // P.window_ms + 1) * P.window_ms
            if end is None or (closed is not None and end <= closed):
                late.append((r["seq"], i, closed))
            else:
                open_.setdefault((r["device_id"], end), []).append(r)
        seen = max([seen or 0] + [r["device_ts"] for r in rows if r["device_ts"] is not None]) or None
        closed = None if seen is None else seen - lateness
        for key in [k for k in open_ if closed is not None and k[1] <= closed]:
            assert key not in done  # a window is published once
            done[key] = open_.pop(key)
    return late, done, open_


def start(spark, root, lateness):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"{root}/in")
    dev_gw = spark.createDataFrame([(d, f"g-{d}") for d in "abc"], "device_id string, gateway_id string")
    q = J.start_gateway_windows(stream.withColumn("event_time", F.timestamp_millis("device_ts")), dev_gw,
                                f"{root}/state", f"{root}/ckpt", f"{root}/late", params=P, topic_folder=f"{root}/topics",
                                lateness_ms=lateness, trigger="availableNow", merge_every=2)
    q.awaitTermination()


def put(root, batches, first=0):
    os.makedirs(f"{root}/in", exist_ok=True)
    for i, rows in enumerate(batches, first):
        path = f"{root}/in/part-{i:03d}.json"
        with open(path, "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


def check(spark, root, batches, lateness):
    late, done, open_ = simulate(batches, lateness)
    got = spark.read.parquet(f"{root}/late").collect()
    assert sorted((r.seq, r.batch_id, r.closed_upto or 0) for r in got) == sorted((s, b, c or 0) for s, b, c in late)
    published = [json.loads(r.value) for r in spark.read.text(f"{root}/topics/{topic_file(RAW_TELEMETRY_TOPIC)}").collect()]
    expected = {k: v for k, v in done.items() if k[0] != "unknown"}
    assert len(published) == len(expected)
    for p in published:
        rows = expected[p["device_id"], p["gateway_ts"]]
        assert p["count"] == len(rows) and p["gateway_id"] == f"g-{p['device_id']}"
        for m in METRICS:
            values = [r[m] for r in rows if r[m] is not None]
            assert (f"{m}_avg" in p) == bool(values)
            if values:
                mean = sum(values) / len(values)
                std = math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
                assert p[f"{m}_avg"] == pytest.approx(mean) and p[f"{m}_std"] == pytest.approx(std, abs=1e-9)
                assert (p[f"{m}_min"], p[f"{m}_max"]) == (min(values), max(values))
    left = KeyedVersions(spark, f"{root}/state/open", ["device_id", "gateway_ts"], J.WINDOW_STATE, 2)
    closed = KeyedVersions(spark, f"{root}/state/mark", "id", "id int, seen_max long, closed_upto long", 2) \
        .read(len(batches) - 1).first()["closed_upto"]
    still = left.read(len(batches) - 1).where(F.col("gateway_ts") > closed).collect()
    assert {(r.device_id, r.gateway_ts): r["count"] for r in still} == {k: len(v) for k, v in open_.items()}
    n = sum(len(b) for b in batches)
    assert n == len(got) + sum(map(len, done.values())) + sum(map(len, open_.values())) and late and done
    return len(got), len(published)


@pytest.mark.parametrize("seed, lateness", [(1, 10), (2, 0)])
def test_every_reading_is_published_open_or_late(spark, seed, lateness):
    root, batches = tempfile.mkdtemp(prefix="fw-windows-"), batches_of(seed)
    put(root, batches[:3])
    start(spark, root, lateness)
    put(root, batches[3:], first=3)
    start(spark, root, lateness)  # goes on from the checkpoint
    before = check(spark, root, batches, lateness)
    # the last batch's commit is lost: it runs again and changes nothing
    os.remove(f"{root}/ckpt/commits/{len(batches) - 1}")
    crc = f"{root}/ckpt/commits/.{len(batches) - 1}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    start(spark, root, lateness)
    assert check(spark, root, batches, lateness) == before


def test_merged_partials_equal_one_aggregate(spark):
    """Large values with a small spread keep it; null devices and all-null metrics stay."""
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), BASE + rng.randrange(30), *[
        None if m == METRICS[0] or rng.random() < 0.3 else 1e8 + rng.random() for m in METRICS], i) for i in range(300)]
    dev_gw = spark.createDataFrame([("a", "g"), ("b", "g")], "device_id string, gateway_id string")
    parts = [T.window_partials(spark.createDataFrame(p, SCHEMA), 10, F.col("device_ts"))
             for p in (rows[:100], rows[100:280], rows[280:])]
    merged = T.merge_partials(T.merge_partials(parts[0], parts[1], "t").drop("t"), parts[2], "t").drop("t")
    assert merged.where("device_id is null").agg(F.sum("count")).first()[0] == sum(r[0] is None for r in rows)
    got = {(r.device_id, r.gateway_ts): r.asDict() for r in T.stats_of_partials(merged, dev_gw).collect()}
    exp = {(r.device_id, r.gateway_ts): r.asDict()
           for r in T.device_window_stats(spark.createDataFrame(rows, SCHEMA), 10, dev_gw).collect()}
    assert got.keys() == exp.keys() and len(got) > 4
    for key, row in exp.items():
        for name, value in row.items():
            assert got[key][name] == (pytest.approx(value, rel=1e-6) if isinstance(value, float) else value), name
