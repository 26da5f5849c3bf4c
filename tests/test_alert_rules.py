"""Alert machinery edge cases on hand-written rows, and a
randomized comparison with a direct step-by-step simulation of the gateway."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fieldwatch.config import Params
from fieldwatch.operators import alerts as A
from fieldwatch.streaming.state import dedup_batch

P = Params(window_ms=10, cooldown_ms=20, recovery_ms=5, offline_ms=30, dedup_window=30)
ALERT_SCHEMA = "device_id string, gateway_id string, gateway_ts long, state string, details array<string>, seq long"
READ_SCHEMA = "device_id string, gateway_ts long, state string, details array<string>, event_id long"


def _alerts(spark, rows):
    return spark.createDataFrame([(d, "g", t, s, [], i) for i, (d, t, s) in enumerate(rows)], ALERT_SCHEMA)


def test_dedup_last_kept_sequence(spark):
    seq = [(0, "C"), (10, "C"), (29, "C"), (30, "C"), (35, "O"), (40, "C"), (60, "C")]
    df = _alerts(spark, [("d1", t, s) for t, s in seq] + [("d2", 5, "C")])
    out = A.dedup_alerts(df, 30, num_partitions=3).filter("device_id = 'd1'")
    assert sorted(r.gateway_ts for r in out.collect()) == [0, 30, 35, 40]


def test_dedup_streaming_fold_matches_and_carries_state():
    pdf = pd.DataFrame({"device_id": "d1", "gateway_ts": [0, 10, 29, 30, 35, 40, 60],
                        "state": ["C", "C", "C", "C", "O", "C", "C"], "seq": range(7)})
    out, ks, kt = dedup_batch(pdf, None, None, 30)
    assert list(out["gateway_ts"]) == [0, 30, 35, 40]
    # split into two micro-batches: same answer
    a, ks1, kt1 = dedup_batch(pdf.iloc[:3], None, None, 30)
    b, _, _ = dedup_batch(pdf.iloc[3:], ks1, kt1, 30)
    assert list(a["gateway_ts"]) + list(b["gateway_ts"]) == [0, 30, 35, 40]
    # a late row close to the kept one is dropped (abs rule)
    late, _, _ = dedup_batch(pd.DataFrame({"device_id": "d1", "gateway_ts": [38], "state": ["C"], "seq": [9]}),
                             "C", 40, 30)
    assert len(late) == 0


def _simulate(readings: pd.DataFrame, devices: list, p: Params) -> set:
    """Step-by-step gateway: per non-empty window, readings in order, then
    the offline check of every registered device not seen in the window."""
    info = {}
    out = set()
    for w, batch in readings.sort_values(["gateway_ts", "event_id"]).groupby("gateway_ts", sort=True):
        now = int(w)
        seen = set()
        for r in batch.itertuples():
            if r.device_id not in devices:
                continue
            st = info.setdefault(r.device_id, {"last_state": "", "last_alert": 0, "last_ts": 0})
            fire = (r.state == "OK" and st["last_state"] == "CRITICAL" and now - st["last_alert"] >= p.recovery_ms) \
                or (r.state == "CRITICAL" and now - st["last_alert"] >= p.cooldown_ms)
            if fire:
                out.add((r.device_id, now, r.state))
                st["last_alert"] = now
            st["last_state"] = r.state
            st["last_ts"] = now
            seen.add(r.device_id)
        for d in devices:
            if d in seen:
                continue
            st = info.setdefault(d, {"last_state": "", "last_alert": 0, "last_ts": 0})
            if now - st["last_ts"] >= p.offline_ms:
                out.add((d, now, "OFFLINE"))
                st["last_alert"] = now
    return out


def _fleet(spark, readings: pd.DataFrame, devices: list, p: Params, nparts=None):
    pdf = readings.assign(details=[[]] * len(readings))[["device_id", "gateway_ts", "state", "details", "event_id"]]
    rdf = spark.createDataFrame(pdf, READ_SCHEMA)
    dev_gw = spark.createDataFrame([(d, "gw") for d in devices], "device_id string, gateway_id string")
    out = A.fleet_alerts(rdf, dev_gw, p, "event_id", nparts).collect()
    return {(r.device_id, r.gateway_ts, r.state) for r in out}


def test_fleet_rules_by_hand(spark):
    b = 1000  # stamps far from 0, as epoch stamps are (the initial last-alert stamp is 0)
    rows = [("a", b + 10, "CRITICAL", 1), ("a", b + 20, "OK", 2), ("b", b + 10, "CRITICAL", 3),
            ("b", b + 10, "OK", 4), ("b", b + 20, "OK", 5), ("a", b + 30, "CRITICAL", 6),
            ("a", b + 40, "CRITICAL", 7), ("b", b + 70, "OK", 8)]
    pdf = pd.DataFrame(rows, columns=["device_id", "gateway_ts", "state", "event_id"])
    devices = ["a", "b", "c"]
    got = _fleet(spark, pdf, devices, P)
    assert got == _simulate(pdf, devices, P)
    # first CRITICAL fires; OK 10 later (recovery 5) fires
    assert ("a", b + 10, "CRITICAL") in got and ("a", b + 20, "OK") in got
    # cooldown boundary: 10 after the last alert no, exactly 20 after yes
    assert ("a", b + 30, "CRITICAL") not in got and ("a", b + 40, "CRITICAL") in got
    # b: the recovery 0 after its alert is lost, and no later OK can recover it
    assert ("b", b + 10, "CRITICAL") in got and not any(d == "b" and s == "OK" for d, _, s in got)
    # never-seen c fires in every non-empty window (50, 60 are empty: nothing is checked)
    assert {t - b for d, t, s in got if d == "c"} == {10, 20, 30, 40, 70}
    # a silent at 70, last seen 40: 30 >= offline 30 -> OFFLINE; b silent at 30/40 only 10/20 after
    assert ("a", b + 70, "OFFLINE") in got
    assert not any(d == "b" and s == "OFFLINE" for d, _, s in got)


def test_fleet_random_matches_simulation(spark):
    rng = np.random.default_rng(11)
    devices = [f"d{i}" for i in range(6)]
    rows = []
    for e in range(600):
        d = rng.choice(devices + ["unknown"], p=[0.5, 0.2, 0.1, 0.1, 0.05, 0.0, 0.05])
        w = 1000 + int(rng.integers(1, 60)) * 10
        rows.append((d, w, rng.choice(["OK", "CRITICAL"], p=[0.6, 0.4]), e))
    pdf = pd.DataFrame(rows, columns=["device_id", "gateway_ts", "state", "event_id"])
    got = _fleet(spark, pdf, devices, P, nparts=5)
    assert got == _simulate(pdf, devices, P)


def test_offline_suppresses_critical(spark):
    # d seen at 10, silent 20..40 (non-empty windows via e), OFFLINE at 40 (40 - 10 >= 30),
    # then CRITICAL at 50: 50 - 40 = 10 < cooldown 20 -> suppressed
    b = 1000
    rows = [("d", b + 10, "OK", 1), ("e", b + 20, "OK", 2), ("e", b + 30, "OK", 3), ("e", b + 40, "OK", 4),
            ("d", b + 50, "CRITICAL", 5)]
    pdf = pd.DataFrame(rows, columns=["device_id", "gateway_ts", "state", "event_id"])
    got = _fleet(spark, pdf, ["d", "e"], P)
    assert ("d", b + 40, "OFFLINE") in got and ("d", b + 50, "CRITICAL") not in got
    assert got == _simulate(pdf, ["d", "e"], P)


def test_fleet_small_arrow_batches(spark):
    """Keys cut across Arrow batches are carried to the next batch intact."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "5")
    try:
        rng = np.random.default_rng(3)
        devices = [f"d{i}" for i in range(4)]
        rows = [(str(rng.choice(devices)), 1000 + int(rng.integers(1, 40)) * 10,
                 str(rng.choice(["OK", "CRITICAL"])), e) for e in range(300)]
        pdf = pd.DataFrame(rows, columns=["device_id", "gateway_ts", "state", "event_id"])
        assert _fleet(spark, pdf, devices, P, nparts=2) == _simulate(pdf, devices, P)
    finally:
        spark.conf.set(key, old)


def test_long_silence_crosses_explode_blocks(spark):
    """A silence gap longer than one explode block yields every window once."""
    n = 10_000
    rows = [("b", w + 1, "OK", w) for w in range(n + 1)] + [("a", 1, "OK", -1), ("a", n + 1, "OK", -2)]
    rdf = spark.createDataFrame([(d, t, s, [], q) for d, t, s, q in rows],
                                "device_id string, gateway_ts long, state string, details array<string>, "
                                "event_id long")
    dev_gw = spark.createDataFrame([("a", "g"), ("b", "g")], "device_id string, gateway_id string")
    known = rdf.join(dev_gw, "device_id")
    got = A.unseen_devices(known, dev_gw, 1).filter("device_id = 'a'").select("w").collect()
    ws = sorted(r.w for r in got)
    assert ws == list(range(1, n))


def test_sparse_fleets_match_simulation(spark):
    """Few, far apart fleet windows; silences longer and shorter than the limit; limits
    below and above a window."""
    rng = np.random.default_rng(17)
    devices = [f"d{i}" for i in range(8)]
    for offline in (5, 30, 2_000):
        p = P.with_(offline_ms=offline)
        stamps = 1000 + 10 * np.sort(rng.choice(50_000, 40, replace=False))
        rows = [(devices[int(rng.integers(0, 6))], int(rng.choice(stamps)), str(rng.choice(["OK", "CRITICAL"])), e)
                for e in range(120)]
        pdf = pd.DataFrame(rows, columns=["device_id", "gateway_ts", "state", "event_id"])
        assert _fleet(spark, pdf, devices, p, nparts=3) == _simulate(pdf, devices, p)


def test_time_in_which_nobody_speaks_costs_nothing(spark):
    """A fleet silent for 600 days of 10 s windows: as many candidates as alerts. The
    ranges are spread out over numbered windows, of which there are three."""
    day = 86_400_000
    p = Params(window_ms=10_000, cooldown_ms=20, recovery_ms=5, offline_ms=30_000)
    stamps = [day, day + 10_000, 601 * day]
    rows = [(f"d{k}", stamps[0], "OK", [], k) for k in range(400)] + [("d0", t, "OK", [], 400 + n) for n, t in enumerate(stamps[1:])]
    rdf = spark.createDataFrame(rows, READ_SCHEMA)
    dev_gw = spark.createDataFrame([(f"d{k}", "g") for k in range(400)], "device_id string, gateway_id string")
    known = A.gateway_lookup(rdf, dev_gw).cache()
    ticks = A.offline_alerts(known, dev_gw, p)
    assert sorted((r.gateway_ts, r["count"]) for r in ticks.groupBy("gateway_ts").count().collect()) == [(stamps[2], 399)]
    unseen = A.unseen_devices(known, dev_gw, 10_000)
    assert unseen.count() == 2 * 399
    made = [int(x) for x in _output_rows(unseen, "Generate")]
    assert made and max(made) <= 2 * 399


def test_silences_become_ticks_once(spark, monkeypatch):
    """The fold's candidates take a silence's last tick from its end; only the output
    spreads silences out, over as many tasks as the fold has."""
    laid, layout = [], A.ordered_layout
    monkeypatch.setattr(A, "ordered_layout", lambda df, *args: laid.append(df) or layout(df, *args))
    rows = [("d0", 1000 + 10 * k, "OK" if k % 3 else "CRITICAL", [], k) for k in range(60)]
    rows += [("d1", 1000 + 10 * k, "CRITICAL", [], 60 + k) for k in (0, 20, 45)]
    dev_gw = spark.createDataFrame([(f"d{k}", "g") for k in range(3)], "device_id string, gateway_id string")
    known = A._known(spark.createDataFrame(rows, READ_SCHEMA), dev_gw, "event_id").cache()
    out = A._fleet(known, dev_gw, P, 3)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert len(laid) == 2 and not any("Generate" in plan(df) for df in laid)
    assert "Generate" in plan(out) and "RepartitionByExpression" in plan(out)
    pdf = pd.DataFrame([r[:3] + r[4:] for r in rows], columns=["device_id", "gateway_ts", "state", "event_id"])
    got = sorted((r.device_id, r.gateway_ts, r.state) for r in out.collect())
    assert got == sorted(x[:3] for x in _simulate(pdf, ["d0", "d1", "d2"], P))


def test_dedup_goes_on_in_the_layout_of_the_fleet(spark, monkeypatch):
    """The fleet's fold and the dedup share one layout, in which a silence's ticks are rows of
    up to 64 stamps; spread out, they are the alerts, in an order the dedup can rely on."""
    laid, layout = [], A.ordered_layout
    monkeypatch.setattr(A, "ordered_layout", lambda df, *args: laid.append(df) or layout(df, *args))
    rows = [("d0", 1000 + 10 * k, "OK" if k % 3 else "CRITICAL", [], k) for k in range(300)]
    rows += [("d1", 1000 + 10 * k, "CRITICAL", [], 300 + k) for k in (0, 1, 20, 150, 298)]
    devices = [f"d{k}" for k in range(12)]
    dev_gw = spark.createDataFrame([(d, "g") for d in devices], "device_id string, gateway_id string")
    readings = spark.createDataFrame(rows, READ_SCHEMA)
    alerts = A.fleet_layout(readings, dev_gw, P, "event_id", 5)
    kept = A.dedup_alerts(A.valid_alerts(alerts), 30, laid=True)
    assert len(laid) == 2 and laid[1].count() < alerts.count() / 8
    pdf = pd.DataFrame([r[:3] + r[4:] for r in rows], columns=["device_id", "gateway_ts", "state", "event_id"])
    got = sorted((r.device_id, r.gateway_ts, r.state) for r in A.stamped(alerts).collect())
    assert got == sorted(x[:3] for x in _simulate(pdf, devices, P)) and len(got) > 2000
    cells = lambda df: sorted(map(str, A.stamped(df).collect()))
    assert cells(alerts) == cells(A.fleet_alerts(readings, dev_gw, P, "event_id", 1))
    assert cells(kept) == cells(A.dedup_alerts(A.stamped(alerts).orderBy("gateway_ts"), 30, num_partitions=3))
    assert 300 < kept.count() < len(got)


def test_json_round_trip_is_spread_over_all_partitions(spark):
    """Where the locations are not broadcast, the join's partitions are merged (here to one);
    the JSON step has the session's partitions, each with its share."""
    from conftest import SF_SMALL

    from fieldwatch.plans.queries import QUERIES

    limit = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, "-1")
    try:
        out = QUERIES["cleaned_alerts_scan"](spark, SF_SMALL)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset(limit)
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def _output_rows(df, node):
    """Rows that the plan's nodes of a kind put out when the plan is run."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        if "QueryStage" in p.getClass().getSimpleName():
            todo.append(p.plan())
            continue
        if p.nodeName() == node:
            found.append(p.metrics().apply("numOutputRows").value())
        children = p.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_count_below(spark):
    from fieldwatch.operators.ranks import count_below

    rng = np.random.default_rng(5)
    counted = sorted({int(x) for x in rng.integers(-500, 500, 200)})
    asked = [int(x) for x in rng.integers(-600, 600, 300)]
    frame = lambda v: spark.createDataFrame([(x,) for x in v], "v long")
    got = {r.value: (r.counted, r.below)
           for r in count_below(frame([*counted, *counted, None]), frame([*asked, None]), 7).collect()}
    assert got == {x: (x in counted, sum(c < x for c in counted)) for x in {*counted, *asked}}
    assert count_below(frame([]), frame([3])).collect()[0].below == 0
    assert count_below(frame([])).count() == 0
