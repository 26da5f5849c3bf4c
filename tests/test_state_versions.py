"""State of the streaming jobs: versions, the dedup step, its end."""

import os

import numpy as np
import pandas as pd
import pytest

from fieldwatch.operators import alerts as A
from fieldwatch.operators.ordered import ROWS_PER_TASK_CONF
from fieldwatch.streaming.state import STATE_SCHEMA, dedup_batch, dedup_step, expired
from fieldwatch.streaming.versions import KeyedVersions

ALERTS = "device_id string, gateway_ts long, state string, seq long"


def test_versions(spark, tmp_path):
    """Random changes, read back at every version; merges, replays and removals in between."""
    rng = np.random.default_rng(2)
    t = KeyedVersions(spark, str(tmp_path), "k", "k string, n long", every=4)
    want, history = {}, []
    frame = lambda d: spark.createDataFrame(list(d.items()), "k string, n long")
    for v in range(11):
        changes = {f"k{rng.integers(0, 9)}": int(rng.integers(0, 99)) for _ in range(int(rng.integers(0, 4)))}
        if v % 3 == 2:  # a first attempt that is replayed with other rows
            t.write(v, frame({"k0": -1, "lost": -1}))
        t.write(v, frame(changes))
        want = {**want, **changes}
        history.append(want)
        assert {r.k: r.n for r in t.read(v).collect()} == want
        if v:
            assert {r.k: r.n for r in t.read(v - 1).collect()} == history[v - 1]
        t.remove_before(v - 1)
    assert sorted(os.listdir(tmp_path / "full")) == ["v=7"]
    assert sorted(os.listdir(tmp_path / "delta")) == ["v=10", "v=8", "v=9"]
    os.rename(tmp_path / "delta" / "v=9", tmp_path / "gone")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        t.read(10).collect()


def test_what_is_of_no_use_ends_with_a_merge(spark, tmp_path):
    t = KeyedVersions(spark, str(tmp_path), "k", "k string, n long", every=3)
    for v in range(6):
        t.write(v, spark.createDataFrame([(f"k{v}", v)], "k string, n long"), keep=None if v < 5 else A.F.col("n") >= 3)
    assert sorted(r.n for r in t.read(5).collect()) == [3, 4, 5]


def fold(batches, window):
    """W1 over micro-batches with one device's step at a time."""
    state, out = {}, []
    for batch in batches:
        pdf = pd.DataFrame(batch, columns=["device_id", "gateway_ts", "state", "seq"])
        for d, own in pdf.groupby("device_id"):
            kept, *state[d] = dedup_batch(own, *state.get(d, (None, None)), window)
            out += list(kept.itertuples(index=False, name=None))
    return sorted(out), {d: tuple(s) for d, s in state.items() if s[1] is not None}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_steps_equal_the_fold_of_each_device(spark, seed):
    """Late rows, ties, devices that come and go; batches cut anywhere; a hot device."""
    rng = np.random.default_rng(seed)
    batches = []
    for k in range(4):
        rows = [(str(rng.choice(["hot", "a", "b", "c", "d"], p=[.5, .2, .1, .1, .1])),
                 int(100 * k + rng.integers(-150, 100)), str(rng.choice(["OK", "CRITICAL"])), 1000 * k + n) for n in range(80)]
        batches.append([r for r in rows if r[0] != f"{'abcd'[k]}"])
    want, want_state = fold(batches, 30)
    state, got = spark.createDataFrame([], STATE_SCHEMA), []
    have = {}
    for batch in batches:
        kept, changes = dedup_step(spark.createDataFrame(batch, ALERTS), 30, state, num_partitions=7)
        got += [tuple(r) for r in kept.collect()]
        have |= {r.device_id: (r.kept_state, r.kept_ts) for r in changes.collect()}
        state = spark.createDataFrame([(d, *s) for d, s in have.items()], STATE_SCHEMA)
    assert sorted(got) == want and have == want_state


def test_steps_equal_the_batch_operator_and_state_ends(spark, tmp_path):
    """Alerts in order, cut into batches: the kept ones are W1's, while the state table falls
    back to the devices that alerted within the window."""
    rng = np.random.default_rng(7)
    rows = [(f"d{n // 10}", int(10 * n + rng.integers(0, 9)), str(rng.choice(["OK", "CRITICAL"])), n) for n in range(300)]
    window, lateness = 60, 20
    t = KeyedVersions(spark, str(tmp_path), "device_id", STATE_SCHEMA, every=2)
    got, seen, sizes = [], None, []
    for v, at in enumerate(range(0, 300, 50)):
        batch = rows[at:at + 50]
        state = t.read(v - 1).where(~expired(seen, window, lateness))
        kept, changes = dedup_step(spark.createDataFrame(batch, ALERTS), window, state)
        got += [tuple(r) for r in kept.collect()]
        seen = max(r[1] for r in batch)
        t.write(v, changes, ~expired(seen, window, lateness))
        sizes.append(t.read(v).count())
    whole = A.dedup_alerts(spark.createDataFrame(rows, ALERTS), window)
    assert sorted(got) == sorted(tuple(r) for r in whole.select("device_id", "gateway_ts", "state", "seq").collect())
    assert 1 <= min(sizes[1::2]) and max(sizes[1::2]) <= 2  # of 10, 20 and 30 devices


def test_a_device_with_most_of_a_batch_is_split(spark):
    """No task holds more than its share of the rows of one device."""
    rng = np.random.default_rng(9)
    rows = [("hot" if n % 10 else f"d{n % 70}", n // 3, str(rng.choice(["OK", "CRITICAL"])), n) for n in range(20_000)]
    spark.conf.set(ROWS_PER_TASK_CONF, "500")
    try:
        df = spark.createDataFrame(rows, ALERTS)
        kept, _ = dedup_step(df, 30, spark.createDataFrame([("hot", "OK", -5)], STATE_SCHEMA))
        sizes = kept.groupBy(A.F.spark_partition_id()).count().collect()
        assert len(sizes) >= 30 and max(r["count"] for r in sizes) < 2_000
        pdf = pd.DataFrame([r for r in rows if r[0] == "hot"], columns=["device_id", "gateway_ts", "state", "seq"])
        want, _, _ = dedup_batch(pdf, "OK", -5, 30)
        assert sorted(r.seq for r in kept.where("device_id = 'hot'").collect()) == sorted(want["seq"])
    finally:
        spark.conf.unset(ROWS_PER_TASK_CONF)
