"""The parallel ordered scans against plain sequential folds, with one hot key
split over many partitions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldwatch.operators import ordered as O
from folds import greedy_thin_reference
from fieldwatch.operators.quantiles import approx_median, exact_percentiles, value_counts


def _rows(seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for k, n in [("hot", 2500), ("a", 40), ("b", 7), ("c", 1), ("d", 300)]:
        t = np.sort(rng.integers(0, 20000, n))
        th = rng.choice([O.ALWAYS, 30, 100, 0], size=n, p=[0.05, 0.5, 0.4, 0.05])
        for i in range(n):
            rows.append((k, int(t[i]), i, int(th[i]), str(int(th[i]) % 7)))
    return pd.DataFrame(rows, columns=["k", "t", "seq", "theta", "s"])


@pytest.mark.parametrize("nparts", [1, 5, 32])
def test_greedy_thin_matches_sequential(spark, nparts):
    pdf = _rows()
    laid = O.ordered_layout(spark.createDataFrame(pdf), "k", ["t", "seq"], nparts)
    got = O.greedy_thin(laid, "k", ["t", "seq"], "t", "theta", e_init=0).select("k", "seq").toPandas()
    ref = greedy_thin_reference(pdf, "k", ["t", "seq"], "t", "theta", e_init=0)
    exp = pdf.loc[ref[ref].index, ["k", "seq"]]
    assert set(map(tuple, got.values.tolist())) == set(map(tuple, exp.values.tolist()))


def test_hot_key_spans_partitions(spark):
    pdf = _rows()
    laid = O.ordered_layout(spark.createDataFrame(pdf), "k", ["t", "seq"], 16)
    parts = laid.filter("k = 'hot'").select("_pid").distinct().count()
    assert parts > 4


@pytest.mark.parametrize("nparts", [1, 7, 32])
def test_keyed_lag_matches_shift(spark, nparts):
    pdf = _rows(2)
    laid = O.ordered_layout(spark.createDataFrame(pdf), "k", ["t", "seq"], nparts)
    got = O.keyed_lag(laid, "k", ["t", "seq"], "s", "prev").toPandas().sort_values(["k", "t", "seq"])
    exp = pdf.sort_values(["k", "t", "seq"]).groupby("k")["s"].shift(1)
    assert (got["prev"].fillna("-").values == exp.fillna("-").values).all()


def test_thin_segments_equals_reference():
    pdf = _rows(3).sort_values(["k", "t", "seq"], ignore_index=True)
    seg = O._segments(pdf["k"].to_numpy())
    got = O.thin_segments(seg, pdf["t"].to_numpy(), pdf["theta"].to_numpy(), 0)
    ref = greedy_thin_reference(pdf, "k", ["t", "seq"], "t", "theta", e_init=0)
    assert (got == ref.loc[pdf.index].to_numpy()).all()


def _percentiles(spark, pdf, groups, schema):
    rows = [tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, schema).repartition(4)
    return exact_percentiles(df, groups, "v", [0.5, 0.9, 0.95], ["p50", "p90", "p95"], 8).toPandas()


def test_exact_percentiles(spark):
    rng = np.random.default_rng(5)
    g = rng.choice(["x", "y", "z"], size=3000, p=[0.8, 0.15, 0.05])
    pdf = pd.DataFrame({"g": g, "v": rng.normal(size=3000).round(3)})
    got = _percentiles(spark, pdf, ["g"], "g string, v double").set_index("g").sort_index()
    for key, grp in pdf.groupby("g"):
        for p, name in [(0.5, "p50"), (0.9, "p90"), (0.95, "p95")]:
            assert got.loc[key, name] == pytest.approx(np.percentile(grp["v"], p * 100), abs=1e-9)


def test_percentiles_keep_the_null_group_and_ignore_null_values(spark):
    rows = [("a", 1.0), ("a", 3.0), (None, 2.0), (None, 4.0), (None, None), ("b", None)]
    got = _percentiles(spark, pd.DataFrame(rows, columns=["g", "v"], dtype=object), ["g"], "g string, v double")
    assert {(r.g, r.p50) for r in got.itertuples()} == {("a", 2.0), (None, 3.0)}


def test_tied_values_are_one_row_of_the_layout(spark):
    """90 % equal values: combined before the layout, so no partition holds them."""
    rng = np.random.default_rng(6)
    v = np.where(rng.random(20_000) < 0.9, 50.0, rng.integers(0, 1000, 20_000))
    pdf = pd.DataFrame({"g": "x", "v": v.astype(float)})
    counts = value_counts(spark.createDataFrame(pdf), ["g"], "v")
    assert counts.count() == len(np.unique(v))
    laid = O.ordered_layout(counts, ["g"], ["v"], 16)
    assert laid.groupBy("_pid").count().agg({"count": "max"}).first()[0] < 4 * len(np.unique(v)) / 16
    got = _percentiles(spark, pdf, ["g"], "g string, v double").iloc[0]
    assert got.p50 == 50.0 and got.p95 == pytest.approx(np.percentile(v, 95))


def test_approx_median(spark):
    df = spark.range(10_001).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    got = approx_median(df, ["g"], "v").collect()
    assert len(got) == 3 and all(abs(r["median"] - 5000) <= 10 for r in got)


@pytest.mark.parametrize("nparts", [1, 5, 32])
def test_small_batches_carry_the_state(spark, nparts):
    """Keys that span batches and partitions, with the previous row's value deciding."""
    pdf = _rows(4)
    pdf["theta"] = 40
    pdf["s"] = np.where(np.arange(len(pdf)) % 211 < 190, "x", None)
    pdf.loc[pdf.index % 97 == 0, "s"] = "y"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        laid = O.ordered_layout(spark.createDataFrame(pdf, "k string, t long, seq long, theta long, s string"), "k",
                                ["t", "seq"], nparts)
        got = O.greedy_thin(laid, "k", ["t", "seq"], "t", "theta", change="s").select("k", "seq").toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = pdf.sort_values(["k", "t", "seq"], ignore_index=True)
    prev = rows.groupby("k")["s"].shift(1)
    differs = prev.isna() | ((prev != rows["s"]) & rows["s"].notna())
    rows["theta"] = np.where(differs, O.ALWAYS, rows["theta"])
    exp = rows[greedy_thin_reference(rows, "k", ["t", "seq"], "t", "theta")]
    assert set(map(tuple, got.values.tolist())) == set(map(tuple, exp[["k", "seq"]].values.tolist()))
    assert 0 < len(exp) < len(rows)


@pytest.mark.parametrize("run", [
    lambda laid: O.greedy_thin(laid, "k", ["t", "seq"], "t", "theta"),
    lambda laid: O.keyed_lag(laid, "k", ["t", "seq"], "s", "prev")])
def test_a_pass_holds_one_batch(spark, monkeypatch, run):
    """The rows of a batch leave before the next is asked for, however many a partition has."""
    laid = O.ordered_layout(spark.createDataFrame(_rows(5)), "k", ["t", "seq"], 1)
    passes = []
    for name in ("mapInArrow", "mapInPandas"):
        def kept(self, fn, *args, real=getattr(type(laid), name), **kw):
            passes.append((self, fn))
            return real(self, fn, *args, **kw)
        monkeypatch.setattr(type(laid), name, kept)
    run(laid)
    rows, fn = passes[-1]
    batches, asked = rows.toArrow().to_batches(max_chunksize=50), []
    out = fn(asked.append(1) or b for b in batches)
    next(out)
    assert len(asked) == 1
    assert sum(1 for _ in out) and len(asked) == len(batches) > 50


@pytest.mark.parametrize("nparts", [1, 5, 32])
def test_keys_that_share_a_hash(spark, monkeypatch, nparts):
    """The layout's hash brings keys together that are not equal; the passes tell them apart."""
    monkeypatch.setattr(O, "_hash", lambda key: F.length(F.col(key)).cast("long"))
    pdf = _rows(6)
    laid = O.ordered_layout(spark.createDataFrame(pdf), "k", ["t", "seq"], nparts)
    got = O.greedy_thin(laid, "k", ["t", "seq"], "t", "theta", e_init=0).select("k", "seq").toPandas()
    ref = greedy_thin_reference(pdf, "k", ["t", "seq"], "t", "theta", e_init=0)
    assert set(map(tuple, got.values.tolist())) == set(map(tuple, pdf.loc[ref[ref].index, ["k", "seq"]].values.tolist()))
    lag = O.keyed_lag(laid, "k", ["t", "seq"], "s", "prev").toPandas().sort_values(["k", "t", "seq"])
    exp = pdf.sort_values(["k", "t", "seq"]).groupby("k")["s"].shift(1)
    assert (lag["prev"].fillna("-").values == exp.fillna("-").values).all()


def test_summaries_read_only_the_keys_at_the_ends(spark, monkeypatch):
    """Of 400 devices in 4 partitions the summary pass gets those at the ends of one, in
    layout order; the lag has no Python pass for its summary."""
    rows = [(f"device-{i % 400}", i, i, 3) for i in range(4000)]
    laid = O.ordered_layout(spark.createDataFrame(rows, "k string, t long, seq long, theta long"), "k", ["t", "seq"], 4)
    read, real = [], type(laid).mapInArrow
    monkeypatch.setattr(type(laid), "mapInArrow", lambda df, *args: read.append(df) or real(df, *args))
    out = O.greedy_thin(laid, "k", ["t", "seq"], "t", "theta")
    assert len(read) == 2 and read[1].count() == len(rows) and out.count() == len(rows)
    ends = read[0].toPandas()
    assert ends["k"].nunique() <= 8 and len(ends) == 10 * ends["k"].nunique()
    assert all(p["_pos"].is_monotonic_increasing for _, p in ends.groupby("_pid"))
    read.clear()
    O.keyed_lag(laid.withColumn("s", F.lit("x")), "k", ["t", "seq"], "s", "prev")
    assert len(read) == 1


def test_batches_of_layouts_are_cut_by_rows(spark, monkeypatch):
    """The limit in bytes, for which Spark measures the batch after every row, is off while a
    layout or fold is written, unless the session sets one or has no limit in rows."""
    size, rows = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"
    df = spark.createDataFrame([("a", 1)], "k string, t long")
    seen, real = [], type(df).checkpoint
    monkeypatch.setattr(type(df), "checkpoint", lambda d, *a, **kw: seen.append(spark.conf.get(size, None)) or real(d, *a, **kw))
    O.ordered_layout(df, "k", ["t"], 1)
    assert seen == [str(2 ** 31 - 1)] and spark.conf.get(size, None) is None
    for key, value in ((size, "1m"), (rows, "0")):
        spark.conf.set(key, value)
        try:
            before = spark.conf.get(size, None)
            O.ordered_layout(df, "k", ["t"], 1)
            assert seen.pop() == before == spark.conf.get(size, None)
        finally:
            spark.conf.unset(key)
