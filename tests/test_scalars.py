"""Scalar semantics: PERMISSIVE JSON, clamp, strict thresholds, tolerant
coercions, details normalisation."""

import math

import pytest
from pyspark.sql import functions as F

from fieldwatch.functions import jsonio
from fieldwatch.functions.scalars import (clamp, details_from_array, details_from_text, state_col, to_float,
                                          to_int, violations_col)


def test_permissive_json(spark):
    lines = ["", "not json", '{"device_id": "d", "gateway_ts": "x"}', '{"gateway_ts": 1.9, "state": "OK"}',
             '{"gateway_ts": "7"}', "[1, 2]", '{"device_id": "d", "extra": 1, "details": ["a", null]}',
             '{"details": "t"}']
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "seq long, value string")
    rows = {r.seq: r for r in jsonio.parse_alerts(df, keep=("seq",)).collect()}
    assert len(rows) == len(lines)  # nothing dropped
    for i in (0, 1, 5):
        assert all(rows[i][c] is None for c in ("device_id", "gateway_ts", "state", "details"))
    assert rows[2].device_id == "d" and rows[2].gateway_ts is None
    assert rows[3].gateway_ts is None and rows[3].state == "OK"
    assert rows[4].gateway_ts is None
    assert rows[6].details == ["a", None]
    assert rows[7].details is None


def test_json_roundtrip_omits_nulls(spark):
    df = spark.createDataFrame([("d", None, ["x", None])], "device_id string, state string, details array<string>")
    assert jsonio.rows_to_json(df).first().value == '{"device_id":"d","details":["x",null]}'


def test_clamp_and_strict_thresholds(spark):
    df = spark.createDataFrame([(-20.0, 50.0, 50.0, 200000.0), (0.0, 10.0, 5.0, 50.0), (45.0, 90.0, 80.0, 120000.0),
                                (45.001, 9.99, 80.5, 49.0), (None, 50.0, 50.0, 100.0)],
                               "temperature double, humidity double, soil_moisture double, light_level double")
    out = clamp(df).select("*", state_col().alias("state"), F.array_join(violations_col(), ",").alias("v")).collect()
    assert out[0].temperature == -10.0 and out[0].light_level == 120000.0
    assert out[0].state == "CRITICAL" and out[0].v == "temperature"  # clamped light can never exceed its bound
    assert out[1].state == "OK" and out[2].state == "OK"  # exactly at the limits: not critical
    assert out[3].v == "temperature,humidity,soil_moisture,light_level"
    assert out[4].temperature is None and out[4].state == "OK"


@pytest.mark.parametrize("text,as_int,as_float", [
    ("12.9", 12, 12.9), ("-3.7", -3, -3.7), ("", None, None), (None, None, None), ("abc", None, None),
    ("1e3", 1000, 1000.0), (" 12 ", 12, 12.0), ("null", None, None), ("NULL", None, None),
    ("1d", None, None), ("1_000", 1000, 1000.0), ("nan", None, "nan"), ("inf", None, math.inf),
])
def test_tolerant_casts(spark, text, as_int, as_float):
    r = spark.createDataFrame([(text,)], "v string").select(to_int("v").alias("i"), to_float("v").alias("f")).first()
    assert r.i == as_int
    if as_float == "nan":
        assert math.isnan(r.f)
    else:
        assert r.f == as_float


def test_details_normalisation(spark):
    df = spark.createDataFrame([(None, None), (["a", None], '["x", 1]'), ([], "abc")],
                               "arr array<string>, txt string")
    out = df.select(details_from_array("arr").alias("a"), details_from_text("txt").alias("t")).collect()
    assert out[0].a == [] and out[0].t == []
    assert out[1].a == ["a", "None"] and out[1].t == ["x", "1"]
    assert out[2].a == [] and out[2].t == ["abc"]


def test_index_dispatch_and_seconds(spark):
    from fieldwatch.functions.timefmt import iso_of_ms, ms_of_seconds
    from fieldwatch.operators.dimension import index_by
    b = spark.createDataFrame([("f1", "g1", "d1"), ("f2", "g2", "d1"), ("f1", "g1", "d2")],
                              "farm_id string, gateway_id string, device_id string")
    assert index_by(b, "device").count() == 2
    assert {r.device_id: r.gateway_id for r in index_by(b, "gateway").collect()} == {"d1": "g2", "d2": "g1"}
    with pytest.raises(ValueError):
        index_by(b, "farm")
    r = spark.createDataFrame([(1704067207.1799,)], "s double").select(
        ms_of_seconds(F.col("s")).alias("ms"), iso_of_ms(ms_of_seconds(F.col("s"))).alias("iso")).first()
    assert r.ms == 1704067207179 and r.iso == "2024-01-01T00:00:07.179000+00:00"


def test_integer_columns_stay_exact(spark):
    from fieldwatch.functions.scalars import to_float_of, to_int_of
    big = 2 ** 62 + 1
    df = spark.createDataFrame([(big, 12.9, "7.5")], "a long, b double, c string")
    r = df.select(to_int_of(df, "a").alias("a"), to_int_of(df, "b").alias("b"), to_int_of(df, "c").alias("c"),
                  to_float_of(df, "c").alias("f")).first()
    assert r.a == big and r.b == 12 and r.c == 7 and r.f == 7.5
