"""Cells of the map's points, covers of its bounds, and the pushed scan."""

import random

import pytest

from fieldwatch.functions.cells import BITS, cell_of, cover
from fieldwatch.operators import dashboard as DB
from fieldwatch.plans.pipeline import Pipeline

SF = "/root/testdata/sf0.001"


def morton(lat, lon):
    """The cell by its definition, bit by bit."""
    at = lambda v, low, span: min(max(int((v - low) / span * (1 << BITS) // 1), 0), (1 << BITS) - 1)
    x, y = at(lon, -180.0, 360.0), at(lat, -90.0, 180.0)
    return sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(BITS))


def test_cells(spark):
    rng = random.Random(1)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(500)]
    points += [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (95.0, -200.0), (11.9, 108.1)]
    got = spark.createDataFrame([*points, (None, 1.0), (1.0, None)], "lat double, lon double").select(
        "lat", "lon", cell_of(DB.F.col("lat"), DB.F.col("lon")).alias("c")).collect()
    assert all(r.c == (None if r.lat is None or r.lon is None else morton(r.lat, r.lon)) for r in got)


@pytest.mark.parametrize("most", [1, 4, 16, 64])
def test_covers_hold_the_box(most):
    rng = random.Random(most)
    boxes = [DB.MAP_BUFFER, {"min_lon": -180.0, "max_lon": 180.0, "min_lat": -90.0, "max_lat": 90.0},
             {"min_lon": 5.0, "max_lon": 5.0, "min_lat": 5.0, "max_lat": 5.0}]
    for _ in range(40):
        lon, lat, size = rng.uniform(-180, 150), rng.uniform(-90, 70), 10 ** rng.uniform(-4, 1.4)
        boxes.append({"min_lon": lon, "max_lon": lon + size, "min_lat": lat, "max_lat": lat + size / 2})
    for box in boxes:
        ranges = cover(box, most)
        assert 1 <= len(ranges) <= most and ranges == sorted(ranges) and all(a <= b for a, b in ranges)
        corners = [(box[a], box[b]) for a in ("min_lat", "max_lat") for b in ("min_lon", "max_lon")]
        inside = [(rng.uniform(box["min_lat"], box["max_lat"]), rng.uniform(box["min_lon"], box["max_lon"])) for _ in range(50)]
        for lat, lon in corners + inside:
            c = morton(lat, lon)
            assert any(a <= c <= b for a, b in ranges)
    cells = lambda m: sum(b - a + 1 for a, b in cover(DB.MAP_BUFFER, m))
    assert cells(64) <= cells(16) <= cells(4) <= cells(1)  # more ranges fit closer
    assert cover({"min_lon": 2.0, "max_lon": 1.0, "min_lat": 0.0, "max_lat": 1.0}) == []


def test_bounds_reach_the_scan_of_a_stored_table(spark, tmp_path):
    docs = Pipeline(spark, SF).enriched_telemetry
    DB.write_map_table(docs, str(tmp_path / "map"))
    stored = spark.read.parquet(str(tmp_path / "map"))
    points = lambda df, box: sorted(map(tuple, DB.map_points(df, box).collect()))
    seen = docs.select(DB.F.min("device_location.lat"), DB.F.max("device_location.lat"),
                       DB.F.min("device_location.lon"), DB.F.max("device_location.lon")).first()
    lat, lon = (seen[0] + seen[1]) / 2, (seen[2] + seen[3]) / 2
    boxes = [{"min_lat": seen[0], "max_lat": lat, "min_lon": seen[2], "max_lon": lon},
             {"min_lat": -90.0, "max_lat": 90.0, "min_lon": -180.0, "max_lon": 180.0}, DB.MAP_BUFFER]
    for box in boxes:
        assert points(stored, box) == points(docs, box)
    assert len(points(stored, boxes[1])) > len(points(stored, boxes[0])) > 0
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = DB.map_points(stored, boxes[0])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    first, last = cover(boxes[0])[0]
    pushed = plan[plan.index("PushedFilters"):]
    assert f"GreaterThanOrEqual(device_location_cell,{first})" in pushed
    assert f"LessThanOrEqual(device_location_cell,{last})" in pushed
    assert plan.count("Scan parquet") == 1
