"""Panels from the batches' partial aggregates equal the panels over all documents."""

import pytest
from pyspark.sql import functions as F

from fieldwatch.config import DAY_MS
from fieldwatch.operators import dashboard as DB
from fieldwatch.operators import partials as P
from fieldwatch.plans.pipeline import Pipeline

SF = "/root/testdata/sf0.001"


def same(a, b):
    """Equal rows, doubles to nine places."""
    norm = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert a.columns == b.columns and norm(a) == norm(b) and a.count() > 0


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents and alerts, and the partials of five batches of each, one of them replayed."""
    root = tmp_path_factory.mktemp("partials")
    p = Pipeline(spark, SF)
    p.enriched_telemetry.write.parquet(f"{root}/docs")
    p.deduped_alerts.write.parquet(f"{root}/alerts")
    docs, alerts = spark.read.parquet(f"{root}/docs"), spark.read.parquet(f"{root}/alerts")
    for k in (0, 1, 2, 2, 3, 4):
        own = lambda df: df.filter(F.pmod(F.xxhash64("device_id", "gateway_ts"), F.lit(5)) == k)
        P.write_partials(P.telemetry_partials(own(docs)), f"{root}/t", k)
        P.write_partials(P.alert_partials(own(alerts)), f"{root}/a", k)
    return docs, alerts, f"{root}/t", f"{root}/a"


def test_panels(spark, tables):
    docs, alerts, t, a = tables
    read = P.read_partials(spark, t)
    for metric in P.METRICS[:2]:
        same(P.median_by_farm_gateway(read, metric, 3, 2), DB.median_by_farm_gateway(docs, metric, 3, 2))
    same(P.record_share(read, 3, 2), DB.record_share(docs, 3, 2))
    same(P.critical_by_gateway(P.read_partials(spark, a), 4), DB.critical_by_gateway(alerts, 4))
    # no document is read, and values that repeat are one row
    plan = P.record_share(read, 3, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "device_id" not in plan


def test_a_span_reads_its_buckets_only(spark, tables):
    docs, _, t, _ = tables
    stamps = docs.select(F.min("gateway_ts").alias("lo"), F.max("gateway_ts").alias("hi")).first()
    start = (stamps.lo // DAY_MS + 3) * DAY_MS
    end = start + 9 * DAY_MS
    read = P.read_partials(spark, t, start, end)
    same(P.record_share(read, 3, 2), DB.record_share(docs.filter((F.col("gateway_ts") >= start) & (F.col("gateway_ts") < end)), 3, 2))
    plan = read._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert f">= {start}" in pruned and f"< {end}" in pruned  # folders, not rows
