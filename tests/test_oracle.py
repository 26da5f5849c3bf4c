"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01; tools/oracle_check.py runs it
on any scale)."""

import duckdb
import pytest

from tools.oracle_check import TABLES, compare

SF = "/root/testdata/sf0.001"


def _keys():
    from __spark_entry__ import oracle_sql
    return sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    from fieldwatch.plans import oracle, queries
    assert set(queries.QUERIES) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", _keys())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    ok, msg, _, _ = compare(spark, con, name, queries()[name], oracle_sql()[name], SF)
    assert ok, msg


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["farm", "gateway", "median_light_level_avg"]


def test_hot_devices_can_be_split(spark):
    """The dimension side of a join with readings is a scan under the exchange, not an
    aggregate over it, so adaptive execution may split a hot device."""
    from fieldwatch.operators import dimension as D
    from fieldwatch.plans.pipeline import Pipeline

    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        p = Pipeline(spark, SF)
        for df in (D.gateway_lookup(p.raw_readings, p.gateway_table), p.enriched_telemetry):
            plan = df._jdf.queryExecution().executedPlan().toString()
            join = plan[plan.rindex("SortMergeJoin"):].splitlines()
            right = [x for x in join if "Scan parquet" in x or "Aggregate" in x or "Exchange" in x]
            assert "Exchange" in right[-2] and "Scan parquet" in right[-1]
    finally:
        spark.conf.set(key, old)


def test_record_share_and_map_points_read_their_table_once(spark, tmp_path):
    from fieldwatch.operators import dashboard as DB
    from fieldwatch.plans.pipeline import Pipeline

    Pipeline(spark, SF).enriched_telemetry.write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("parquet")
    assert scans(DB.map_points(t)) == 1
    sliced = DB.time_slice(t, 1704067200000, 1706659200000)
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(gateway_ts" in plan and "LessThan(gateway_ts" in plan  # pushed to the scan
