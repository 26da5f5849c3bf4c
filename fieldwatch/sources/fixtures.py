"""Model tables derived from the driver's parquet tables (mapping in FIXTURES.md).

``events`` is the reading stream; ``customer -> nation -> region`` and blocks of
customer keys are the device -> gateway -> site hierarchy; ``supplier`` gives the
alert routes.
Everything is a lazy DataFrame over the parquet scans, so filters and column
pruning reach the readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.config import ALERT_INDEX, DAY_MS, FIXTURE_PARAMS, TELEMETRY_INDEX, Params
from fieldwatch.functions.scalars import clamp, state_col, violations_col
from fieldwatch.functions.timefmt import epoch_ms, iso_of_ms, iso_of_ts, ntz_of_ms, ts_of_ms, window_end_ms

# FIXED VALUES of the fixture mapping (FIXTURES.md part 2)
SITE_LAT0, SITE_LAT_STEP = 11.5, 0.6
SITE_LON0, SITE_LON_STEP = 107.8, 0.2
BLOCK_OFFSET_STEP = 0.01
GATEWAY_OFFSET_STEP = 0.001
DEVICE_OFFSET_STEP = 0.00001
DEVICE_OFFSET_MOD = 50
CUSTOMERS_PER_BLOCK = 250
NATIONS = 25
LISTED_TWICE_SEGMENT = "MACHINERY"
ROUTE_REGIONS = 4
SUPPLIERS_PER_BLOCK = 10
EMAIL_DOMAIN = "@example.com"
BAD_LATENCY_MOD = 101
NOT_JSON_MOD, BAD_TS_MOD, NO_DETAILS_MOD = 97, 89, 83


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. The DataFrame (not its data) is reused per session and
    path, so the footer / schema job of ``spark.read.parquet`` runs once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _id(prefix: str, c: str):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


# --- dimensions (S4) ---------------------------------------------------------

def _lat_lon(region, block, *offsets):
    """Coordinates of a farm, with the offsets of what lies on it."""
    lat = F.lit(SITE_LAT0) + F.lit(SITE_LAT_STEP) * region.cast("double")
    lon = F.lit(SITE_LON0) + F.lit(SITE_LON_STEP) * region.cast("double")
    for off in (F.lit(BLOCK_OFFSET_STEP) * block.cast("double"), *offsets):
        lat, lon = lat + off, lon + off
    return lat.alias("latitude"), lon.alias("longitude")


def _listings(spark, sf_dir) -> DataFrame:
    """Every customer with the (region, nation, block) it is listed under; those
    of one market segment are listed a second time, under the next nation. A block
    is a run of customer keys, so farms and gateways grow with the customers."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey",
        F.floor(F.col("c_custkey") / CUSTOMERS_PER_BLOCK).cast("long").alias("block"))
    moved = F.when(F.col("c_mktsegment") == LISTED_TWICE_SEGMENT, (F.col("c_nationkey") + 1) % NATIONS)
    # null where there is no second listing: dropped by the join
    both = c.withColumn("nation", F.explode(F.array("c_nationkey", moved)))
    # nation has 25 rows: a fixed-size dimension, broadcast is safe
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    return both.join(n, F.col("nation") == F.col("n_nationkey"))


def _farm_id():
    return F.concat(F.lit("farm-"), F.col("n_regionkey").cast("string"), F.lit("-"), F.col("block").cast("string"))


def _gateway_id():
    return F.concat(F.lit("gateway-"), F.col("n_nationkey").cast("string"), F.lit("-"),
                    F.col("block").cast("string"))


def farms(spark, sf_dir) -> DataFrame:
    r = _listings(spark, sf_dir).select("n_regionkey", "block").distinct()
    return r.select(_farm_id().alias("id"), *_lat_lon(F.col("n_regionkey"), F.col("block")))


def _gateway_offset():
    return F.lit(GATEWAY_OFFSET_STEP) * F.col("n_nationkey").cast("double")


def gateways(spark, sf_dir) -> DataFrame:
    g = _listings(spark, sf_dir).select("n_regionkey", "n_nationkey", "block").distinct()
    return g.select(_gateway_id().alias("id"), *_lat_lon(F.col("n_regionkey"), F.col("block"), _gateway_offset()))


def devices(spark, sf_dir) -> DataFrame:
    """Every customer's device, placed at the gateway of its first listing."""
    c = _listings(spark, sf_dir).filter(F.col("nation") == F.col("c_nationkey"))
    own = F.lit(DEVICE_OFFSET_STEP) * (F.col("c_custkey") % DEVICE_OFFSET_MOD).cast("double")
    return c.select(_id("device-", "c_custkey").alias("id"),
                    *_lat_lon(F.col("n_regionkey"), F.col("block"), _gateway_offset(), own))


def bridge(spark, sf_dir) -> DataFrame:
    """farm_gateway_device rows: the listings of all customers whose account is
    not overdrawn. Overdrawn customers that send readings are the unknown devices;
    customers without events are the never-seen ones."""
    return _listings(spark, sf_dir).filter(F.col("c_acctbal") >= 0).select(
        _farm_id().alias("farm_id"), _gateway_id().alias("gateway_id"),
        _id("device-", "c_custkey").alias("device_id"))


def routes(spark, sf_dir) -> DataFrame:
    """alert_routes(farm_id, email): two or three suppliers to a farm; overdrawn
    ones are listed twice, and farms of the last region have none."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    farm = F.concat(F.lit("farm-"), (F.col("s_suppkey") % ROUTE_REGIONS).cast("string"), F.lit("-"),
                    F.floor(F.col("s_suppkey") / SUPPLIERS_PER_BLOCK).cast("string"))
    times = F.when(F.col("s_acctbal") < 0, 2).otherwise(1)
    return s.select(farm.alias("farm_id"), F.concat(F.col("s_name"), F.lit(EMAIL_DOMAIN)).alias("email"),
                    F.explode(F.array_repeat(F.lit(1), times)).alias("_n")).drop("_n")


# --- readings ------------------------------------------------------------------

def readings(spark, sf_dir) -> DataFrame:
    """Device readings before the gateway: one per event, ``event_id`` = arrival order."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    ms = epoch_ms(F.col("ts"))
    return ev.select(
        F.col("event_id"),
        F.concat(F.lit("device-"), F.col("user_id").cast("string")).alias("device_id"),
        ms.alias("device_ts"),
        iso_of_ts(F.col("ts")).alias("device_ts_iso"),
        (F.col("value") / F.lit(5.0)).alias("temperature"),
        k.alias("humidity"),
        (F.lit(1.0) + ((F.col("event_id") * 37) % 84).cast("double")).alias("soil_moisture"),
        (F.lit(50.0) + F.col("value") * F.lit(250.0)).alias("light_level"),
        F.lit("OK").alias("device_status"),
    )


def gateway_readings(spark, sf_dir, params: Params = FIXTURE_PARAMS) -> DataFrame:
    """Clamped readings with the gateway stamp (window end) and classification."""
    r = clamp(readings(spark, sf_dir), params.clamp_bounds)
    gts = window_end_ms(F.col("device_ts"), params.window_ms)
    return r.select("*", gts.alias("gateway_ts"), iso_of_ms(gts).alias("gateway_ts_iso"),
                    state_col(params.thresholds).alias("state"),
                    violations_col(params.thresholds).alias("details"))


# --- evaluation inputs -------------------------------------------------------------

def latency_source(spark, sf_dir) -> DataFrame:
    """Stored documents with their four stamps; ``error`` events are alert
    documents, the rest telemetry documents; ``event_id % 101 = 0`` lacks a stamp."""
    ev = table(spark, sf_dir, "events")
    gw = epoch_ms(F.col("ts"))
    ingest = gw + F.col("event_id") % 500
    before = ingest + (F.col("event_id") * 7) % 900
    created = before + F.get_json_object("props", "$.k").cast("long")
    return ev.select(
        gw.alias("gateway_ts"),
        ingest.alias("ts_kafka_ingest"),
        F.when(F.col("event_id") % BAD_LATENCY_MOD != 0, before).alias("ts_before_es"),
        ts_of_ms(created).alias("created_at"),
        F.when(F.col("event_type") == "error", F.lit(ALERT_INDEX)).otherwise(F.lit(TELEMETRY_INDEX)).alias("index"),
    )


def counter_samples(spark, sf_dir) -> DataFrame:
    """Cumulative indexing counters sampled once a day per index."""
    ev = table(spark, sf_dir, "events")
    idx = F.when(F.col("event_type") == "error", F.lit(ALERT_INDEX)).otherwise(F.lit(TELEMETRY_INDEX))
    daily = (ev.select(idx.alias("index"),
                       ntz_of_ms(F.floor(epoch_ms(F.col("ts")) / F.lit(DAY_MS)).cast("long") * F.lit(DAY_MS))
                       .alias("day"),
                       F.get_json_object("props", "$.k").cast("long").alias("k"))
             .groupBy("index", "day").agg(F.count("*").alias("n"), F.sum("k").alias("t")))
    from pyspark.sql import Window
    w = Window.partitionBy("index").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    # one row per (index, day): the running sums are over at most span/day rows per index
    # sample_ts stays a UTC wall-clock TIMESTAMP_NTZ: independent of the session time zone
    return daily.select("index", F.col("day").alias("sample_ts"),
                        F.sum("n").over(w).cast("long").alias("total"),
                        F.sum("t").over(w).cast("long").alias("time_ms"))


# --- raw message lines (JSON text, with malformed rows) ---------------------------

def raw_alert_lines(spark, sf_dir, params: Params = FIXTURE_PARAMS, device_gateway: DataFrame | None = None) -> DataFrame:
    """One raw alert message per reading as JSON text (column ``value``).

    ``event_id % 97 = 0`` is not JSON, ``% 89 = 0`` carries ``gateway_ts`` as
    the text "x", ``% 83 = 0`` has no ``details`` field.
    """
    g = gateway_readings(spark, sf_dir, params)
    if device_gateway is not None:
        g = g.join(device_gateway, "device_id", "left")
    else:
        g = g.withColumn("gateway_id", F.lit(None).cast("string"))
    ts_field = F.when(F.col("event_id") % BAD_TS_MOD == 0, F.lit("x")).otherwise(F.col("gateway_ts").cast("string"))
    body = F.to_json(F.struct(
        "device_id", "gateway_id", ts_field.alias("gateway_ts"), "gateway_ts_iso", "state",
        F.when(F.col("event_id") % NO_DETAILS_MOD != 0, F.col("details")).alias("details")))
    # to_json writes the numeric stamp as a string; turn it back into a number
    body = F.regexp_replace(body, r'"gateway_ts":"([0-9]+)"', '"gateway_ts":$1')
    value = F.when(F.col("event_id") % NOT_JSON_MOD == 0, F.lit("not json")).otherwise(body)
    return g.select("event_id", value.alias("value"))
