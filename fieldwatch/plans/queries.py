"""Registered queries: one per operator of the inventory, each ``(spark,
sf_dir) -> DataFrame`` over the driver's tables.

Outputs are flattened for comparison with the SQL oracle: structs become
``<name>_lat`` / ``<name>_lon``, string arrays are joined with ``|`` and
doubles are rounded to 6 decimals (summation order may move the last bits).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.config import (ALERT_INDEX, DASHBOARD_FARM_SIZE, DASHBOARD_GATEWAY_SIZE_COUNT,
                               DASHBOARD_GATEWAY_SIZE_MEDIAN, FIXTURE_PARAMS, METRICS, STATE_OFFLINE, TELEMETRY_INDEX)
from fieldwatch.functions import jsonio
from fieldwatch.functions.scalars import (clamp, conform, details_from_array, to_float, to_int)
from fieldwatch.operators import alerts as A
from fieldwatch.operators import dashboard as DB
from fieldwatch.operators import dimension as D
from fieldwatch.operators import evaluation as E
from fieldwatch.operators import notify as N
from fieldwatch.operators import telemetry as T
from fieldwatch.plans.pipeline import Pipeline
from fieldwatch.schemas import ALERT_DOC, LOCATION_COLUMNS, STAT_COLUMNS, TELEMETRY_DOC, TELEMETRY_MSG
from fieldwatch.session import default_parallelism

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# dashboard sizes on the fixture: the smallest tables have 5 farms x 5 gateways,
# which never fill the saved panels' 5 and 9; 3 and 2 make Other fire
FIX_FARM_SIZE, FIX_GATEWAY_SIZE = 3, 2
FIX_ALPHA_SIZE = 6
# a map view over the fixture's first two farms
FIX_BBOX = {"min_lat": 11.4, "max_lat": 12.2, "min_lon": 107.7, "max_lon": 108.1}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _p(spark, sf_dir) -> Pipeline:
    return Pipeline(spark, sf_dir, FIXTURE_PARAMS)


def r6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def joined(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c, "|")


def flat_points(names=LOCATION_COLUMNS) -> list[Column]:
    out = []
    for n in names:
        base = n.replace("_location", "")
        out += [r6(F.col(f"{n}.lat")).alias(f"{base}_lat"), r6(F.col(f"{n}.lon")).alias(f"{base}_lon")]
    return out


# --- sources --------------------------------------------------------------------------------

@query("dim_scan")
def q_dim_scan(spark, sf_dir):
    p = _p(spark, sf_dir)
    parts = [(p.farm, "farm"), (p.gateway, "gateway"), (p.device, "device")]
    out = None
    for df, kind in parts:
        d = df.select(F.lit(kind).alias("kind"), "id", r6("latitude").alias("latitude"),
                      r6("longitude").alias("longitude"))
        out = d if out is None else out.unionByName(d)
    return out


@query("bridge_scan")
def q_bridge(spark, sf_dir):
    return _p(spark, sf_dir).bridge


@query("routes_scan")
def q_routes(spark, sf_dir):
    return _p(spark, sf_dir).routes


@query("device_index")
def q_device_index(spark, sf_dir):
    return D.device_index(_p(spark, sf_dir).bridge)


@query("gateway_index")
def q_gateway_index(spark, sf_dir):
    return _p(spark, sf_dir).dev_gw


@query("farm_ids")
def q_farm_ids(spark, sf_dir):
    return D.farm_ids(_p(spark, sf_dir).farm)


@query("counter_samples")
def q_counter_samples(spark, sf_dir):
    return _p(spark, sf_dir).counter_samples


@query("recent_documents")
def q_recent(spark, sf_dir):
    src = _p(spark, sf_dir).latency_source
    as_of = src.select(F.max("created_at")).scalar()
    return E.recent(src, as_of).select("gateway_ts", "ts_kafka_ingest", "ts_before_es", "created_at", "index")


# --- projections / scalars --------------------------------------------------------------------

@query("clamp_readings")
def q_clamp(spark, sf_dir):
    r = _p(spark, sf_dir).readings
    return r.select("event_id", "device_id", *[r6(m).alias(m) for m in
                                               ("temperature", "humidity", "soil_moisture", "light_level")])


@query("classify_state")
def q_classify(spark, sf_dir):
    return _p(spark, sf_dir).readings.select("event_id", "state")


@query("violations")
def q_violations(spark, sf_dir):
    return _p(spark, sf_dir).readings.select("event_id", joined("details").alias("details"))


@query("time_renderings")
def q_time(spark, sf_dir):
    return _p(spark, sf_dir).readings.select("event_id", "device_ts", "device_ts_iso", "gateway_ts", "gateway_ts_iso")


@query("raw_records")
def q_raw_records(spark, sf_dir):
    p = _p(spark, sf_dir)
    r = T.raw_records(clamp(p.raw_readings, p.params.clamp_bounds), p.gateway_table, p.params.window_ms)
    return r.select("event_id", "device_id", "gateway_id", "device_ts", "device_ts_iso", "gateway_ts",
                    "gateway_ts_iso", *[r6(m).alias(m) for m in METRICS], "device_status")


@query("json_path_extract")
def q_json_path(spark, sf_dir):
    from fieldwatch.sources.fixtures import table
    ev = table(spark, sf_dir, "events")
    return jsonio.json_path(ev.select("event_id", "props"), "props", {"k": "$.k", "missing": "$.missing"}) \
        .select("event_id", "k", "missing")


@query("parse_alerts")
def q_parse_alerts(spark, sf_dir):
    a = _p(spark, sf_dir).parsed_alerts
    return a.select("seq", "device_id", "gateway_id", "gateway_ts", "gateway_ts_iso", "state",
                    joined("details").alias("details"))


@query("valid_alerts")
def q_valid(spark, sf_dir):
    a = A.valid_alerts(_p(spark, sf_dir).parsed_alerts)
    return a.select("seq", "device_id", "gateway_ts", "state")


@query("normalise_details")
def q_details(spark, sf_dir):
    a = _p(spark, sf_dir).parsed_alerts
    return a.select("seq", joined(details_from_array("details")).alias("details"),
                    F.size(details_from_array("details")).alias("n_details"))


@query("tolerant_casts")
def q_casts(spark, sf_dir):
    lines = _p(spark, sf_dir).raw_alert_lines
    txt = F.get_json_object("value", "$.gateway_ts")
    return lines.select(F.col("event_id").alias("seq"), txt.alias("raw"), to_int(txt).alias("as_int"),
                        r6(to_float(txt)).alias("as_float"))


@query("field_fallback")
def q_fallback(spark, sf_dir):
    p = _p(spark, sf_dir)
    loc = p.location_table.select("device_id", F.col("farm_id").alias("farmId"),
                             F.col("farm_location.lat").alias("farm_lat"), F.col("farm_location.lon").alias("farm_lon"),
                             F.col("device_location.lat").alias("device_lat"),
                             F.col("device_location.lon").alias("device_lon"))
    flat = A.valid_alerts(p.parsed_alerts).join(loc, "device_id", "left")
    c = A.conform_cleaned(flat)
    return c.select("seq", "device_id", "farm_id", *flat_points(("farm_location", "device_location")))


@query("geo_structs")
def q_geo(spark, sf_dir):
    return _p(spark, sf_dir).locations.select("device_id", *flat_points())


@query("conform_telemetry")
def q_conform_t(spark, sf_dir):
    c = conform(_p(spark, sf_dir).enriched_telemetry, TELEMETRY_DOC)
    return c.select("device_id", "gateway_ts", "farm_id", "count",
                    *[r6(x).alias(x) for x in ("temperature_avg", "humidity_std", "light_level_max")])


@query("conform_alerts")
def q_conform_a(spark, sf_dir):
    """The alert contract applied (its stamps are tested by alert_documents)."""
    c = conform(_p(spark, sf_dir).cleaned_alerts, ALERT_DOC)
    return c.select("device_id", "gateway_id", "farm_id", "gateway_ts", "gateway_ts_iso", "state",
                    joined("details").alias("details"), *flat_points())


def _stored(df, contract, ingest, before, created):
    """Documents as a store holds them: the contract with its stamps, here at
    fixed distances from the gateway's."""
    at = lambda ms: F.col("gateway_ts") + ms
    stamped = df.withColumns({"ts_kafka_ingest": at(ingest), "ts_before_es": at(before),
                              "created_at": F.timestamp_millis(at(created))})
    return conform(stamped, contract)


@query("alert_documents")
def q_alert_documents(spark, sf_dir):
    """Cleaned alerts in the alert index's contract, all stamps kept."""
    d = _stored(_p(spark, sf_dir).cleaned_alerts, ALERT_DOC, 250, 400, 900)
    return d.select("device_id", "farm_id", "gateway_ts", "state", joined("details").alias("details"),
                    "ts_kafka_ingest", "ts_before_es", F.col("created_at").cast("timestamp_ntz").alias("created_at"),
                    *flat_points(("device_location",)))


@query("union_indices")
def q_union_indices(spark, sf_dir):
    """The stamps of both indices' documents, which have different schemas."""
    p = _p(spark, sf_dir)
    docs = E.union_indices({ALERT_INDEX: _stored(p.cleaned_alerts, ALERT_DOC, 250, 400, 900),
                            TELEMETRY_INDEX: _stored(p.enriched_telemetry, TELEMETRY_DOC, 120, 300, 700)})
    return docs.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("parse_telemetry")
def q_parse_telemetry(spark, sf_dir):
    """P2 + P4: telemetry messages rendered to JSON and parsed back."""
    msgs = jsonio.rows_to_json(_p(spark, sf_dir).telemetry.select(*[f.name for f in TELEMETRY_MSG.fields]))
    t = jsonio.parse_telemetry(msgs)
    return t.select("device_id", "gateway_id", "gateway_ts", "gateway_ts_iso", "count",
                    *[r6(c).alias(c) for c in STAT_COLUMNS])


@query("latency_rows")
def q_latency_rows(spark, sf_dir):
    return E.latency_rows(_p(spark, sf_dir).latency_source)


@query("latency_legs")
def q_latency_legs(spark, sf_dir):
    legs = _p(spark, sf_dir).latency_legs
    return legs.select("index", "gateway_ts", *[r6(n).alias(n) for n in E.LEGS])


# --- joins -----------------------------------------------------------------------------------

@query("device_locations")
def q_locations(spark, sf_dir):
    return _p(spark, sf_dir).locations.select("device_id", "farm_id", "gateway_id", *flat_points())


@query("gateway_lookup")
def q_gateway_lookup(spark, sf_dir):
    p = _p(spark, sf_dir)
    return D.gateway_lookup(p.raw_readings, p.gateway_table).select("event_id", "device_id", "gateway_id")


@query("unknown_devices")
def q_unknown(spark, sf_dir):
    p = _p(spark, sf_dir)
    return D.unknown_devices(p.raw_readings, p.gateway_table).select("event_id", "device_id")


@query("enrich_telemetry")
def q_enrich_t(spark, sf_dir):
    e = _p(spark, sf_dir).enriched_telemetry
    return e.select("device_id", "gateway_ts", "gateway_id", "farm_id", "count", *flat_points())


@query("enrich_alerts")
def q_enrich_a(spark, sf_dir):
    p = _p(spark, sf_dir)
    e = T.enrich(A.valid_alerts(p.parsed_alerts), p.location_table)
    return e.select("seq", "device_id", "state", "farm_id", *flat_points())


@query("unseen_devices")
def q_unseen(spark, sf_dir):
    """(registered device, non-empty window) pairs without a reading."""
    p = _p(spark, sf_dir)
    known = p.readings.select("device_id", "gateway_ts").distinct().join(p.gateway_table, "device_id")
    return A.unseen_devices(known, p.gateway_table, p.params.window_ms)


# --- aggregates ------------------------------------------------------------------------------

@query("device_window_stats")
def q_window_stats(spark, sf_dir):
    t = _p(spark, sf_dir).telemetry
    return t.select("device_id", "gateway_id", "gateway_ts", "gateway_ts_iso", "count",
                    *[r6(c).alias(c) for c in STAT_COLUMNS])


@query("latency_stats")
def q_latency_stats(spark, sf_dir):
    s = E.latency_stats(_p(spark, sf_dir).latency_legs)
    return s.select("index", "leg", "count", *[r6(c).alias(c) for c in ("avg", "p50", "p90", "p95", "min", "max")])


@query("latency_report")
def q_latency_report(spark, sf_dir):
    """The evaluation flow as run: documents of the last 6 h (S8) -> readable
    stamps (P20) -> legs (P21) -> per-index statistics (A2)."""
    src = _p(spark, sf_dir).latency_source
    as_of = src.select(F.max("created_at")).scalar()
    s = E.latency_stats(E.latency_legs(E.latency_rows(E.recent(src, as_of))))
    return s.select("index", "leg", "count", *[r6(c).alias(c) for c in ("avg", "p50", "p90", "p95", "min", "max")])


@query("counter_rate")
def q_counter_rate(spark, sf_dir):
    r = E.counter_rate(_p(spark, sf_dir).counter_samples)
    return r.select("index", "sample_ts", "docs", "time_ms", r6("docs_per_sec").alias("docs_per_sec"))


@query("rate_summary")
def q_rate_summary(spark, sf_dir):
    s = E.rate_summary(E.counter_rate(_p(spark, sf_dir).counter_samples))
    return s.select("index", *[r6(c).alias(c) for c in ("avg_rate", "min_rate", "max_rate")])


@query("median_by_farm_gateway")
def q_median(spark, sf_dir):
    t = _p(spark, sf_dir).enriched_telemetry
    m = DB.median_by_farm_gateway(t, "light_level_avg", FIX_FARM_SIZE, FIX_GATEWAY_SIZE)
    return m.select("farm", "gateway", r6("median_light_level_avg").alias("median_light_level_avg"))


def _median_panel(metric: str, farm_size: int, gateway_size: int):
    def fn(spark, sf_dir):
        t = _p(spark, sf_dir).enriched_telemetry
        m = DB.median_by_farm_gateway(t, metric, farm_size, gateway_size)
        return m.select("farm", "gateway", r6(f"median_{metric}").alias(f"median_{metric}"))
    return fn


# the other two median panels, and the saved panels at their exact sizes
QUERIES["median_soil_by_farm_gateway"] = _median_panel("soil_moisture_avg", FIX_FARM_SIZE, FIX_GATEWAY_SIZE)
QUERIES["median_humidity_by_farm_gateway"] = _median_panel("humidity_avg", FIX_FARM_SIZE, FIX_GATEWAY_SIZE)
QUERIES["panel_light_median"] = _median_panel("light_level_avg", DASHBOARD_FARM_SIZE, DASHBOARD_GATEWAY_SIZE_MEDIAN)
QUERIES["panel_soil_median"] = _median_panel("soil_moisture_avg", DASHBOARD_FARM_SIZE, DASHBOARD_GATEWAY_SIZE_MEDIAN)
QUERIES["panel_humidity_median"] = _median_panel("humidity_avg", DASHBOARD_FARM_SIZE, DASHBOARD_GATEWAY_SIZE_MEDIAN)


@query("panel_record_share")
def q_panel_share(spark, sf_dir):
    s = DB.record_share(_p(spark, sf_dir).enriched_telemetry, DASHBOARD_FARM_SIZE, DASHBOARD_GATEWAY_SIZE_COUNT)
    return s.select("farm", "gateway", "records", r6("share_total").alias("share_total"),
                    r6("share_parent").alias("share_parent"))


@query("top_farms_other")
def q_top_farms(spark, sf_dir):
    t = _p(spark, sf_dir).enriched_telemetry
    m = DB.top_terms(t, "farm_id", "soil_moisture_avg", FIX_FARM_SIZE, "median")
    return m.select(F.col("label").alias("farm"), r6("value").alias("median_soil_moisture_avg"))


@query("record_share")
def q_share(spark, sf_dir):
    s = DB.record_share(_p(spark, sf_dir).enriched_telemetry, FIX_FARM_SIZE, FIX_GATEWAY_SIZE)
    return s.select("farm", "gateway", "records", r6("share_total").alias("share_total"),
                    r6("share_parent").alias("share_parent"))


@query("critical_by_gateway")
def q_critical(spark, sf_dir):
    # gateway and state are those of the deduplicated alerts: cleaning adds locations only
    return DB.critical_by_gateway(_p(spark, sf_dir).deduped_alerts, FIX_ALPHA_SIZE)


@query("routes_by_farm")
def q_routes_by_farm(spark, sf_dir):
    r = N.routes_by_farm(_p(spark, sf_dir).routes)
    return r.select("farm_id", joined("emails").alias("emails"), "n_recipients")


# --- sequence operators ---------------------------------------------------------------------------

def _alert_out(df: DataFrame) -> DataFrame:
    return df.select("device_id", "gateway_id", "gateway_ts", "gateway_ts_iso", "state",
                     joined("details").alias("details"))


@query("fleet_alerts")
def q_fleet(spark, sf_dir):
    return _alert_out(_p(spark, sf_dir).fleet_alerts)


@query("device_alerts")
def q_device_alerts(spark, sf_dir):
    return _alert_out(_p(spark, sf_dir).fleet_alerts.filter(F.col("state") != STATE_OFFLINE))


@query("offline_alerts")
def q_offline(spark, sf_dir):
    p = _p(spark, sf_dir)
    known = p.readings.select("device_id", "gateway_ts").distinct().join(p.gateway_table, "device_id")
    return _alert_out(A.offline_alerts(known, p.gateway_table, p.params))


@query("dedup_alerts")
def q_dedup(spark, sf_dir):
    return _alert_out(_p(spark, sf_dir).deduped_alerts)


@query("cleaned_alerts")
def q_cleaned(spark, sf_dir):
    c = _p(spark, sf_dir).cleaned_alerts
    return c.select("device_id", "gateway_id", "gateway_ts", "gateway_ts_iso", "state",
                    joined("details").alias("details"), "farm_id", *flat_points())


@query("cleaned_raw_alerts")
def q_cleaned_raw(spark, sf_dir):
    """The cleaning job on raw alert lines, malformed ones included: parse ->
    required fields -> dedup (W1) -> enrich -> coercions."""
    p = _p(spark, sf_dir)
    valid = A.valid_alerts(p.parsed_alerts)
    kept = A.dedup_alerts(valid, p.params.dedup_window, ("gateway_ts", "seq"))
    c = A.conform_cleaned(T.enrich(kept, p.location_table))
    return c.select("seq", "device_id", "gateway_id", "gateway_ts", "gateway_ts_iso", "state",
                    joined("details").alias("details"), "farm_id", *flat_points())


@query("cleaned_alerts_scan")
def q_cleaned_scan(spark, sf_dir):
    """S3 + N3: cleaned alerts as key-less JSON values, read back and decoded."""
    from fieldwatch.schemas import CLEANED_ALERT
    c = _p(spark, sf_dir).cleaned_alerts
    # JSON is most of the work, and the join's few partitions of even size, some more than
    # there are cores, would be two rounds of it
    c = c.repartition(default_parallelism(spark), "device_id", "gateway_ts")
    values = jsonio.rows_to_json(c.select(*[f.name for f in CLEANED_ALERT.fields]))
    back = jsonio.parse_json(values, CLEANED_ALERT)
    return back.select("device_id", "gateway_ts", "state", joined("details").alias("details"), "farm_id",
                       *flat_points(("device_location",)))


@query("state_transitions")
def q_transitions(spark, sf_dir):
    p = _p(spark, sf_dir)
    return A.state_transitions(p.readings)


@query("notifications")
def q_notifications(spark, sf_dir):
    p = _p(spark, sf_dir)
    n = N.notifications(p.cleaned_alerts, p.routes)
    return n.select("email", "farm_id", "device_id", "state", r6("lat").alias("lat"), r6("lon").alias("lon"),
                    "gateway_ts_iso", joined("details").alias("details"), "message")


@query("unrouted_alerts")
def q_unrouted(spark, sf_dir):
    p = _p(spark, sf_dir)
    u = N.unrouted_alerts(p.cleaned_alerts, p.routes)
    return u.select("device_id", "gateway_ts", "state", "farm_id")


# --- dashboard filters ------------------------------------------------------------------------

@query("time_slice")
def q_time_slice(spark, sf_dir):
    t = _p(spark, sf_dir).telemetry
    span = t.select(F.struct(F.min("gateway_ts").alias("lo"), F.max("gateway_ts").alias("hi"))).scalar()
    return DB.time_slice(t, span["lo"], span["hi"]).select("device_id", "gateway_ts", "count")


@query("map_points")
def q_map(spark, sf_dir):
    return DB.map_points(_p(spark, sf_dir).enriched_telemetry, FIX_BBOX) \
        .select("layer", "visible", "device_id", r6("lat").alias("lat"), r6("lon").alias("lon"))
