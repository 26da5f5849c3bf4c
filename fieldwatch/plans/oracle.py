"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL re-derives each result from the driver's tables on its own: the
ordered folds are recursive CTEs that walk every reading and every
(device x window) tick one step at a time, a brute-force check of the
parallel thinning used on the Spark side.
"""

from __future__ import annotations

from fieldwatch.config import FIXTURE_PARAMS, Params

D = "::DOUBLE"


def _iso(ms: str) -> str:
    return f"(strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00')"


def _ctes(p: Params) -> str:
    W, COOL, REC, OFF, DW = p.window_ms, p.cooldown_ms, p.recovery_ms, p.offline_ms, p.dedup_window

    def viol(m, lo, hi):
        return f"({m} < {lo}{D} OR {m} > {hi}{D})"

    th = p.thresholds
    conds = {m: viol(m, *th[m]) for m in ("temperature", "humidity", "soil_moisture", "light_level")}
    any_viol = " OR ".join(conds.values())
    details = ", ".join(f"CASE WHEN {c} THEN '{m}' END" for m, c in conds.items())
    cb = p.clamp_bounds

    def clamp(expr, m):
        lo, hi = cb[m]
        return f"greatest({lo}{D}, least({expr}, {hi}{D}))"

    def emit(o, f):
        return (f"CASE WHEN {o}.kind = 1 THEN {o}.gateway_ts - {f}lt >= {OFF} "
                f"ELSE ({o}.state = 'OK' AND {f}ps = 'CRITICAL' AND {o}.gateway_ts - {f}pa >= {REC}) "
                f"OR ({o}.state = 'CRITICAL' AND {o}.gateway_ts - {f}pa >= {COOL}) END")

    e0 = (f"CASE WHEN o.kind = 1 THEN o.gateway_ts - 0 >= {OFF} "
          f"ELSE (o.state = 'OK' AND '' = 'CRITICAL' AND o.gateway_ts - 0 >= {REC}) "
          f"OR (o.state = 'CRITICAL' AND o.gateway_ts - 0 >= {COOL}) END")
    e1 = emit("o", "f.")
    dd_same = f"(f.ks = a.state AND abs(a.gateway_ts - f.kt) < {DW})"
    return f"""
listing AS (SELECT c_custkey, c_acctbal, c_nationkey, c_custkey // 250 AS block, n_nationkey, n_regionkey
            FROM customer JOIN nation ON n_nationkey = c_nationkey
            UNION ALL
            SELECT c_custkey, c_acctbal, c_nationkey, c_custkey // 250, n_nationkey, n_regionkey
            FROM customer JOIN nation ON n_nationkey = (c_nationkey + 1) % 25 WHERE c_mktsegment = 'MACHINERY'),
farm AS (SELECT DISTINCT 'farm-' || n_regionkey || '-' || block AS id,
                11.5{D} + 0.6{D} * n_regionkey + 0.01{D} * block AS latitude,
                107.8{D} + 0.2{D} * n_regionkey + 0.01{D} * block AS longitude FROM listing),
gw AS (SELECT DISTINCT n_nationkey, block, 'gateway-' || n_nationkey || '-' || block AS id,
              11.5{D} + 0.6{D} * n_regionkey + 0.01{D} * block + 0.001{D} * n_nationkey AS latitude,
              107.8{D} + 0.2{D} * n_regionkey + 0.01{D} * block + 0.001{D} * n_nationkey AS longitude FROM listing),
device AS (SELECT 'device-' || c.c_custkey AS id, g.latitude + 0.00001{D} * (c.c_custkey % 50) AS latitude,
                  g.longitude + 0.00001{D} * (c.c_custkey % 50) AS longitude
           FROM customer c JOIN gw g ON c.c_nationkey = g.n_nationkey AND c.c_custkey // 250 = g.block),
bridge AS (SELECT 'farm-' || n_regionkey || '-' || block AS farm_id,
                  'gateway-' || n_nationkey || '-' || block AS gateway_id, 'device-' || c_custkey AS device_id
           FROM listing WHERE c_acctbal >= 0),
routes AS (SELECT 'farm-' || (s_suppkey % 4) || '-' || (s_suppkey // 10) AS farm_id,
                  s_name || '@example.com' AS email FROM supplier
           UNION ALL
           SELECT 'farm-' || (s_suppkey % 4) || '-' || (s_suppkey // 10), s_name || '@example.com'
           FROM supplier WHERE s_acctbal < 0),
loc_all AS (SELECT b.device_id, b.farm_id, b.gateway_id, f.latitude AS farm_lat, f.longitude AS farm_lon,
                   g.latitude AS gateway_lat, g.longitude AS gateway_lon, d.latitude AS device_lat,
                   d.longitude AS device_lon
            FROM bridge b JOIN farm f ON f.id = b.farm_id JOIN gw g ON g.id = b.gateway_id
                 JOIN device d ON d.id = b.device_id),
locations AS (SELECT * FROM loc_all
              QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY farm_id DESC, gateway_id DESC) = 1),
dev_gw AS (SELECT device_id, gateway_id FROM bridge
           QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY farm_id DESC, gateway_id DESC) = 1),
rd AS (SELECT event_id, 'device-' || user_id AS device_id, epoch_us(ts) // 1000 AS device_ts,
              strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS device_ts_iso,
              {clamp(f"value / 5.0{D}", "temperature")} AS temperature,
              {clamp(f"CAST(json_extract_string(props, '$.k') AS DOUBLE)", "humidity")} AS humidity,
              {clamp(f"1.0{D} + CAST((event_id * 37) % 84 AS DOUBLE)", "soil_moisture")} AS soil_moisture,
              {clamp(f"50.0{D} + value * 250.0{D}", "light_level")} AS light_level,
              'OK' AS device_status
       FROM events),
gr AS (SELECT *, (device_ts // {W} + 1) * {W} AS gateway_ts,
              {_iso(f"(device_ts // {W} + 1) * {W}")} AS gateway_ts_iso,
              CASE WHEN {any_viol} THEN 'CRITICAL' ELSE 'OK' END AS state,
              list_filter([{details}], lambda x: x IS NOT NULL) AS details
       FROM rd),
kr AS (SELECT gr.*, m.gateway_id FROM gr JOIN dev_gw m USING (device_id)),
fwin AS (SELECT DISTINCT (gateway_ts - 1) // {W} AS w FROM kr),
seen AS (SELECT DISTINCT device_id, (gateway_ts - 1) // {W} AS w FROM kr),
ticks AS (SELECT m.device_id, m.gateway_id, (f.w + 1) * {W} AS gateway_ts
          FROM dev_gw m CROSS JOIN fwin f
          WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.device_id = m.device_id AND s.w = f.w)),
fev AS (SELECT device_id, gateway_id, gateway_ts, 0 AS kind, event_id AS seq, state, details FROM kr
        UNION ALL
        SELECT device_id, gateway_id, gateway_ts, 1, NULL, 'OFFLINE', []::VARCHAR[] FROM ticks),
fo AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY gateway_ts, kind, seq) AS rn FROM fev),
ff(device_id, rn, ps, pa, lt, emit) AS (
    SELECT o.device_id, o.rn,
           CASE WHEN o.kind = 0 THEN o.state ELSE '' END,
           CASE WHEN {e0} THEN o.gateway_ts ELSE 0 END,
           CASE WHEN o.kind = 0 THEN o.gateway_ts ELSE 0 END,
           {e0}
    FROM fo o WHERE o.rn = 1
    UNION ALL
    SELECT o.device_id, o.rn,
           CASE WHEN o.kind = 0 THEN o.state ELSE f.ps END,
           CASE WHEN {e1} THEN o.gateway_ts ELSE f.pa END,
           CASE WHEN o.kind = 0 THEN o.gateway_ts ELSE f.lt END,
           {e1}
    FROM ff f JOIN fo o ON o.device_id = f.device_id AND o.rn = f.rn + 1),
fleet AS (SELECT o.device_id, o.gateway_id, o.gateway_ts, {_iso("o.gateway_ts")} AS gateway_ts_iso,
                 o.state, o.details, o.seq
          FROM ff JOIN fo o USING (device_id, rn) WHERE ff.emit),
da AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY gateway_ts, seq NULLS FIRST) AS rn
       FROM fleet WHERE device_id IS NOT NULL AND state IS NOT NULL AND gateway_ts IS NOT NULL),
dd(device_id, rn, ks, kt, keep) AS (
    SELECT device_id, rn, state, gateway_ts, true FROM da WHERE rn = 1
    UNION ALL
    SELECT a.device_id, a.rn,
           CASE WHEN {dd_same} THEN f.ks ELSE a.state END,
           CASE WHEN {dd_same} THEN f.kt ELSE a.gateway_ts END,
           NOT {dd_same}
    FROM dd f JOIN da a ON a.device_id = f.device_id AND a.rn = f.rn + 1),
deduped AS (SELECT da.device_id, da.gateway_id, da.gateway_ts, da.gateway_ts_iso, da.state, da.details, da.seq
            FROM da JOIN dd USING (device_id, rn) WHERE dd.keep),
cleaned AS (SELECT d.*, l.farm_id, l.farm_lat, l.farm_lon, l.gateway_lat, l.gateway_lon, l.device_lat, l.device_lon
            FROM deduped d LEFT JOIN locations l USING (device_id)),
tele AS (SELECT r.device_id, m.gateway_id, r.gateway_ts, any_value(r.gateway_ts_iso) AS gateway_ts_iso,
                count(*) AS count,
                {", ".join(f"avg({x}) AS {x}_avg, min({x}) AS {x}_min, max({x}) AS {x}_max, stddev_pop({x}) AS {x}_std"
                           for x in ("temperature", "humidity", "soil_moisture", "light_level"))}
         FROM gr r JOIN dev_gw m USING (device_id)
         GROUP BY r.device_id, m.gateway_id, r.gateway_ts),
etele AS (SELECT t.*, l.farm_id, l.farm_lat, l.farm_lon, l.gateway_lat, l.gateway_lon, l.device_lat, l.device_lon
          FROM tele t LEFT JOIN locations l USING (device_id)),
rawalert AS (SELECT gr.event_id AS seq, gr.device_id, m.gateway_id, gr.gateway_ts, gr.gateway_ts_iso, gr.state,
                    gr.details, gr.event_id
             FROM gr LEFT JOIN dev_gw m USING (device_id)),
parsed AS (SELECT seq,
                  CASE WHEN event_id % 97 = 0 THEN NULL ELSE device_id END AS device_id,
                  CASE WHEN event_id % 97 = 0 THEN NULL ELSE gateway_id END AS gateway_id,
                  CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE gateway_ts END AS gateway_ts,
                  CASE WHEN event_id % 97 = 0 THEN NULL ELSE gateway_ts_iso END AS gateway_ts_iso,
                  CASE WHEN event_id % 97 = 0 THEN NULL ELSE state END AS state,
                  CASE WHEN event_id % 97 = 0 OR event_id % 83 = 0 THEN NULL ELSE details END AS details
           FROM rawalert),
valid AS (SELECT * FROM parsed WHERE device_id IS NOT NULL AND state IS NOT NULL AND gateway_ts IS NOT NULL),
lat AS (SELECT epoch_us(ts) // 1000 AS gateway_ts,
               epoch_us(ts) // 1000 + event_id % 500 AS ts_kafka_ingest,
               CASE WHEN event_id % 101 <> 0 THEN epoch_us(ts) // 1000 + event_id % 500 + (event_id * 7) % 900 END
                   AS ts_before_es,
               make_timestamp((epoch_us(ts) // 1000 + event_id % 500 + (event_id * 7) % 900
                               + CAST(json_extract_string(props, '$.k') AS BIGINT)) * 1000) AS created_at,
               CASE WHEN event_type = 'error' THEN 'farm_cleaned_alerts' ELSE 'farm_enriched_telemetry' END AS "index"
        FROM events),
latrows AS (SELECT * FROM lat WHERE gateway_ts IS NOT NULL AND ts_kafka_ingest IS NOT NULL
            AND ts_before_es IS NOT NULL AND created_at IS NOT NULL),
legs AS (SELECT "index", gateway_ts,
                (ts_kafka_ingest - gateway_ts) / 1000.0{D} AS lat_gw_kafka,
                (ts_before_es - ts_kafka_ingest) / 1000.0{D} AS lat_kafka_spark,
                (epoch_us(created_at) // 1000 - ts_before_es) / 1000.0{D} AS lat_spark_es,
                (epoch_us(created_at) // 1000 - gateway_ts) / 1000.0{D} AS lat_e2e
         FROM latrows),
daily AS (SELECT CASE WHEN event_type = 'error' THEN 'farm_cleaned_alerts' ELSE 'farm_enriched_telemetry' END
                     AS "index",
                 date_trunc('day', ts) AS day, count(*) AS n,
                 sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS t
          FROM events GROUP BY 1, 2),
samples AS (SELECT "index", day AS sample_ts,
                   CAST(sum(n) OVER (PARTITION BY "index" ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total,
                   CAST(sum(t) OVER (PARTITION BY "index" ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT)
                       AS time_ms
            FROM daily),
rates AS (SELECT "index", sample_ts, total - lag(total) OVER w AS docs, time_ms - lag(time_ms) OVER w AS time_ms
          FROM samples WINDOW w AS (PARTITION BY "index" ORDER BY sample_ts)),
rates2 AS (SELECT *, CASE WHEN time_ms > 0 THEN docs / (time_ms / 1000.0{D}) ELSE 0.0 END AS docs_per_sec
           FROM rates WHERE docs IS NOT NULL),
va AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY gateway_ts, seq) AS rn FROM valid),
vd(device_id, rn, ks, kt, keep) AS (
    SELECT device_id, rn, state, gateway_ts, true FROM va WHERE rn = 1
    UNION ALL
    SELECT a.device_id, a.rn,
           CASE WHEN {dd_same} THEN f.ks ELSE a.state END,
           CASE WHEN {dd_same} THEN f.kt ELSE a.gateway_ts END,
           NOT {dd_same}
    FROM vd f JOIN va a ON a.device_id = f.device_id AND a.rn = f.rn + 1),
rawclean AS (SELECT va.seq, va.device_id, va.gateway_id, va.gateway_ts, va.gateway_ts_iso, va.state,
                    coalesce(va.details, []::VARCHAR[]) AS details, l.farm_id, l.farm_lat, l.farm_lon,
                    l.gateway_lat, l.gateway_lon, l.device_lat, l.device_lon
             FROM va JOIN vd USING (device_id, rn) LEFT JOIN locations l USING (device_id) WHERE vd.keep)
"""


def _r6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


def _pts(prefixes=("farm", "gateway", "device"), src="") -> str:
    return ", ".join(f"{_r6(src + p + '_lat')} AS {p}_lat, {_r6(src + p + '_lon')} AS {p}_lon" for p in prefixes)


def _nested_top_sql(rows: str, metric: str | None, outer_size: int, inner_size: int, kind: str) -> str:
    """K1+K2 in SQL: rank per level, pool the rest as Other, recompute on raw rows."""
    agg = f"median({metric})" if kind == "median" else "count(*)"
    where = "farm_id IS NOT NULL AND gateway_id IS NOT NULL" + (f" AND {metric} IS NOT NULL" if metric else "")
    return f"""
base AS (SELECT * FROM {rows} WHERE {where}),
f1 AS (SELECT farm_id, {agg} AS v FROM base GROUP BY farm_id),
f2 AS (SELECT farm_id, CASE WHEN row_number() OVER (ORDER BY v DESC, farm_id) <= {outer_size}
                            THEN farm_id ELSE '__other__' END AS farm FROM f1),
b1 AS (SELECT base.*, f2.farm FROM base JOIN f2 USING (farm_id)),
g1 AS (SELECT farm, gateway_id, {agg} AS v FROM b1 GROUP BY farm, gateway_id),
g2 AS (SELECT farm, gateway_id, CASE WHEN row_number() OVER (PARTITION BY farm ORDER BY v DESC, gateway_id)
                                     <= {inner_size} THEN gateway_id ELSE '__other__' END AS gateway FROM g1),
b2 AS (SELECT b1.*, g2.gateway FROM b1 JOIN g2 USING (farm, gateway_id))"""


def oracle_sql(p: Params = FIXTURE_PARAMS) -> dict[str, str]:
    from fieldwatch.plans.queries import FIX_ALPHA_SIZE, FIX_BBOX, FIX_FARM_SIZE, FIX_GATEWAY_SIZE
    from fieldwatch.schemas import STAT_COLUMNS

    W = p.window_ms
    pre = "WITH RECURSIVE " + _ctes(p)

    def q(body: str, extra: str = "") -> str:
        return pre + (("," + extra) if extra else "") + "\n" + body

    stats = ", ".join(f"{_r6(c)} AS {c}" for c in STAT_COLUMNS)
    alert_out = "device_id, gateway_id, gateway_ts, gateway_ts_iso, state, array_to_string(details, '|') AS details"
    s: dict[str, str] = {}
    s["dim_scan"] = q("""SELECT 'farm' AS kind, id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM farm
        UNION ALL SELECT 'gateway', id, round(latitude, 6), round(longitude, 6) FROM gw
        UNION ALL SELECT 'device', id, round(latitude, 6), round(longitude, 6) FROM device""")
    s["bridge_scan"] = q("SELECT farm_id, gateway_id, device_id FROM bridge")
    s["routes_scan"] = q("SELECT farm_id, email FROM routes")
    s["device_index"] = q("SELECT DISTINCT device_id FROM bridge")
    s["gateway_index"] = q("SELECT device_id, gateway_id FROM dev_gw")
    s["farm_ids"] = q("SELECT id FROM farm")
    s["counter_samples"] = q("SELECT \"index\", sample_ts, total, time_ms FROM samples")
    s["recent_documents"] = q("""SELECT gateway_ts, ts_kafka_ingest, ts_before_es, created_at, "index" FROM lat
        WHERE created_at >= (SELECT max(created_at) FROM lat) - INTERVAL 6 HOURS""")
    s["clamp_readings"] = q(f"""SELECT event_id, device_id, {_r6('temperature')} AS temperature,
        {_r6('humidity')} AS humidity, {_r6('soil_moisture')} AS soil_moisture, {_r6('light_level')} AS light_level
        FROM gr""")
    s["classify_state"] = q("SELECT event_id, state FROM gr")
    s["violations"] = q("SELECT event_id, array_to_string(details, '|') AS details FROM gr")
    s["time_renderings"] = q("SELECT event_id, device_ts, device_ts_iso, gateway_ts, gateway_ts_iso FROM gr")
    s["raw_records"] = q(f"""SELECT r.event_id, r.device_id, m.gateway_id, r.device_ts, r.device_ts_iso,
        (r.device_ts // {W} + 1) * {W} AS gateway_ts, {_iso(f"(r.device_ts // {W} + 1) * {W}")} AS gateway_ts_iso,
        {_r6(f"greatest(-10.0{D}, least(e.value / 5.0{D}, 60.0{D}))")} AS temperature,
        {_r6(f"greatest(0.0{D}, least(50.0{D} + e.value * 250.0{D}, 120000.0{D}))")} AS light_level,
        {_r6(f"greatest(0.0{D}, least(CAST(json_extract_string(e.props, '$.k') AS DOUBLE), 100.0{D}))")} AS humidity,
        {_r6(f"greatest(0.0{D}, least(1.0{D} + CAST((event_id * 37) % 84 AS DOUBLE), 100.0{D}))")} AS soil_moisture,
        r.device_status
        FROM (SELECT event_id, 'device-' || user_id AS device_id, epoch_us(ts) // 1000 AS device_ts,
                     strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS device_ts_iso, 'OK' AS device_status
              FROM events) r
        JOIN events e USING (event_id) JOIN dev_gw m USING (device_id)""")
    s["json_path_extract"] = q("""SELECT event_id, json_extract_string(props, '$.k') AS k,
        json_extract_string(props, '$.missing') AS missing FROM events""")
    s["parse_alerts"] = q("""SELECT seq, device_id, gateway_id, gateway_ts, gateway_ts_iso, state,
        array_to_string(details, '|') AS details FROM parsed""")
    s["valid_alerts"] = q("SELECT seq, device_id, gateway_ts, state FROM valid")
    s["normalise_details"] = q("""SELECT seq, array_to_string(coalesce(details, []::VARCHAR[]), '|') AS details,
        len(coalesce(details, []::VARCHAR[])) AS n_details FROM parsed""")
    s["tolerant_casts"] = q("""SELECT event_id AS seq,
        CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'x' ELSE CAST(gateway_ts AS VARCHAR) END AS raw,
        CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE gateway_ts END AS as_int,
        CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE round(CAST(gateway_ts AS DOUBLE), 6) END AS as_float
        FROM rawalert""")
    s["field_fallback"] = q(f"""SELECT v.seq, v.device_id, l.farm_id, {_pts(("farm", "device"), "l.")}
        FROM valid v LEFT JOIN locations l USING (device_id)""")
    s["geo_structs"] = q(f"SELECT device_id, {_pts()} FROM locations")
    s["conform_telemetry"] = q("""SELECT device_id, gateway_ts, farm_id, CAST(count AS INTEGER) AS count,
        round(CAST(CAST(temperature_avg AS FLOAT) AS DOUBLE), 6) AS temperature_avg,
        round(CAST(CAST(humidity_std AS FLOAT) AS DOUBLE), 6) AS humidity_std,
        round(CAST(CAST(light_level_max AS FLOAT) AS DOUBLE), 6) AS light_level_max FROM etele""")
    s["conform_alerts"] = q(f"""SELECT device_id, gateway_id, farm_id, gateway_ts, gateway_ts_iso, state,
        array_to_string(details, '|') AS details, {_pts()} FROM cleaned""")
    s["alert_documents"] = q(f"""SELECT device_id, farm_id, gateway_ts, state, array_to_string(details, '|') AS details,
        gateway_ts + 250 AS ts_kafka_ingest, gateway_ts + 400 AS ts_before_es,
        make_timestamp((gateway_ts + 900) * 1000) AS created_at, {_pts(("device",))} FROM cleaned""")
    s["union_indices"] = q("""SELECT gateway_ts, gateway_ts + 250 AS ts_kafka_ingest, gateway_ts + 400 AS ts_before_es,
        make_timestamp((gateway_ts + 900) * 1000) AS created_at, 'farm_cleaned_alerts' AS "index" FROM cleaned
        UNION ALL
        SELECT gateway_ts, gateway_ts + 120, gateway_ts + 300, make_timestamp((gateway_ts + 700) * 1000),
               'farm_enriched_telemetry' FROM etele""")
    s["parse_telemetry"] = q(f"""SELECT device_id, gateway_id, gateway_ts, gateway_ts_iso, count, {stats}
        FROM tele""")
    s["latency_rows"] = q("SELECT gateway_ts, ts_kafka_ingest, ts_before_es, created_at, \"index\" FROM latrows")
    s["latency_legs"] = q(f"""SELECT "index", gateway_ts, {_r6('lat_gw_kafka')} AS lat_gw_kafka,
        {_r6('lat_kafka_spark')} AS lat_kafka_spark, {_r6('lat_spark_es')} AS lat_spark_es,
        {_r6('lat_e2e')} AS lat_e2e FROM legs""")
    s["device_locations"] = q(f"SELECT device_id, farm_id, gateway_id, {_pts()} FROM locations")
    s["gateway_lookup"] = q("""SELECT e.event_id, 'device-' || e.user_id AS device_id, m.gateway_id
        FROM events e JOIN dev_gw m ON m.device_id = 'device-' || e.user_id""")
    s["unknown_devices"] = q("""SELECT e.event_id, 'device-' || e.user_id AS device_id FROM events e
        WHERE NOT EXISTS (SELECT 1 FROM dev_gw m WHERE m.device_id = 'device-' || e.user_id)""")
    s["enrich_telemetry"] = q(f"SELECT device_id, gateway_ts, gateway_id, farm_id, count, {_pts()} FROM etele")
    s["enrich_alerts"] = q(f"""SELECT v.seq, v.device_id, v.state, l.farm_id, {_pts(src="l.")}
        FROM valid v LEFT JOIN locations l USING (device_id)""")
    s["unseen_devices"] = q("SELECT device_id, (gateway_ts - 1) // " + str(W) + " AS w FROM ticks")
    s["device_window_stats"] = q(f"""SELECT device_id, gateway_id, gateway_ts, gateway_ts_iso, count, {stats}
        FROM tele""")
    s["latency_stats"] = q("""SELECT "index", leg, count(*) AS count, round(avg(seconds), 6) AS avg,
        round(quantile_cont(seconds, 0.5), 6) AS p50, round(quantile_cont(seconds, 0.9), 6) AS p90,
        round(quantile_cont(seconds, 0.95), 6) AS p95, round(min(seconds), 6) AS min, round(max(seconds), 6) AS max
        FROM (UNPIVOT legs ON lat_gw_kafka, lat_kafka_spark, lat_spark_es, lat_e2e INTO NAME leg VALUE seconds)
        GROUP BY "index", leg""")
    s["latency_report"] = q("""SELECT "index", leg, count(*) AS count, round(avg(seconds), 6) AS avg,
        round(quantile_cont(seconds, 0.5), 6) AS p50, round(quantile_cont(seconds, 0.9), 6) AS p90,
        round(quantile_cont(seconds, 0.95), 6) AS p95, round(min(seconds), 6) AS min, round(max(seconds), 6) AS max
        FROM (UNPIVOT (SELECT "index",
                              (ts_kafka_ingest - gateway_ts) / 1000.0::DOUBLE AS lat_gw_kafka,
                              (ts_before_es - ts_kafka_ingest) / 1000.0::DOUBLE AS lat_kafka_spark,
                              (epoch_us(created_at) // 1000 - ts_before_es) / 1000.0::DOUBLE AS lat_spark_es,
                              (epoch_us(created_at) // 1000 - gateway_ts) / 1000.0::DOUBLE AS lat_e2e
                       FROM latrows WHERE created_at >= (SELECT max(created_at) FROM lat) - INTERVAL 6 HOURS)
              ON lat_gw_kafka, lat_kafka_spark, lat_spark_es, lat_e2e INTO NAME leg VALUE seconds)
        GROUP BY "index", leg""")
    s["counter_rate"] = q(f"SELECT \"index\", sample_ts, docs, time_ms, {_r6('docs_per_sec')} AS docs_per_sec FROM rates2")
    s["rate_summary"] = q("""SELECT "index", round(avg(docs_per_sec), 6) AS avg_rate,
        round(min(docs_per_sec), 6) AS min_rate, round(max(docs_per_sec), 6) AS max_rate FROM rates2 GROUP BY "index\"""")
    s["median_by_farm_gateway"] = q(
        "SELECT farm, gateway, round(median(light_level_avg), 6) AS median_light_level_avg FROM b2 GROUP BY farm, gateway",
        _nested_top_sql("etele", "light_level_avg", FIX_FARM_SIZE, FIX_GATEWAY_SIZE, "median"))
    from fieldwatch.config import (DASHBOARD_FARM_SIZE, DASHBOARD_GATEWAY_SIZE_COUNT,
                                   DASHBOARD_GATEWAY_SIZE_MEDIAN)

    def median_panel(metric, fs, gs):
        return q(f"SELECT farm, gateway, round(median({metric}), 6) AS median_{metric} FROM b2 GROUP BY farm, gateway",
                 _nested_top_sql("etele", metric, fs, gs, "median"))

    s["median_soil_by_farm_gateway"] = median_panel("soil_moisture_avg", FIX_FARM_SIZE, FIX_GATEWAY_SIZE)
    s["median_humidity_by_farm_gateway"] = median_panel("humidity_avg", FIX_FARM_SIZE, FIX_GATEWAY_SIZE)
    s["panel_light_median"] = median_panel("light_level_avg", DASHBOARD_FARM_SIZE, DASHBOARD_GATEWAY_SIZE_MEDIAN)
    s["panel_soil_median"] = median_panel("soil_moisture_avg", DASHBOARD_FARM_SIZE, DASHBOARD_GATEWAY_SIZE_MEDIAN)
    s["panel_humidity_median"] = median_panel("humidity_avg", DASHBOARD_FARM_SIZE, DASHBOARD_GATEWAY_SIZE_MEDIAN)
    s["panel_record_share"] = q("""SELECT farm, gateway, count(*) AS records,
        round(count(*) / sum(count(*)) OVER (), 6) AS share_total,
        round(count(*) / sum(count(*)) OVER (PARTITION BY farm), 6) AS share_parent
        FROM b2 GROUP BY farm, gateway""", _nested_top_sql("etele", None, DASHBOARD_FARM_SIZE,
                                                          DASHBOARD_GATEWAY_SIZE_COUNT, "count"))
    s["top_farms_other"] = q(f"""SELECT farm, round(median(soil_moisture_avg), 6) AS median_soil_moisture_avg
        FROM (SELECT t.soil_moisture_avg, lab.farm FROM etele t JOIN lab USING (farm_id)
              WHERE t.soil_moisture_avg IS NOT NULL)
        GROUP BY farm""", f"""
lab AS (SELECT farm_id, CASE WHEN row_number() OVER (ORDER BY v DESC, farm_id) <= {FIX_FARM_SIZE}
                             THEN farm_id ELSE '__other__' END AS farm
        FROM (SELECT farm_id, median(soil_moisture_avg) AS v FROM etele
              WHERE farm_id IS NOT NULL AND soil_moisture_avg IS NOT NULL GROUP BY farm_id))""")
    s["record_share"] = q("""SELECT farm, gateway, count(*) AS records,
        round(count(*) / sum(count(*)) OVER (), 6) AS share_total,
        round(count(*) / sum(count(*)) OVER (PARTITION BY farm), 6) AS share_parent
        FROM b2 GROUP BY farm, gateway""", _nested_top_sql("etele", None, FIX_FARM_SIZE, FIX_GATEWAY_SIZE, "count"))
    s["critical_by_gateway"] = q(f"""SELECT gateway, CAST(sum(hits) AS BIGINT) AS critical_or_offline FROM (
        SELECT CASE WHEN row_number() OVER (ORDER BY gateway_id) <= {FIX_ALPHA_SIZE} THEN gateway_id
                    ELSE '__other__' END AS gateway, hits
        FROM (SELECT gateway_id, count_if(state IN ('OFFLINE', 'CRITICAL')) AS hits FROM cleaned
              WHERE gateway_id IS NOT NULL GROUP BY gateway_id)) GROUP BY gateway""")
    s["routes_by_farm"] = q("""SELECT farm_id, array_to_string(list_sort(list(email)), '|') AS emails,
        count(*) AS n_recipients FROM routes GROUP BY farm_id""")
    s["fleet_alerts"] = q(f"SELECT {alert_out} FROM fleet")
    s["device_alerts"] = q(f"SELECT {alert_out} FROM fleet WHERE state <> 'OFFLINE'")
    s["offline_alerts"] = q(f"SELECT {alert_out} FROM fleet WHERE state = 'OFFLINE'")
    s["dedup_alerts"] = q(f"SELECT {alert_out} FROM deduped")
    s["cleaned_alerts"] = q(f"""SELECT {alert_out}, farm_id, {_pts()} FROM cleaned""")
    s["cleaned_raw_alerts"] = q(f"""SELECT seq, device_id, gateway_id, gateway_ts, gateway_ts_iso, state,
        array_to_string(details, '|') AS details, farm_id, {_pts()} FROM rawclean""")
    s["cleaned_alerts_scan"] = q(f"""SELECT device_id, gateway_ts, state, array_to_string(details, '|') AS details,
        farm_id, {_pts(("device",))} FROM cleaned""")
    s["state_transitions"] = q("""SELECT device_id, gateway_ts, event_id, prev_state, state FROM (
        SELECT device_id, gateway_ts, event_id, state,
               coalesce(lag(state) OVER (PARTITION BY device_id ORDER BY gateway_ts, event_id), '') AS prev_state
        FROM gr) WHERE prev_state <> state""")
    lat_txt = "coalesce(CAST(c.device_lat AS VARCHAR), 'None')"
    lon_txt = "coalesce(CAST(c.device_lon AS VARCHAR), 'None')"
    det_txt = "'[' || array_to_string(list_transform(c.details, lambda x: '''' || x || ''''), ', ') || ']'"
    s["notifications"] = q(f"""SELECT r.email, c.farm_id, c.device_id, c.state, {_r6('c.device_lat')} AS lat,
        {_r6('c.device_lon')} AS lon, c.gateway_ts_iso, array_to_string(c.details, '|') AS details,
        '=== ALERT NOTIFICATION ===' || chr(10) || 'To: ' || r.email || chr(10) || 'Device: ' || c.device_id || chr(10)
        || 'State: ' || c.state || chr(10) || 'Location: (' || {lat_txt} || ', ' || {lon_txt} || ')' || chr(10)
        || 'Timestamp: ' || c.gateway_ts_iso || chr(10) || 'Details: ' || {det_txt} || chr(10)
        || '==========================' AS message
        FROM cleaned c JOIN routes r USING (farm_id)""")
    s["unrouted_alerts"] = q("""SELECT device_id, gateway_ts, state, farm_id FROM cleaned c
        WHERE NOT EXISTS (SELECT 1 FROM routes r WHERE r.farm_id = c.farm_id)""")
    s["time_slice"] = q("""SELECT device_id, gateway_ts, count FROM etele,
        (SELECT min(gateway_ts) AS lo, max(gateway_ts) AS hi FROM etele) b
        WHERE CAST(gateway_ts AS DOUBLE) >= CAST(lo AS DOUBLE)
          AND CAST(gateway_ts AS DOUBLE) < CAST(lo AS DOUBLE) + 0.5598711111111111 * CAST(hi - lo AS DOUBLE)""")
    bb = FIX_BBOX
    s["map_points"] = q(f"""SELECT * FROM (
        SELECT 'device' AS layer, true AS visible, device_id, {_r6('device_lat')} AS lat, {_r6('device_lon')} AS lon,
               device_lat AS y, device_lon AS x FROM etele
        UNION ALL SELECT 'farm', false, device_id, {_r6('farm_lat')}, {_r6('farm_lon')}, farm_lat, farm_lon FROM etele
        UNION ALL SELECT 'gateway', true, device_id, {_r6('gateway_lat')}, {_r6('gateway_lon')}, gateway_lat,
               gateway_lon FROM etele)
        WHERE y BETWEEN {bb['min_lat']} AND {bb['max_lat']} AND x BETWEEN {bb['min_lon']} AND {bb['max_lon']}""")
    # the helper columns y/x are dropped by the column list below
    s["map_points"] = s["map_points"].replace("SELECT * FROM (", "SELECT layer, visible, device_id, lat, lon FROM (", 1)
    return s
