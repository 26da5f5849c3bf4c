"""Command line for the jobs: ``python -m fieldwatch.streaming.run <job> ...``.

Streaming jobs read a Kafka topic when ``--kafka`` is given, else the topic's
folder of NDJSON files under ``--topics``. Checkpoints go under
``--checkpoint`` (default: ``spark.checkpoint.dir`` of the session).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F

from fieldwatch.config import (ALERT_INDEX, CLEANED_ALERT_TOPIC, DEFAULT_PARAMS, RAW_ALERT_TOPIC,
                               RAW_TELEMETRY_TOPIC, TELEMETRY_INDEX)
from fieldwatch.session import build_session, checkpoint_dir
from fieldwatch.streaming.sources import file_lines


STREAMING = ("telemetry", "alerts", "notifier", "gateway")


def _source(spark, args, topic, offsets):
    from fieldwatch.streaming.sources import topic_file, topic_stream
    if args.kafka:
        return topic_stream(spark, topic, kafka=args.kafka, starting_offsets=args.starting_offsets or offsets,
                            max_per_trigger=args.max_per_trigger)
    return topic_stream(spark, topic, folder=f"{args.topics.rstrip('/')}/{topic_file(topic)}",
                        starting_offsets=args.starting_offsets or offsets, max_bytes=_max_bytes(args))


def _max_bytes(args) -> int | None:
    """How much of a folder a micro-batch takes; one that takes all there is has no limit."""
    return None if args.trigger == "availableNow" else args.max_bytes


def _checkpoint(spark, args) -> str:
    """Where streaming state lives. Streaming jobs need a folder that outlives the
    process, so a scratch folder made up for a local session is refused."""
    configured = args.checkpoint or spark.conf.get("spark.checkpoint.dir", None)
    if not configured and args.job in STREAMING:
        raise SystemExit(f"{args.job}: give --checkpoint or set spark.checkpoint.dir")
    return (configured or checkpoint_dir(spark)).rstrip("/") + f"/{args.job}"


def _params(args):
    """The gateway's settings from the command line."""
    bounds = dict(DEFAULT_PARAMS.thresholds)
    for text in args.threshold or ():
        metric, low, high = text.split(",")
        if metric not in bounds:
            raise ValueError(f"unknown metric: {metric}")
        bounds[metric] = (float(low), float(high))
    return DEFAULT_PARAMS.with_(window_ms=args.window_ms, cooldown_ms=args.cooldown_ms,
                                recovery_ms=args.recovery_ms, offline_ms=args.offline_ms, thresholds=bounds)


def _gateway(spark, args, ckpt) -> list:
    """Start the gateway's queries: telemetry, alerts, and, where folders are
    given, raw records and rejects. Returns their handles."""
    from fieldwatch.functions.jsonio import parse_json
    from fieldwatch.functions.scalars import clamp, state_col, violations_col
    from fieldwatch.functions.timefmt import window_end_ms
    from fieldwatch.operators.telemetry import raw_records
    from fieldwatch.schemas import READING
    from fieldwatch.session import written
    from fieldwatch.sources.tables import load_device_gateway
    from fieldwatch.streaming import jobs as J

    p = _params(args)
    dev_gw = written(load_device_gateway(spark, args.dims), "device-gateways")
    raw = parse_json(file_lines(spark, args.input, args.max_per_trigger), READING, keep=("seq",))
    r = clamp(raw.withColumn("event_time", F.timestamp_millis("device_ts")), p.clamp_bounds)
    if args.late_telemetry:
        queries = [J.start_gateway_windows(r, dev_gw, f"{ckpt}/windows_state", f"{ckpt}/windows", args.late_telemetry,
                                           params=p, topic_folder=args.topics, kafka=args.kafka, trigger=args.trigger)]
    else:
        queries = [J.start_gateway_telemetry(r, dev_gw, args.topics, f"{ckpt}/telemetry", p, trigger=args.trigger,
                                             kafka=args.kafka)]
    classified = (r.withColumn("gateway_ts", window_end_ms(F.col("device_ts"), p.window_ms))
                  .withColumn("state", state_col(p.thresholds)).withColumn("details", violations_col(p.thresholds)))
    queries.append(J.start_gateway_alerts(classified, dev_gw, f"{ckpt}/state", f"{ckpt}/alerts", params=p,
                                          topic_folder=args.topics, kafka=args.kafka, trigger=args.trigger,
                                          lateness_ms=args.lateness_ms, late_path=args.late))
    if args.out:
        records = raw_records(r.drop("event_time", "seq"), dev_gw, p.window_ms)
        flush = args.trigger if args.trigger == "availableNow" else args.flush
        queries.append(J.start_raw_telemetry_sink(records, args.out, f"{ckpt}/raw", flush))
    if args.out2:
        queries.append(J.start_rejects_sink(raw, dev_gw, args.out2, f"{ckpt}/rejects", args.trigger))
    return queries


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="fieldwatch")
    ap.add_argument("job", choices=["telemetry", "alerts", "notifier", "gateway", "archive-alerts",
                                    "archive-telemetry", "compact-documents", "latency-report", "speed-report"])
    ap.add_argument("--kafka")
    ap.add_argument("--topics", help="folder of topic NDJSON folders (when no Kafka)")
    ap.add_argument("--dims", help="folder with farm, gateway, device, farm_gateway_device Parquet")
    ap.add_argument("--routes", help="alert_routes Parquet")
    ap.add_argument("--out", help="output table / folder (gateway: raw records)")
    ap.add_argument("--out2", help="second output (unrouted alerts, raw alert log, rejects, latency rows)")
    ap.add_argument("--input", help="input folder (readings, logs, raw Parquet, documents)")
    ap.add_argument("--checkpoint", help="folder of streaming checkpoints and state (default: spark.checkpoint.dir)")
    ap.add_argument("--max-per-trigger", type=int, default=1000,
                    help="offsets (Kafka) or files of readings per micro-batch, so that a backlog is worked off in parts")
    ap.add_argument("--max-bytes", type=int, default=1 << 30, help="the same for topic folders, in bytes")
    ap.add_argument("--starting-offsets", help="earliest, latest or JSON (default: as the job needs; a restart goes on)")
    ap.add_argument("--window-ms", type=int, default=DEFAULT_PARAMS.window_ms)
    ap.add_argument("--cooldown-ms", type=int, default=DEFAULT_PARAMS.cooldown_ms)
    ap.add_argument("--recovery-ms", type=int, default=DEFAULT_PARAMS.recovery_ms)
    ap.add_argument("--offline-ms", type=int, default=DEFAULT_PARAMS.offline_ms)
    ap.add_argument("--lateness-ms", type=int, default=0)
    ap.add_argument("--counters", help="telemetry, alerts: folder of the jobs' counter samples (speed-report --live)")
    ap.add_argument("--partials", help="telemetry, alerts: folder of the panels' partial aggregates")
    ap.add_argument("--live", action="store_true", help="speed report: the input holds the jobs' own samples")
    ap.add_argument("--late", help="gateway: table of the alert machine's late readings")
    ap.add_argument("--late-telemetry", help="gateway: table of the telemetry windows' late readings (without it the "
                    "engine drops and counts them); choose before the first start")
    ap.add_argument("--threshold", action="append", metavar="METRIC,LOW,HIGH", help="critical bounds of a metric")
    ap.add_argument("--flush", default="30 seconds", help="gateway: raw record flush interval")
    ap.add_argument("--trigger", default="10 seconds")
    ap.add_argument("--dedup-window", type=int, default=DEFAULT_PARAMS.dedup_window)
    ap.add_argument("--raw-log-window", type=int, default=300)
    ap.add_argument("--location-ttl", type=float, default=300.0)
    ap.add_argument("--as-of", help="latency report: ISO time the look-back ends (default now)")
    args = ap.parse_args(argv)

    spark = build_session(app=f"fieldwatch-{args.job}")
    ckpt = _checkpoint(spark, args)
    from fieldwatch.streaming import jobs as J

    if args.job in ("telemetry", "alerts"):
        from fieldwatch.sources.tables import load_locations
        from fieldwatch.sinks.storage import fingerprint
        loc = J.LocationCache(lambda: load_locations(spark, args.dims), args.location_ttl,
                              reload_if_empty=args.job == "telemetry", fingerprint=lambda: fingerprint(spark, args.dims))
        if args.job == "telemetry":
            J.start_telemetry_enrichment(_source(spark, args, RAW_TELEMETRY_TOPIC, "latest"), loc, args.out, ckpt,
                                         args.trigger, args.counters, args.partials)
        else:
            J.start_alert_cleanup(_source(spark, args, RAW_ALERT_TOPIC, "latest"), loc, args.out, args.out2, ckpt,
                                  topic_folder=args.topics, kafka=args.kafka, dedup_window=args.dedup_window,
                                  raw_log_seconds=args.raw_log_window, trigger=args.trigger, counters=args.counters,
                                  partials=args.partials)
        J.await_all(spark)
    elif args.job == "notifier":
        from fieldwatch.sources.tables import read_routes
        J.start_notifier(_source(spark, args, CLEANED_ALERT_TOPIC, "earliest"), read_routes(spark, args.routes),
                         args.out, args.out2, ckpt, args.trigger)
        J.await_all(spark)
    elif args.job == "gateway":
        queries = _gateway(spark, args, ckpt)
        if args.trigger == "availableNow":
            for q in queries:
                q.awaitTermination()
        else:
            J.await_all(spark)
    elif args.job == "archive-alerts":
        from fieldwatch.sinks.archive import archive_alert_logs
        stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M")
        print(archive_alert_logs(spark, args.input, args.out, stamp))
    elif args.job == "archive-telemetry":
        from fieldwatch.sinks.archive import archive_raw_telemetry
        stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
        print(archive_raw_telemetry(spark, args.input, args.out, stamp))
    elif args.job == "compact-documents":
        from fieldwatch.sinks.compact import compact
        print(compact(spark, args.input, dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")))
    elif args.job == "latency-report":
        from fieldwatch.operators import evaluation as E
        from fieldwatch.sinks.writers import write_csv
        from fieldwatch.sinks.compact import recent_documents
        as_of = F.lit(args.as_of).cast("timestamp") if args.as_of else F.current_timestamp()
        now = spark.range(1).select(F.unix_millis(as_of)).first()[0]
        # of merged days only the last hours' folders are read
        docs = E.union_indices({i: recent_documents(spark, f"{args.input}/{i}", now)
                                for i in (TELEMETRY_INDEX, ALERT_INDEX)})
        legs = E.latency_legs(E.latency_rows(E.recent(docs, as_of)))
        # one row per document, and the statistics over them
        write_csv(legs, args.out2 or f"{args.out.rstrip('/')}_documents")
        write_csv(E.latency_stats(legs), args.out)
    elif args.job == "speed-report":
        from fieldwatch.operators import evaluation as E
        from fieldwatch.sinks.writers import write_csv
        rates = E.counter_rate(J.counter_table(spark, args.input) if args.live else spark.read.parquet(args.input))
        write_csv(rates, args.out)
        write_csv(E.rate_summary(rates), args.out2)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
