"""The streaming jobs (ST1-ST12): telemetry enrichment, alert cleaning,
notification fan-out, and the gateway's windowed aggregate.

Each job is ``readStream`` -> DataFrame transformations -> ``writeStream``.
Sinks run in ``foreachBatch`` with distributed writers that are idempotent per
``batch_id``; nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as dt
import time
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from fieldwatch.config import (CLEANED_ALERT_TOPIC, DEFAULT_PARAMS, METRICS, RAW_ALERT_TOPIC, RAW_TELEMETRY_TOPIC,
                               Params)
from fieldwatch.functions import jsonio
from fieldwatch.functions.scalars import clamp, conform
from fieldwatch.functions.timefmt import epoch_ms, window_end_ms
from fieldwatch.operators import alerts as A
from fieldwatch.operators import dimension as D
from fieldwatch.operators import notify as N
from fieldwatch.operators import partials as P
from fieldwatch.operators import telemetry as T
from fieldwatch.operators.alerts import FLEET_STATE, fleet_step
from fieldwatch.schemas import ALERT_DOC, CLEANED_ALERT, TELEMETRY_DOC
from fieldwatch.session import checkpoint_dir, written_copy
from fieldwatch.sinks import storage
from fieldwatch.sinks import writers as W
from fieldwatch.streaming.sources import topic_file
from fieldwatch.streaming.state import STATE_SCHEMA, dedup_step, expired
from fieldwatch.streaming.versions import KeyedVersions

DEFAULT_TRIGGER = "10 seconds"
STATE_LATENESS = 3_600_000  # how much older than the newest alert one may be, in gateway time (ms)


class LocationCache:
    """The location dimension, looked at again when older than ``ttl_s`` (and, for
    the telemetry job, when it was empty). ``loader`` returns a DataFrame; it is
    written to the shared folder once per load, so micro-batches neither repeat
    its joins nor notice when its files are replaced.

    With ``fingerprint`` (what the sources look like now, e.g. ``storage.fingerprint`` of
    their folders) sources that have not changed are not loaded again. Of the written
    copies the last ``keep`` stay, the one a running micro-batch may hold among them."""

    def __init__(self, loader: Callable[[], DataFrame], ttl_s: float = 300.0, reload_if_empty: bool = False,
                 clock: Callable[[], float] = time.time, fingerprint: Callable[[], str] | None = None, keep: int = 2):
        self.loader, self.ttl_s, self.reload_if_empty, self.clock = loader, ttl_s, reload_if_empty, clock
        self.fingerprint, self.keep, self.copies = fingerprint, keep, []
        self._df, self._loaded, self._empty, self._print = None, 0.0, True, None

    def get(self) -> DataFrame:
        now = self.clock()
        if self._df is None or (now - self._loaded) > self.ttl_s or (self.reload_if_empty and self._empty):
            found = self.fingerprint() if self.fingerprint else None  # before the load: a change meanwhile shows next time
            if self._df is None or found is None or found != self._print:
                self._df, path = written_copy(self.loader(), "locations")
                self._empty, self._print = self._df.isEmpty(), found
                self.copies.append(path)
                while len(self.copies) > self.keep:
                    storage.delete(self._df.sparkSession, self.copies.pop(0))
            self._loaded = now
        return self._df


def _counted(batch: DataFrame, name: str, write) -> int:
    """Run ``write(batch)`` once with an observed row count, which the write
    itself computes, and report it. An empty batch writes no rows."""
    obs = Observation(name)
    write(batch.observe(obs, F.count(F.lit(1)).alias("rows")))
    n = int(obs.get.get("rows", 0))
    if n:
        print(f"[{name}] inserted batch: {n}")
    return n


def progress_samples(query) -> list[dict]:
    """S11 on a live job: cumulative (rows, ms) counters from the query's
    progress reports, the same shape as the index counter samples (feed them
    to ``evaluation.counter_rate``). Reads the driver's progress metadata only."""
    total, ms, out = 0, 0, []
    for p in query.recentProgress:
        total += int(p.numInputRows)
        ms += int(p.durationMs.get("triggerExecution", 0))
        out.append({"index": query.name, "sample_ts": p.timestamp, "total": total, "time_ms": ms})
    return out


def _sampled(folder: str | None, name: str, batch_id: int, spark: SparkSession, write) -> int:
    """Run ``write()`` (which returns a row count) and keep what it did as the batch's
    own sample, so that counters neither end with the query nor count a replay twice."""
    began = time.perf_counter()
    n = write()
    if folder:
        stamp = dt.datetime.now(dt.timezone.utc).isoformat(timespec="milliseconds")
        ms = round((time.perf_counter() - began) * 1000)
        W.write_notifications(spark.createDataFrame([(stamp, n, ms)], "sample_ts string, rows long, ms long"),
                              f"{folder.rstrip('/')}/index={name}", batch_id)
    return n


def counter_table(spark: SparkSession, folder: str) -> DataFrame:
    """Cumulative counters (index, sample_ts, total, time_ms) of all batches of the jobs
    that keep samples in ``folder``, restarts included; one row a batch, in the shape
    ``evaluation.counter_rate`` takes."""
    so_far = Window.partitionBy("index").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return spark.read.parquet(folder).select(
        "index", "sample_ts", F.sum("rows").over(so_far).alias("total"), F.sum("ms").over(so_far).alias("time_ms"))


def _trigger(writer, trigger):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger or DEFAULT_TRIGGER)


def ingest_stamp(df: DataFrame) -> DataFrame:
    """``ts_kafka_ingest`` in epoch ms (one value per micro-batch)."""
    return df.withColumn("ts_kafka_ingest", F.unix_millis(F.current_timestamp()))


# --- telemetry enrichment -------------------------------------------------------------------

def start_telemetry_enrichment(source: DataFrame, locations: LocationCache, out_path: str, checkpoint: str,
                               trigger: str | None = DEFAULT_TRIGGER, counters: str | None = None,
                               partials: str | None = None):
    """Telemetry topic -> parse (P2) -> stamp (P7) -> enrich (J3, J8) ->
    document table (N1, P8, P9, P19). All-NULL rows of unparsable messages are
    kept, as in the reference. ``counters`` and ``partials``: folders of the batches'
    counter samples (S11) and of the panels' partial aggregates."""
    parsed = ingest_stamp(jsonio.parse_telemetry(source))

    def sink(batch: DataFrame, batch_id: int) -> None:
        name, docs = "telemetry_enrichment", T.enrich(batch, locations.get())
        _sampled(counters, name, batch_id, batch.sparkSession, lambda: _counted(
            docs, name, lambda df: W.write_documents(df, out_path, TELEMETRY_DOC, batch_id)))
        if partials:
            P.write_partials(P.telemetry_partials(conform(docs, TELEMETRY_DOC)), partials, batch_id)

    w = parsed.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).queryName("telemetry_enrichment").start()


# --- alert cleaning ----------------------------------------------------------------------------

def start_alert_cleanup(source: DataFrame, locations: LocationCache, out_path: str, raw_log_dir: str,
                        checkpoint: str, *, topic_folder: str | None = None, kafka: str | None = None,
                        dedup_window: int = DEFAULT_PARAMS.dedup_window, raw_log_seconds: int = 300,
                        trigger: str | None = DEFAULT_TRIGGER, seq: str = "seq", state_dir: str | None = None,
                        state_lateness: int = STATE_LATENESS, merge_every: int = 10, counters: str | None = None,
                        partials: str | None = None):
    """Alert topic -> parse (P3) -> stamp (P7) -> raw log of every row (N4) ->
    required fields (P10) -> dedup with keyed state (W1/ST6) -> enrich (J3) ->
    coercions (P11-P13) -> document table (N2) and cleaned topic (N3).

    Two queries share the parsed stream: the raw log must see every row, the
    dedup query only valid ones. Returns both query handles.

    The last kept alert of each device is a table of versions under ``state_dir``
    (default: beside the checkpoint), one version a batch. One that lies the window and
    ``state_lateness`` (in units of gateway time) behind the newest alert ends, so the
    table has the devices that alerted lately; an alert that is later still counts as a
    device's first.
    """
    parsed = ingest_stamp(jsonio.parse_alerts(source, keep=(seq,)))
    if seq != "seq":
        parsed = parsed.withColumnRenamed(seq, "seq")

    def raw_sink(batch: DataFrame, batch_id: int) -> None:
        W.write_raw_log(batch.drop("seq"), raw_log_dir, raw_log_seconds, batch_id)

    raw_w = (parsed.writeStream.outputMode("append").foreachBatch(raw_sink)
             .option("checkpointLocation", f"{checkpoint.rstrip('/')}/raw_log"))
    raw_q = _trigger(raw_w, trigger).queryName("alert_raw_log").start()

    valid = A.valid_alerts(parsed)
    spark = valid.sparkSession
    folder = (state_dir or f"{checkpoint.rstrip('/')}/dedup_state").rstrip("/")
    kept_alerts = KeyedVersions(spark, f"{folder}/kept", "device_id", STATE_SCHEMA, merge_every)
    newest = KeyedVersions(spark, f"{folder}/newest", "id", "id int, seen_max long", merge_every)

    def clean_sink(batch: DataFrame, batch_id: int) -> None:
        checkpoint_dir(spark)
        row = newest.read(batch_id - 1).first()  # one row
        before = row["seen_max"] if row else None
        state = kept_alerts.read(batch_id - 1).where(~expired(before, dedup_window, state_lateness))
        batch = batch.persist()  # counted, laid out and searched for its newest alert
        try:
            kept, changes = dedup_step(batch, dedup_window, state)
            stamps = [x for x in (before, batch.agg(F.max("gateway_ts")).first()[0]) if x is not None]
        finally:
            batch.unpersist()
        seen_max = max(stamps, default=None)
        kept_alerts.write(batch_id, changes, ~expired(seen_max, dedup_window, state_lateness))
        newest.write(batch_id, spark.createDataFrame([(0, seen_max)], "id int, seen_max long"))
        publish(kept, batch_id)
        for table in (kept_alerts, newest):
            table.remove_before(batch_id - 1)  # a replay of this batch reads the version before

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by two writers
        try:
            cleaned = A.conform_cleaned(T.enrich(batch, locations.get()))
            if _sampled(counters, "alert_cleanup", batch_id, spark, lambda: _counted(
                    cleaned, "alert_cleanup", lambda df: W.write_documents(df, out_path, ALERT_DOC, batch_id))) == 0:
                return
            if partials:
                P.write_partials(P.alert_partials(cleaned), partials, batch_id)
            out = W.stamp_before_write(cleaned).drop("created_at")
            W.write_topic(out.select(*[f.name for f in CLEANED_ALERT.fields]), CLEANED_ALERT_TOPIC,
                          kafka=kafka, folder=topic_folder, batch_id=batch_id)
        finally:
            batch.unpersist()

    clean_w = (valid.writeStream.outputMode("append").foreachBatch(clean_sink)
               .option("checkpointLocation", f"{checkpoint.rstrip('/')}/clean"))
    return raw_q, _trigger(clean_w, trigger).queryName("alert_cleanup").start()


# --- notifications -------------------------------------------------------------------------------

def start_notifier(cleaned_source: DataFrame, routes: DataFrame, out_path: str, unrouted_path: str,
                   checkpoint: str, trigger: str | None = DEFAULT_TRIGGER):
    """ST11: cleaned-alert topic -> JSON decode (S3) -> fan-out to the farm's
    recipients (J5, P25) -> notifications table (N11); alerts without a
    recipient (J6) go to their own table. Routes are loaded once (static side)."""
    alerts = jsonio.parse_json(cleaned_source, CLEANED_ALERT)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            W.write_notifications(N.notifications(batch, routes), out_path, batch_id)
            W.write_notifications(N.unrouted_alerts(batch, routes), unrouted_path, batch_id)
        finally:
            batch.unpersist()

    w = alerts.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).queryName("notifier").start()


# --- gateway: windowed telemetry aggregate ---------------------------------------------------------

def start_gateway_telemetry(readings: DataFrame, dev_gw: DataFrame, topic_folder: str | None, checkpoint: str,
                            params: Params = DEFAULT_PARAMS, watermark: str | None = None,
                            event_time: str = "event_time", trigger: str | None = DEFAULT_TRIGGER,
                            kafka: str | None = None):
    """ST5 (A1 on a stream): clamped readings -> event-time tumbling windows
    with a watermark -> telemetry messages on the telemetry topic: Kafka (N13) when
    a broker is given, else its NDJSON folder (N6). Rows later than the watermark
    are dropped and counted by the engine (``numRowsDroppedByWatermark`` in the
    query progress); :func:`start_gateway_windows` keeps them."""
    if not kafka and not topic_folder:
        raise ValueError("either kafka or topic_folder is required")
    wm = watermark or f"{params.window_ms} milliseconds"
    stats = T.device_window_stats_stream(clamp(readings, params.clamp_bounds), params.window_ms, wm, event_time,
                                         dev_gw)
    values = jsonio.rows_to_json(stats)
    if kafka:
        w = (values.writeStream.outputMode("append").format("kafka").option("kafka.bootstrap.servers", kafka)
             .option("topic", RAW_TELEMETRY_TOPIC))
    else:
        target = f"{topic_folder.rstrip('/')}/{topic_file(RAW_TELEMETRY_TOPIC)}"
        w = values.writeStream.outputMode("append").format("text").option("path", target)
    return _trigger(w.option("checkpointLocation", checkpoint), trigger).queryName("gateway_telemetry").start()


#: an open window's partial aggregates, as telemetry.window_partials has them
WINDOW_STATE = "device_id string, gateway_ts long, count long, " + ", ".join(
    f"{m}_n long, {m}_sum double, {m}_m2 double, {m}_min double, {m}_max double" for m in METRICS)


def start_gateway_windows(readings: DataFrame, dev_gw: DataFrame, state_dir: str, checkpoint: str, late_path: str, *,
                          params: Params = DEFAULT_PARAMS, topic_folder: str | None = None, kafka: str | None = None,
                          lateness_ms: int | None = None, event_time: str = "event_time",
                          trigger: str | None = DEFAULT_TRIGGER, merge_every: int = 10):
    """ST5 with every late reading kept (ST9): the windows of
    :func:`start_gateway_telemetry`, for those who need the rows that the engine's
    watermark drops. A window is published once a reading ``lateness_ms`` (default: a
    window) or more newer than its end has been seen; a reading of a window published by
    then, or without an event time, goes whole to the table ``late_path`` with
    ``closed_upto``, the end of the last window closed before. So every reading of a
    registered device is counted in one published or open window, or is a row there.

    Open windows are partial aggregates (one row a device and window) in a table of
    versions under ``state_dir``: a batch merges its own into those it touches and writes
    these alone. Batch n reads version n - 1 and owns its late rows and messages in
    folders, so replays are idempotent (to Kafka: at least once).
    """
    if not kafka and not topic_folder:
        raise ValueError("either kafka or topic_folder is required")
    spark, root = readings.sparkSession, state_dir.rstrip("/")
    lateness = params.window_ms if lateness_ms is None else lateness_ms
    windows = KeyedVersions(spark, f"{root}/open", ["device_id", "gateway_ts"], WINDOW_STATE, merge_every)
    marks = KeyedVersions(spark, f"{root}/mark", "id", "id int, seen_max long, closed_upto long", merge_every)
    event_ms = epoch_ms(F.col(event_time))
    end = window_end_ms(event_ms, params.window_ms)
    clamped = clamp(readings, params.clamp_bounds)

    def sink(batch: DataFrame, batch_id: int) -> None:
        m = marks.read(batch_id - 1).first()  # one row
        seen_before, closed_before = (m["seen_max"], m["closed_upto"]) if m else (None, None)
        is_open = lambda upto: F.lit(True) if upto is None else F.col("gateway_ts") > F.lit(upto)
        batch = batch.persist()  # its newest reading, its late rows, its windows
        merged = None
        try:
            stamps = [x for x in (seen_before, batch.agg(F.max(event_ms)).first()[0]) if x is not None]
            seen_max = max(stamps, default=None)
            closed_upto = None if seen_max is None else seen_max - lateness
            late = end.isNull() if closed_before is None else end.isNull() | (end <= F.lit(closed_before))
            _write_late(batch.where(late).withColumn("closed_upto", F.lit(closed_before).cast("long")), late_path,
                        batch_id, "gateway_windows")
            own = T.window_partials(batch.where(~late), params.window_ms, event_ms)
            merged = T.merge_partials(windows.read(batch_id - 1).where(is_open(closed_before)), own, "touched").persist()
            windows.write(batch_id, merged.where(F.col("touched") & is_open(closed_upto)), is_open(closed_upto))
            closing = merged.where(F.lit(False) if closed_upto is None else ~is_open(closed_upto)).drop("touched")
            W.write_topic(T.stats_of_partials(closing, dev_gw), RAW_TELEMETRY_TOPIC, kafka=kafka, folder=topic_folder,
                          batch_id=batch_id)
            marks.write(batch_id, spark.createDataFrame([(0, seen_max, closed_upto)], marks.schema))
        finally:
            if merged is not None:
                merged.unpersist()
            batch.unpersist()
        for table in (windows, marks):
            table.remove_before(batch_id - 1)  # a replay of this batch reads the version before

    w = clamped.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).queryName("gateway_windows").start()


def start_raw_telemetry_sink(records: DataFrame, folder: str, checkpoint: str, flush: str = "30 seconds",
                             json_copy: str | None = None):
    """N5 + W7: raw gateway records to day-partitioned Parquet, flushed every
    ``flush`` (the reference writes a file when 30 s have passed and its
    buffer is non-empty; an empty trigger writes no rows here either). Each batch
    is a folder of its own, which the archive job may take away."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        W.write_raw_telemetry(batch, folder, json_copy, batch_id)

    w = records.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, flush).queryName("raw_telemetry").start()


def start_rejects_sink(readings: DataFrame, dev_gw: DataFrame, folder: str, checkpoint: str,
                       trigger: str | None = DEFAULT_TRIGGER):
    """J4 rejects on a stream: readings of unregistered devices, which neither the
    telemetry nor the alert query publishes, kept in a table of their own."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        W.write_notifications(D.unknown_devices(batch, dev_gw), folder, batch_id)

    w = readings.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).queryName("gateway_rejects").start()


def await_all(spark: SparkSession, timeout: float | None = None) -> None:
    """ST12."""
    spark.streams.awaitAnyTermination(timeout)


# --- gateway: alert machine with a versioned state table (ST7) --------------------------------------

def _state_path(state_dir: str, version: int, table: str = "state") -> str:
    return f"{state_dir.rstrip('/')}/{table}/v={int(version)}"


def start_gateway_alerts(readings: DataFrame, dev_gw: DataFrame, state_dir: str, checkpoint: str, *,
                         params: Params = DEFAULT_PARAMS, topic_folder: str | None = None, kafka: str | None = None,
                         seq: str = "seq", lateness_ms: int = 0, trigger: str | None = DEFAULT_TRIGGER,
                         late_path: str | None = None, merge_every: int = 10):
    """ST7: classified readings (device_id, gateway_ts, state, details, seq)
    -> W2 + W3 over *closed* gateway windows, against the per-device state of
    the previous batch -> alerts on the raw-alert topic.

    A window is closed once a reading stamped more than ``lateness_ms`` after
    its end has been seen (a watermark). Readings of open windows wait in a
    pending table; readings for windows already folded are late: they leave the
    machine, into the table ``late_path`` if one is given (ST9: whole rows with
    ``closed_upto``, the end of the last window folded before them; a batch owns its
    rows there, so a replay replaces them), and their number is observed while they are
    written. Micro-batches may therefore cut windows anywhere.
    Per batch ``n`` three small tables are written under ``state_dir``: the
    device state (of the devices that spoke or alerted in it, see
    :class:`KeyedVersions`), the pending readings and the watermark mark, each as
    version ``n``, also for batches without rows. Batch ``n`` reads version ``n - 1``, so
    a replayed batch rewrites the same version: replays are idempotent. A missing or
    unreadable version stops the query; it never starts again from nothing. Older
    versions are removed once the next one stands.
    """
    spark = readings.sparkSession
    cols = ["device_id", "gateway_ts", "state", "details", seq]
    states = KeyedVersions(spark, f"{state_dir.rstrip('/')}/state", "device_id", FLEET_STATE, merge_every)

    def read_version(table: str, version: int):
        return spark.read.parquet(_state_path(state_dir, version, table)) if version >= 0 else None

    def write_version(df: DataFrame, table: str, version: int) -> None:
        df.write.mode("overwrite").parquet(_state_path(state_dir, version, table))

    def remove_before(version: int) -> None:
        states.remove_before(version)
        for table in ("pending", "mark"):
            for path, name, _ in storage.children(spark, f"{state_dir.rstrip('/')}/{table}"):
                if name.startswith("v=") and int(name[2:]) < version:
                    storage.delete(spark, path)

    def sink(batch: DataFrame, batch_id: int) -> None:
        prev_state = states.read(batch_id - 1) if batch_id else None
        pending = read_version("pending", batch_id - 1)
        mark = read_version("mark", batch_id - 1)
        m = mark.first() if mark is not None else None  # one row: the watermark bookkeeping
        seen_max, done_upto = (m["seen_max"], m["done_upto"]) if m else (None, None)
        rows = batch.select(*cols)
        if pending is not None:
            rows = pending.select(*cols).unionByName(rows)
        rows = rows.persist()
        try:
            stamps = [x for x in (seen_max, rows.agg(F.max("gateway_ts")).first()[0]) if x is not None]
            new_max = max(stamps, default=None)
            closed_upto = None if new_max is None else new_max - lateness_ms - 1  # windows that end before are closed
            late = F.lit(False) if done_upto is None else F.col("gateway_ts") <= F.lit(done_upto)
            if done_upto is not None:
                _write_late(rows.filter(late).withColumn("closed_upto", F.lit(done_upto)), late_path, batch_id,
                            "gateway_alerts")
            ready = rows.filter(~late & (F.col("gateway_ts") <= F.lit(closed_upto).cast("long")))
            still_open = rows.filter(~late & (F.col("gateway_ts") > F.lit(closed_upto).cast("long")))
            done = ready.agg(F.max("gateway_ts")).first()[0]
            if done is not None:
                alerts, changed = fleet_step(ready, dev_gw, params, prev_state, seq)
                states.write(batch_id, changed)
                W.write_topic(alerts.drop("seq"), RAW_ALERT_TOPIC, kafka=kafka, folder=topic_folder,
                              batch_id=batch_id)
            else:
                states.write(batch_id, spark.createDataFrame([], FLEET_STATE))
            write_version(still_open, "pending", batch_id)
            write_version(spark.createDataFrame([(new_max, done_upto if done is None else done)],
                                                "seen_max long, done_upto long"), "mark", batch_id)
        finally:
            rows.unpersist()
        remove_before(batch_id - 1)  # the version before stays for a replay of this batch

    w = readings.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).queryName("gateway_alerts").start()


def _write_late(late: DataFrame, path: str | None, batch_id: int, job: str) -> int:
    """ST9: late rows into their table (or only counted), and how many there were."""
    obs = Observation("late")
    late = late.observe(obs, F.count(F.lit(1)).alias("rows"))
    if path:
        W.write_notifications(late, path, batch_id)
    else:
        late.write.format("noop").mode("overwrite").save()
    n = int(obs.get.get("rows", 0))
    if n:
        print(f"[{job}] batch {batch_id}: {n} late readings" + (f" in {path}" if path else " dropped"))
    return n
