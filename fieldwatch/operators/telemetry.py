"""Telemetry path: P18 raw records, A1 windowed device statistics, J3 enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.config import METRICS
from fieldwatch.functions.timefmt import epoch_ms, iso_of_ms, window_end_ms
from fieldwatch.operators.dimension import null_point
from fieldwatch.schemas import LOCATION_COLUMNS


def raw_records(readings: DataFrame, dev_gw: DataFrame, window_ms: int) -> DataFrame:
    """Reading merged with its gateway info (right side wins)."""
    gts = window_end_ms(F.col("device_ts"), window_ms)
    r = readings.drop("gateway_id", "gateway_ts", "gateway_ts_iso")
    return (r.join(dev_gw, "device_id", "inner")
            .withColumn("gateway_ts", gts)
            .withColumn("gateway_ts_iso", iso_of_ms(gts)))


def _stat_aggs() -> list:
    aggs = [F.count(F.lit(1)).alias("count")]
    for m in METRICS:
        aggs += [F.avg(m).alias(f"{m}_avg"), F.min(m).alias(f"{m}_min"),
                 F.max(m).alias(f"{m}_max"), F.stddev_pop(m).alias(f"{m}_std")]
    return aggs


def device_window_stats(readings: DataFrame, window_ms: int, dev_gw: DataFrame | None = None) -> DataFrame:
    """A1: per (device, gateway window) count and avg/min/max/population std of
    the four (already clamped) metrics; windows without readings emit nothing.

    ``groupBy`` aggregates partially before the shuffle, so a busy device
    contributes one partial row per map task and window, not all its readings.
    The gateway id is joined after the aggregation, on the far smaller result.
    With ``dev_gw`` only registered devices are published, as the gateway's strict
    lookup (J4) demands; readings of others are ``dimension.unknown_devices``.
    """
    gts = window_end_ms(F.col("device_ts"), window_ms)
    agg = readings.groupBy("device_id", gts.alias("gateway_ts")).agg(*_stat_aggs())
    agg = agg.withColumn("gateway_ts_iso", iso_of_ms(F.col("gateway_ts")))
    if dev_gw is not None:
        agg = agg.join(dev_gw, "device_id")
    else:
        agg = agg.withColumn("gateway_id", F.lit(None).cast("string"))
    stat_cols = [c for c in agg.columns if c not in ("device_id", "gateway_id", "gateway_ts", "gateway_ts_iso",
                                                     "count")]
    return agg.select("device_id", "gateway_id", "gateway_ts", "gateway_ts_iso", "count", *stat_cols)


def device_window_stats_stream(readings: DataFrame, window_ms: int, watermark: str, event_time: str = "event_time",
                               dev_gw: DataFrame | None = None) -> DataFrame:
    """A1 on a stream: event-time tumbling windows with a watermark (append mode
    emits a window once the watermark passes its end; later rows are dropped and
    counted by the engine as ``numRowsDroppedByWatermark``)."""
    w = F.window(event_time, f"{window_ms} milliseconds")
    agg = (readings.withWatermark(event_time, watermark)
           .groupBy(w.alias("w"), "device_id").agg(*_stat_aggs()))
    gts = epoch_ms(F.col("w.end"))
    agg = agg.select("device_id", gts.alias("gateway_ts"), iso_of_ms(gts).alias("gateway_ts_iso"),
                     *[c for c in agg.columns if c not in ("w", "device_id")])
    if dev_gw is not None:
        agg = agg.join(dev_gw, "device_id")
    else:
        agg = agg.withColumn("gateway_id", F.lit(None).cast("string"))
    return agg


def window_partials(readings: DataFrame, window_ms: int, event_ms: Column) -> DataFrame:
    """A1 in a form that merges: per (device, gateway window) the number of readings and
    of each metric's values their number, sum, squared distance from the mean, minimum
    and maximum. ``event_ms``: epoch ms of a reading."""
    aggs = [F.count(F.lit(1)).alias("count")]
    for m in METRICS:
        aggs += [F.count(m).alias(f"{m}_n"), F.sum(m).alias(f"{m}_sum"),
                 (F.var_pop(m) * F.count(m)).alias(f"{m}_m2"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max")]
    return readings.groupBy("device_id", window_end_ms(event_ms, window_ms).alias("gateway_ts")).agg(*aggs)


def merge_partials(before: DataFrame, new: DataFrame, touched: str) -> DataFrame:
    """Two tables of :func:`window_partials` (each with one row a device and window) as
    one; ``touched`` tells whether ``new`` had the row. Squared distances are merged by
    the distance of the two means, so large values with a small spread keep theirs."""
    names = [c for c in before.columns if c not in ("device_id", "gateway_ts")]
    part = lambda df, name: df.select("device_id", "gateway_ts", *[
        (F.struct(*names) if name == side else F.lit(None)).alias(side) for side in ("a", "b")])
    both = (part(before, "a").unionByName(part(new, "b"), allowMissingColumns=True)
            .groupBy("device_id", "gateway_ts").agg(F.max("a").alias("a"), F.max("b").alias("b")))
    value = lambda side, name, empty=0: F.coalesce(F.col(f"{side}.{name}"), F.lit(empty))
    out = [(value("a", "count") + value("b", "count")).alias("count")]
    for m in METRICS:
        n_a, n_b = value("a", f"{m}_n"), value("b", f"{m}_n")
        distance = F.col(f"b.{m}_sum") / F.nullif(n_b, F.lit(0)) - F.col(f"a.{m}_sum") / F.nullif(n_a, F.lit(0))
        between = F.coalesce(distance * distance * n_a * n_b / (n_a + n_b), F.lit(0.0))  # one side empty: none
        out += [(n_a + n_b).alias(f"{m}_n"), (value("a", f"{m}_sum", 0.0) + value("b", f"{m}_sum", 0.0)).alias(f"{m}_sum"),
                (value("a", f"{m}_m2", 0.0) + value("b", f"{m}_m2", 0.0) + between).alias(f"{m}_m2"),
                F.least(f"a.{m}_min", f"b.{m}_min").alias(f"{m}_min"),
                F.greatest(f"a.{m}_max", f"b.{m}_max").alias(f"{m}_max")]
    return both.select("device_id", "gateway_ts", *out, F.col("b").isNotNull().alias(touched))


def stats_of_partials(partials: DataFrame, dev_gw: DataFrame) -> DataFrame:
    """The rows of :func:`device_window_stats` from their merged partial aggregates."""
    stats = []
    for m in METRICS:
        n = F.nullif(F.col(f"{m}_n"), F.lit(0))
        stats += [(F.col(f"{m}_sum") / n).alias(f"{m}_avg"), f"{m}_min", f"{m}_max",
                  F.sqrt(F.col(f"{m}_m2") / n).alias(f"{m}_std")]
    return partials.join(dev_gw, "device_id").select(
        "device_id", "gateway_id", "gateway_ts", iso_of_ms(F.col("gateway_ts")).alias("gateway_ts_iso"), "count", *stats)


def enrich(df: DataFrame, locations: DataFrame, stamp: bool = False) -> DataFrame:
    """Left lookup of farm id and the three locations by ``device_id``.

    Unknown or NULL devices keep their row with a NULL farm id and points whose
    coordinates are NULL. The message's own ``gateway_id`` is retained.
    """
    loc = locations.select("device_id", "farm_id", *LOCATION_COLUMNS)
    drop = [c for c in ("farm_id", *LOCATION_COLUMNS) if c in df.columns]
    out = df.drop(*drop).join(loc, "device_id", "left")
    out = out.withColumns({c: F.coalesce(F.col(c), null_point()) for c in LOCATION_COLUMNS})
    if stamp:
        out = out.withColumn("ts_kafka_ingest", F.unix_millis(F.current_timestamp()))
    return out
