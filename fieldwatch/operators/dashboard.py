"""Dashboard queries: nested top-N with an Other bucket (K1-K3), medians (A4),
record shares (A5), conditional counts (A6), time slice (P23), map layers (P24).

Top-N semantics of a terms bucket with ``otherBucket``: rank the keys by the
metric (ties: key ascending), keep the first N, pool the rest under one
``Other`` label and recompute the metric on the pooled rows (a median of
the pool, not a median of medians). NULL keys are excluded. The inner level is
ranked inside each outer label, Other included.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.config import OTHER_LABEL, STATE_CRITICAL, STATE_OFFLINE
from fieldwatch.functions.cells import cell_of, cover, in_cover
from fieldwatch.operators.quantiles import value_counts, weighted_percentiles
from fieldwatch.session import checkpoint_dir

# FIXED VALUES of the saved dashboard
TIME_SLICE_START_FRACTION = -0.0067955555555555556
TIME_SLICE_END_FRACTION = 0.5598711111111111
TIME_SLICE_ANCHORED = True
MAP_BUFFER = {"min_lon": 108.06152, "min_lat": 11.86735, "max_lon": 108.2373, "max_lat": 11.95335}
MAP_LAYERS = (("device", "device_location", True), ("farm", "farm_location", False),
              ("gateway", "gateway_location", True))


def _materialise(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _label(metric_by_key: DataFrame, parent: list[str], key: str, size: int, by: str, label: str) -> DataFrame:
    """Label per (parent..., key): the key itself for the first ``size`` keys of
    each parent, Other for the rest. The table ranked here holds one row per
    distinct key, never raw rows."""
    order = [F.col(key).asc()] if by == "alpha" else [F.col("value").desc(), F.col(key).asc()]
    if not parent:
        # top-N: each task keeps its best N, the merge sees N per task; the N
        # winners (a size fixed by the caller) are broadcast to label the rest
        top = metric_by_key.orderBy(*order).limit(size).select(key, F.lit(True).alias("_top"))
        return (metric_by_key.join(F.broadcast(top), key, "left")
                .select(key, F.when(F.col("_top"), F.col(key)).otherwise(F.lit(OTHER_LABEL)).alias(label)))
    w = Window.partitionBy(*parent).orderBy(*order)
    return metric_by_key.select(*parent, key, F.when(F.row_number().over(w) <= size, F.col(key))
                                .otherwise(F.lit(OTHER_LABEL)).alias(label))


def _metric(kind: str, num_partitions=None):
    """The metric of groups of the pre-aggregated table ``(keys, [_v], _n)``."""
    if kind == "count":
        return lambda rows, groups: rows.groupBy(*groups).agg(F.sum("_n").alias("value"))
    return lambda rows, groups: weighted_percentiles(rows, groups, "_v", [0.5], ["value"],
                                                     num_partitions=num_partitions)


def _reduced(rows: DataFrame, keys: list[str], metric: str | None) -> DataFrame:
    """Raw rows combined map-side to one row per keys (and value of ``metric``),
    rows with a NULL key or value left out. Everything else reads this table."""
    base = rows
    for k in keys:
        base = base.filter(F.col(k).isNotNull())
    if metric is None:
        return base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # three percentile layouts read it: written once
    return _materialise(value_counts(base, keys, metric).withColumnRenamed(metric, "_v"))


def nested_top(rows: DataFrame, outer: str, inner: str, metric: str | None, outer_size: int, inner_size: int,
               kind: str = "median", num_partitions=None) -> DataFrame:
    """K1 + K2: metric per (outer label, inner label) with Other buckets."""
    return nested_top_of(_reduced(rows, [outer, inner], metric), outer, inner, outer_size, inner_size, kind,
                         num_partitions)


def nested_top_of(base: DataFrame, outer: str, inner: str, outer_size: int, inner_size: int, kind: str = "median",
                  num_partitions=None) -> DataFrame:
    """The same from rows that are already counted: (outer, inner, [_v,] _n)."""
    calc = _metric(kind, num_partitions)
    outer_lab = _label(calc(base, [outer]), [], outer, outer_size, "metric", "outer_label")
    lab1 = base.join(outer_lab, outer)
    inner_lab = _label(calc(lab1, ["outer_label", inner]), ["outer_label"], inner, inner_size, "metric",
                       "inner_label")
    lab2 = lab1.join(inner_lab, ["outer_label", inner])
    return calc(lab2, ["outer_label", "inner_label"])


def top_terms(rows: DataFrame, key: str, metric: str | None, size: int, kind: str = "median",
              num_partitions=None) -> DataFrame:
    """K1: single-level top-N by metric with Other."""
    calc = _metric(kind, num_partitions)
    base = _reduced(rows, [key], metric)
    lab = _label(calc(base, [key]), [], key, size, "metric", "label")
    return calc(base.join(lab, key), ["label"])


def median_by_farm_gateway(telemetry: DataFrame, metric: str, farm_size: int, gateway_size: int,
                           num_partitions=None) -> DataFrame:
    """A4 (+K1/K2): median of ``metric`` by farm and gateway (the panels are
    titled "Average" but compute the median)."""
    out = nested_top(telemetry, "farm_id", "gateway_id", metric, farm_size, gateway_size, "median", num_partitions)
    return out.select(F.col("outer_label").alias("farm"), F.col("inner_label").alias("gateway"),
                      F.col("value").alias(f"median_{metric}"))


def record_share(telemetry: DataFrame, farm_size: int, gateway_size: int) -> DataFrame:
    """A5: record count by farm and gateway (+Other) with its share of the
    total and of the farm bucket. One aggregation reads the raw rows; ranks,
    labels and shares follow from its (farm, gateway, count) table."""
    return shares(nested_top(telemetry, "farm_id", "gateway_id", None, farm_size, gateway_size, "count"))


def shares(counts: DataFrame) -> DataFrame:
    """Counts by outer and inner label with their shares of the total and of the outer one."""
    return counts.select(
        F.col("outer_label").alias("farm"), F.col("inner_label").alias("gateway"),
        F.col("value").cast("long").alias("records"),
        (F.col("value") / F.sum("value").over(Window.partitionBy())).alias("share_total"),
        (F.col("value") / F.sum("value").over(Window.partitionBy("outer_label"))).alias("share_parent"))


def critical_by_gateway(alerts: DataFrame, size: int) -> DataFrame:
    """A6 + K3: OFFLINE-or-CRITICAL alert count per gateway for the first
    ``size`` gateways in alphabetical order, the rest pooled as Other; gateways
    without such alerts show 0."""
    hit = F.col("state").isin(STATE_OFFLINE, STATE_CRITICAL)
    per_gw = (alerts.filter(F.col("gateway_id").isNotNull())
              .groupBy("gateway_id").agg(F.count(F.lit(1)).alias("value"), F.count_if(hit).alias("hits")))
    return alphabetical_hits(per_gw, size)


def alphabetical_hits(per_gw: DataFrame, size: int) -> DataFrame:
    """K3: ``hits`` of the first ``size`` gateways by name, the rest pooled as Other."""
    lab = _label(per_gw, [], "gateway_id", size, "alpha", "gateway")
    return (per_gw.join(lab, "gateway_id").groupBy("gateway")
            .agg(F.sum("hits").cast("long").alias("critical_or_offline")))


def time_slice(df: DataFrame, lo, hi, f0: float = TIME_SLICE_START_FRACTION, f1: float = TIME_SLICE_END_FRACTION,
               anchored: bool = TIME_SLICE_ANCHORED, ts: str = "gateway_ts") -> DataFrame:
    """Rows whose time lies in the slice [start, end) of the range [lo, hi]
    given as fractions of its length; an anchored slice starts at ``lo``."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    span = (hi_c - lo_c).cast("double")
    start = lo_c.cast("double") if anchored else lo_c.cast("double") + F.lit(f0) * span
    end = lo_c.cast("double") + F.lit(f1) * span
    # an integer t lies in [start, end) exactly if it lies in [ceil(start), ceil(end)):
    # the column itself is compared, so constant bounds reach the scan
    t = F.col(ts)
    return df.filter((t >= F.ceil(start).cast("long")) & (t < F.ceil(end).cast("long")))


def with_cells(docs: DataFrame) -> DataFrame:
    """Documents with the cell of each of the map's points (``<point>_cell``)."""
    return docs.withColumns({f"{col}_cell": cell_of(F.col(f"{col}.lat"), F.col(f"{col}.lon"))
                             for _, col, _ in MAP_LAYERS})


def write_map_table(docs: DataFrame, path: str, mode: str = "append") -> None:
    """Documents stored for the map: with cells, in order of the devices' cells, so that
    files and row groups hold neighbourhoods and bounds skip the others. Range
    partitions hold about equal numbers of rows, a crowded place as many as it needs."""
    cell = f"{MAP_LAYERS[0][1]}_cell"
    celled = with_cells(docs)
    (celled.repartitionByRange(F.col(cell).asc_nulls_last(), F.col("device_id"), F.col("gateway_ts"))
     .sortWithinPartitions(cell).write.mode(mode).parquet(path))


def map_points(docs: DataFrame, bbox: dict = MAP_BUFFER, include_hidden: bool = True) -> DataFrame:
    """The map's point layers (device, farm, gateway) restricted to the
    visible bounds; one row per document and layer. Documents without a point in the
    bounds are left out before they become points; of a table with cells
    (:func:`write_map_table`) the bounds reach the scan as ranges of cells."""
    shown = [(layer, col, visible) for layer, col, visible in MAP_LAYERS if visible or include_hidden]

    def within(lat: Column, lon: Column) -> Column:
        return lat.between(bbox["min_lat"], bbox["max_lat"]) & lon.between(bbox["min_lon"], bbox["max_lon"])

    either = lambda parts: reduce(lambda a, b: a | b, parts)
    if all(f"{col}_cell" in docs.columns for _, col, _ in shown):
        ranges = cover(bbox)
        docs = docs.filter(either([in_cover(F.col(f"{col}_cell"), ranges) for _, col, _ in shown]))
    docs = docs.filter(either([within(F.col(f"{col}.lat"), F.col(f"{col}.lon")) for _, col, _ in shown]))
    layers = [F.struct(F.lit(layer).alias("layer"), F.lit(visible).alias("visible"),
                       F.col(f"{col}.lat").alias("lat"), F.col(f"{col}.lon").alias("lon"))
              for layer, col, visible in shown]
    # one scan: each document becomes its points
    out = docs.select("device_id", F.explode(F.array(*layers)).alias("p")).select(
        "p.layer", "p.visible", "device_id", "p.lat", "p.lon")
    return out.filter(within(F.col("lat"), F.col("lon")))
