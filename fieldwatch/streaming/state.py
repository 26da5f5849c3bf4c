"""Cross-batch state for the streaming alert path (ST6).

W1 on a stream, one micro-batch at a time: ``dedup_step`` folds a batch's alerts after
the last kept alert of each device, with the ordered passes of the batch operator, so
a device with a third of a batch is split over many tasks and each task holds
``rowsPerTask`` rows. What it leaves is one row for each device that kept an alert; a
kept alert that can drop nothing any more ends (:func:`expired`).

``dedup_batch`` is the same step for one device's rows in plain pandas; tests hold the
two to each other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.operators.ordered import (ALWAYS, NEG_INF, greedy_thin, keyed_lag, ordered_layout, tasks_for,
                                         thin_mask)
from fieldwatch.session import checkpointed


def dedup_batch(pdf: pd.DataFrame, kept_state, kept_ts, window: int) -> tuple[pd.DataFrame, object, object]:
    """Apply W1 to one device's rows of a micro-batch, starting from the
    carried state. Rows older than the kept alert (late arrivals) are decided
    with the reference's ``abs`` rule one at a time; once one of them is kept
    the rest of the batch is in order and is thinned in one vectorised pass."""
    pdf = pdf.sort_values(["gateway_ts", "seq"], kind="stable", na_position="first", ignore_index=True)
    ts = pdf["gateway_ts"].to_numpy(np.int64)
    states = pdf["state"].to_numpy(object)
    keep = np.zeros(len(pdf), dtype=bool)
    i = 0
    while i < len(pdf) and kept_ts is not None and ts[i] < kept_ts:
        if states[i] == kept_state and abs(int(ts[i]) - int(kept_ts)) < window:
            i += 1
            continue
        keep[i] = True
        kept_state, kept_ts = states[i], int(ts[i])
        i += 1
    if i < len(pdf):
        rest = pd.Series(states[i:])
        prev = rest.shift(1)
        prev.iloc[0] = kept_state
        theta = np.where(prev.isna() | (prev != rest), ALWAYS, window).astype(np.int64)
        e0 = NEG_INF if kept_ts is None else int(kept_ts)
        m = thin_mask(ts[i:], theta, e0)
        keep[i:] = m
        last = np.nonzero(m)[0]
        if len(last):
            kept_state, kept_ts = states[i + last[-1]], int(ts[i + last[-1]])
    return pdf[keep], kept_state, kept_ts


STATE_SCHEMA = "device_id string, kept_state string, kept_ts long"
_TURN, _MARK, _THETA, _PREV = "_turn", "_mark", "_theta", "_prev_mark"
_SEPARATOR = "\x1f"


def dedup_step(alerts: DataFrame, window: int, state: DataFrame, seq: str = "seq",
               num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """ST6: the alerts of a micro-batch that W1 keeps after ``state`` (device_id,
    kept_state, kept_ts), and the state of the devices that kept some.

    Rows are taken by (gateway_ts, seq). A row older than the carried alert (a late one)
    is dropped if it has the same state and lies less than ``window`` away from it on
    either side. Only a batch's first row can lie ``window`` or more before the
    carried alert without a change of state; once it is kept, the rest is in order."""
    spark = alerts.sparkSession
    order = [_TURN, "gateway_ts", seq]
    columns = alerts.columns
    touched = state.join(alerts.select("device_id").distinct(), "device_id", "left_semi")
    own = {"device_id": F.col("device_id"), "state": F.col("kept_state"), "gateway_ts": F.col("kept_ts")}
    seeds = touched.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in alerts.schema.fields])
    mark = lambda ts: F.concat(F.col("state"), F.lit(_SEPARATOR), ts)
    rows = (alerts.withColumn(_TURN, F.lit(1)).withColumn(_MARK, mark(F.lit("")))
            .unionByName(seeds.withColumn(_TURN, F.lit(0)).withColumn(_MARK, mark(F.col("gateway_ts").cast("string")))))
    laid = ordered_layout(rows, "device_id", order, tasks_for(spark, alerts.count(), num_partitions))
    lagged = keyed_lag(laid, "device_id", order, _MARK, _PREV)
    before = F.substring_index(F.col(_PREV), _SEPARATOR, 1)
    carried = F.substring_index(F.col(_PREV), _SEPARATOR, -1).try_cast("long")  # null behind a row of the batch
    always = F.col(_PREV).isNull() | (before != F.col("state")) | (carried - F.col("gateway_ts") >= window)
    theta = F.when(F.coalesce(always, F.lit(False)) | (F.col(_TURN) == 0), F.lit(ALWAYS)).otherwise(F.lit(window))
    out = greedy_thin(lagged.withColumn(_THETA, theta.cast("long")), "device_id", order, "gateway_ts", _THETA,
                      e_init=NEG_INF, layout=laid)
    kept = checkpointed(out.where(F.col(_TURN) == 1).select(*columns))
    # a late row that was kept is followed by the rest of the batch, so the last in order is the last kept
    last = kept.groupBy("device_id").agg(F.max(F.struct("gateway_ts", seq, "state")).alias("m"))
    return kept, last.select("device_id", F.col("m.state").alias("kept_state"), F.col("m.gateway_ts").alias("kept_ts"))


def expired(seen_max: int | None, window: int, lateness: int):
    """Is a kept alert of no more use? Rows at most ``lateness`` older than the newest one
    seen lie ``window`` or more behind it, so it neither drops them nor tells them apart
    from a device's first."""
    return F.lit(False) if seen_max is None else F.col("kept_ts") + F.lit(window) <= F.lit(seen_max - lateness)
