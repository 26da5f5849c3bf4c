"""Alert path: the gateway's alert machine (W2), the offline detector (W3), the
cleaning job's dedup (W1), state transitions (W4) and the cleaning steps
P10-P13.

Time base: a reading's ``gateway_ts`` is the end of its gateway window, so all
readings of a window share one "now" as in the reference's drain loop. Within a
device the order is (gateway_ts, arrival sequence).

Each fold is a candidate table built with ordinary DataFrame operations,
followed by one exact ordered thinning pass from
:mod:`fieldwatch.operators.ordered`, which splits busy devices over many tasks
at every size.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.config import STATE_CRITICAL, STATE_OFFLINE, Params
from fieldwatch.functions.scalars import details_from_array, first_truthy, point_or_flat, to_int_of, to_str
from fieldwatch.functions.timefmt import iso_of_ms, window_index
from fieldwatch.operators.dimension import gateway_lookup
from fieldwatch.operators.ordered import (ALWAYS, NEG_INF, PID, POS, greedy_thin, keyed_lag, ordered_layout,
                                         placed, tasks_for)
from fieldwatch.operators.ranks import count_below, rank_rows
from fieldwatch.schemas import CLEANED_ALERT
from fieldwatch.session import checkpointed, written

ALERT_COLUMNS = ["device_id", "gateway_id", "gateway_ts", "gateway_ts_iso", "state", "details"]
SEQ = "seq"
GAP = "_gap"
TICK_SEQ = 2 ** 63 - 1  # ticks order after every reading
STAMPS = "_stamps"
STAMPS_A_ROW = 64  # ticks of a silence that lie in a layout as one row


# --- W3: offline candidates ------------------------------------------------------------

def offline_alerts(known: DataFrame, dev_gw: DataFrame, params: Params, last_seen: DataFrame | None = None
                   ) -> DataFrame:
    """W3 in the alert columns, see :func:`_silences`."""
    return _ticks(*_silences(known, dev_gw, params, last_seen))


def _silences(known: DataFrame, dev_gw: DataFrame, params: Params, last_seen: DataFrame | None = None
              ) -> tuple[DataFrame, DataFrame]:
    """One OFFLINE alert per (registered device, non-empty fleet window) in
    which the device sent nothing and its last reading is at least
    ``offline_ms`` older than the window's end (never-seen devices: last = 0,
    or the carried ``last_seen(device_id, last_ts)`` of earlier micro-batches).

    The reference does not rate-limit OFFLINE alerts, so every candidate is an
    alert and no fold is needed here. The windows in which the fleet spoke are
    numbered densely, and a silence of a device (between two windows it was seen in)
    is a range of those numbers, cut where it first fires. Ranges are spread out
    into numbers (:func:`_ticks`), each of which is an alert: time in which nobody spoke
    has no number and costs nothing, however long it is.

    Returns the silences ``(device_id, gateway_id, low, high, _gap)`` that fire, with
    ``_gap`` the number of the window that ends them (null if none does), and the
    windows ``(rank, gateway_ts, gateway_ts_iso)``.
    """
    w_ms, off = params.window_ms, params.offline_ms
    window = window_index(F.col("gateway_ts") - 1, w_ms)

    def first_firing(last_ts):
        # window m fires when (m + 1) * W - last_ts >= offline
        return (F.ceil((last_ts + F.lit(off)) / F.lit(w_ms)) - 1).cast("long")

    # a silence after window w begins behind it, whatever the limit
    fleet = known.select(window.alias("w")).distinct()
    after = F.greatest(first_firing((F.col("w") + 1) * F.lit(w_ms)), F.col("w") + 1)
    registered = dev_gw.select("device_id")
    if last_seen is not None:
        registered = registered.join(last_seen.select("device_id", "last_ts"), "device_id", "left")
    else:
        registered = registered.withColumn("last_ts", F.lit(None).cast("long"))
    registered = registered.select("device_id", first_firing(F.coalesce(F.col("last_ts"), F.lit(0))).alias("value"))
    # written: five joins read it, as a scan whose size is known
    ranks = written(count_below(fleet, fleet.select(after.alias("value")).unionByName(registered.select("value"))),
                    "window-ranks")
    spoken = ranks.where("counted").select(F.col("value").alias("w"), F.col("below").alias("rank"))
    last = spoken.select(F.max("rank")).scalar()
    begins = ranks.select("value", F.col("below").alias("low"))

    # the per-device window list is bounded by the number of fleet windows, not by
    # the device's reading count
    per_dev = Window.partitionBy("device_id").orderBy("rank")
    seen = (known.select("device_id", window.alias("w")).distinct().join(spoken, "w")
            .select("device_id", "rank", after.alias("value"), F.lead("rank").over(per_dev).alias(GAP)))
    gaps = (seen.where(F.col(GAP).isNull() | (F.col(GAP) > F.col("rank") + 1)).join(begins, "value")
            .select("device_id", "low", GAP))
    firsts = seen.groupBy("device_id").agg(F.min("rank").alias(GAP))
    before = registered.join(begins, "value").join(firsts, "device_id", "left").select("device_id", "low", GAP)
    spans = (gaps.unionByName(before).withColumn("high", F.coalesce(F.col(GAP) - 1, last))
             .where(F.col("low") <= F.col("high")))
    gts = ((F.col("w") + 1) * F.lit(w_ms)).cast("long")
    return (spans.join(dev_gw, "device_id").select("device_id", "gateway_id", "low", "high", GAP),
            spoken.select("rank", gts.alias("gateway_ts"), iso_of_ms(gts).alias("gateway_ts_iso")))


def _ticks(silences: DataFrame, windows: DataFrame) -> DataFrame:
    """The alerts of :func:`_silences`, one for each window of a silence."""
    starts, members = rank_rows(F.col("low"), F.col("high"))
    numbers = silences.withColumn("block", starts).select("device_id", "gateway_id", members.alias("rank"))
    return numbers.join(windows, "rank").select(
        "device_id", "gateway_id", "gateway_ts", "gateway_ts_iso", F.lit(STATE_OFFLINE).alias("state"),
        F.array().cast("array<string>").alias("details"), F.lit(None).cast("long").alias(SEQ))


def unseen_devices(known: DataFrame, dev_gw: DataFrame, window_ms: int) -> DataFrame:
    """(registered device, window index) for every non-empty fleet
    window in which the device sent nothing: the device set minus the seen
    set, per window, generated from silence gaps rather than a devices x
    windows product."""
    every = Params(window_ms=window_ms, offline_ms=window_ms)
    ticks = offline_alerts(known, dev_gw, every)
    return ticks.select("device_id", window_index(F.col("gateway_ts") - 1, window_ms).alias("w"))


# --- W2 + W3: the gateway's alert machine -------------------------------------------------

FLEET_STATE = "device_id string, last_state string, last_alert_ts long, last_ts long"
_FLEET_COLS = ["device_id", "gateway_id", "gateway_ts", "state", "details", SEQ]


def fleet_alerts(readings: DataFrame, dev_gw: DataFrame, params: Params, seq: str = "event_id",
                 num_partitions: int | None = None) -> DataFrame:
    """W2 U W3 (U3): alerts the gateway publishes.

    ``readings`` must carry device_id, gateway_ts, state, details and an
    arrival sequence column. Readings of unregistered devices are rejected
    (J4). Rules per device, in order, with E = time of its last alert
    (initially 0):

    * CRITICAL reading: alert if now - E >= cooldown;
    * OK reading right after a CRITICAL reading: alert if now - E >= recovery;
    * OFFLINE (W3 candidate): always alerts.

    Both folds run on range-partitioned layouts, so a busy device is split over
    many tasks.
    """
    return stamped(fleet_layout(readings, dev_gw, params, seq, num_partitions))


def fleet_layout(readings: DataFrame, dev_gw: DataFrame, params: Params, seq: str = "event_id",
                 num_partitions: int | None = None) -> DataFrame:
    """The alerts of :func:`fleet_alerts`, not yet :func:`stamped`, as a layout by device
    and (gateway_ts, seq) that the dedup goes on with. It is stored with a silence's ticks
    in rows of up to ``STAMPS_A_ROW`` stamps, which become alerts whenever it is read."""
    known = _known(readings, dev_gw, seq)
    # read by the offline candidates, the count and the fold: keep the narrow
    # projection for the duration of this (eager) function only; lost blocks are
    # recomputed from the lineage
    known = known.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # reliable checkpoint: later stages (dedup, notifications) read the fold
        # once, and a lost executor does not send them back through it
        folded = checkpointed(_fleet_folded(known, dev_gw, params, num_partitions))
    finally:
        known.unpersist()
    each = folded.withColumn("gateway_ts", F.explode(F.coalesce(F.col(STAMPS), F.array("gateway_ts"))))
    return placed(each.select(*_FLEET_COLS))


def stamped(alerts: DataFrame) -> DataFrame:
    """Rows of :func:`fleet_layout` in the alert columns."""
    return alerts.withColumn("gateway_ts_iso", iso_of_ms(F.col("gateway_ts"))).select(*ALERT_COLUMNS, SEQ)


def _known(readings: DataFrame, dev_gw: DataFrame, seq: str) -> DataFrame:
    return gateway_lookup(readings, dev_gw).select(
        "device_id", "gateway_id", "gateway_ts", "state", "details", F.col(seq).cast("long").alias(SEQ))


def _seed_rows(state: DataFrame, stamp: str, like: DataFrame) -> DataFrame:
    """One row per device in the columns of ``like`` that stands for what earlier
    micro-batches left: ``last_state`` at ``stamp``, before all its readings."""
    values = {"device_id": F.col("device_id"), "state": F.col("last_state"), "gateway_ts": F.col(stamp),
              SEQ: F.lit(NEG_INF)}
    return state.filter(F.col(stamp).isNotNull()).select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def _fleet(known: DataFrame, dev_gw: DataFrame, params: Params, num_partitions: int | None = None,
           state: DataFrame | None = None) -> DataFrame:
    """The fold over readings and OFFLINE ticks. ``state(device_id, last_state,
    last_alert_ts, last_ts)`` carries what earlier micro-batches left.

    Every tick is an alert, so ticks go straight to the output. To the readings that
    follow a silence only its last tick matters (it is the device's last alert), so
    the fold itself holds one tick for each silence that ends, never more rows than
    readings. It is taken from the silence's end, and silences are spread out over all
    tasks and into ticks once, for the output."""
    silences, windows = _silences(known, dev_gw, params, state)
    silences = written(silences, "silences")
    n = tasks_for(known.sparkSession, known.count(), num_partitions)
    cand = _candidates(known, params, n, state)
    always = F.lit(ALWAYS).cast("long").alias("theta")
    last_ticks = (silences.filter(F.col(GAP).isNotNull()).select("device_id", F.col("high").alias("rank"))
                  .join(windows.select("rank", "gateway_ts"), "rank").withColumn(SEQ, F.lit(TICK_SEQ)))
    cand = cand.unionByName(last_ticks.select(
        *[(F.col(c) if c in last_ticks.columns else F.lit(None)).cast(cand.schema[c].dataType).alias(c)
          for c in _FLEET_COLS], always))
    if state is not None:
        cand = cand.unionByName(_seed_rows(state, "last_alert_ts", cand.drop("theta")).select(*_FLEET_COLS, always))
    out = _folded(cand, n)
    spoke = (out.filter((F.col(SEQ) > NEG_INF) & (F.col(SEQ) < TICK_SEQ))
             .select(*ALERT_COLUMNS[:3], iso_of_ms(F.col("gateway_ts")).alias("gateway_ts_iso"), "state", "details", SEQ))
    return spoke.unionByName(_ticks(silences.repartition(n, "device_id", "low"), windows))


def _fleet_folded(known: DataFrame, dev_gw: DataFrame, params: Params, num_partitions: int | None = None) -> DataFrame:
    """The fold of :func:`_fleet` over all that was ever read, with its output left in the
    fold's layout. All ticks go through it, a row for up to ``STAMPS_A_ROW`` of a silence,
    in the place of its last: a device speaks before or after a silence, never inside, so
    what a row is spread out into lies in order too."""
    silences, windows = _silences(known, dev_gw, params)
    silences = written(silences, "silences")
    spark, readings = known.sparkSession, known.count()
    ticks = silences.select(F.sum(F.col("high") - F.col("low") + 1)).first()[0] or 0
    n = tasks_for(spark, readings + ticks, num_partitions)
    cand = _candidates(known, params, tasks_for(spark, readings, num_partitions))
    blocks = _tick_blocks(silences.repartition(n, "device_id", "low"), windows).select(
        "device_id", "gateway_id", F.element_at(STAMPS, -1).alias("gateway_ts"), F.lit(STATE_OFFLINE).alias("state"),
        F.array().cast("array<string>").alias("details"), F.lit(None).cast("long").alias(SEQ),
        F.lit(ALWAYS).cast("long").alias("theta"), STAMPS)
    out = _folded(cand.unionByName(blocks, allowMissingColumns=True), n)
    return out.select(*_FLEET_COLS, STAMPS)


def _tick_blocks(silences: DataFrame, windows: DataFrame) -> DataFrame:
    """The ticks of :func:`_silences` as rows (device_id, gateway_id, stamps in order)."""
    size = F.lit(STAMPS_A_ROW).cast("long")
    number = lambda rank: F.floor(F.col(rank) / size).cast("long")
    stamps = windows.groupBy(number("rank").alias("number")).agg(F.sort_array(F.collect_list("gateway_ts")).alias("all"))
    starts, members = rank_rows(number("low"), number("high"))
    cut = (silences.withColumn("block", starts).select("device_id", "gateway_id", "low", "high", members.alias("number"))
           .join(stamps, "number"))
    first, least = F.col("number") * size, F.greatest(F.col("low"), F.col("number") * size)
    most = F.least(F.col("high"), first + size - 1)
    return cut.select("device_id", "gateway_id", F.slice("all", (least - first + 1).cast("int"),
                                                         (most - least + 1).cast("int")).alias(STAMPS))


def _candidates(known: DataFrame, params: Params, n: int, state: DataFrame | None = None) -> DataFrame:
    """Readings that alert if their device's last alert is ``theta`` ago or more."""
    order = ["gateway_ts", SEQ]
    rows = known if state is None else known.unionByName(_seed_rows(state, "last_ts", known))
    with_prev = keyed_lag(ordered_layout(rows, "device_id", order, n), "device_id", order, "state", "prev_state")
    theta = (F.when(F.col("state") == STATE_CRITICAL, F.lit(params.cooldown_ms))
             .when(F.col("prev_state") == STATE_CRITICAL, F.lit(params.recovery_ms)))
    return (with_prev.filter(F.col(SEQ) > NEG_INF).withColumn("theta", theta.cast("long"))
            .filter(F.col("theta").isNotNull()).select(*_FLEET_COLS, "theta"))


def _folded(cand: DataFrame, n: int) -> DataFrame:
    """The candidates that alert, in a layout of ``n`` partitions."""
    order = ["gateway_ts", SEQ]
    # a layout reads its rows twice (range bounds, exchange): the lag pass below runs once
    laid = ordered_layout(checkpointed(cand), "device_id", order, n)
    return greedy_thin(laid, "device_id", order, "gateway_ts", "theta", e_init=0)


def fleet_step(readings: DataFrame, dev_gw: DataFrame, params: Params, state: DataFrame | None,
               seq: str = "event_id", num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """ST7: one micro-batch of the gateway's alert machine. ``state`` is the
    per-device table ``(device_id, last_state, last_alert_ts, last_ts)`` after
    the previous batch (None before the first). Returns the batch's alerts and
    the new rows of that table for the devices that spoke or alerted."""
    known = _known(readings, dev_gw, seq).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        alerts = checkpointed(_fleet(known, dev_gw, params, num_partitions, state))
        last_read = checkpointed(known.groupBy("device_id").agg(
            F.max(F.struct("gateway_ts", SEQ, "state")).alias("m")))
    finally:
        known.unpersist()
    last_read = last_read.select("device_id", F.col("m.state").alias("n_state"), F.col("m.gateway_ts").alias("n_ts"))
    last_alert = alerts.groupBy("device_id").agg(F.max("gateway_ts").alias("n_alert"))
    new = last_read.join(last_alert, "device_id", "full_outer")
    if state is None:
        state = new.sparkSession.createDataFrame([], FLEET_STATE)
    changed = (new.join(state, "device_id", "left")
               .select("device_id", F.coalesce("n_state", "last_state").alias("last_state"),
                       F.coalesce("n_alert", "last_alert_ts").alias("last_alert_ts"),
                       F.coalesce("n_ts", "last_ts").alias("last_ts")))
    return alerts, changed


def device_alerts(readings: DataFrame, dev_gw: DataFrame, params: Params, seq: str = "event_id",
                  num_partitions: int | None = None) -> DataFrame:
    """The state-machine alerts (CRITICAL / recovery OK) of the fleet output."""
    return fleet_alerts(readings, dev_gw, params, seq, num_partitions).filter(F.col("state") != STATE_OFFLINE)


# --- W1: dedup of the alert stream ------------------------------------------------------------

def dedup_alerts(alerts: DataFrame, window: int, order: tuple = ("gateway_ts", SEQ),
                 num_partitions: int | None = None, laid: bool = False) -> DataFrame:
    """W1, last-kept fold per device: drop an alert iff the last *kept* alert
    has the same state and lies less than ``window`` before it.

    The last kept alert always has the state of the immediately preceding
    alert (a dropped alert has the kept state), so: a state change always keeps,
    and within a run of equal states the kept rows are a greedy thinning with
    gap ``window``. ``laid``: the alerts are a layout by device and ``order`` already
    (:func:`fleet_layout`), rows of which may be left out.
    """
    order = list(order)
    if not laid:
        alerts = ordered_layout(alerts, "device_id", order,
                                tasks_for(alerts.sparkSession, alerts.count(), num_partitions))
    out = greedy_thin(alerts.withColumn("_theta", F.lit(window).cast("long")), "device_id", order, "gateway_ts", "_theta",
                      e_init=NEG_INF, change="state")
    return checkpointed(out.drop("_theta", PID, POS))


# --- W4: state transitions -----------------------------------------------------------------

def state_transitions(readings: DataFrame, seq: str = "event_id", num_partitions: int | None = None) -> DataFrame:
    """Readings whose state differs from the device's previous reading
    (the first reading of a device counts as a transition from '')."""
    order = ["gateway_ts", seq]
    r = readings.select("device_id", "gateway_ts", seq, "state")
    n = tasks_for(r.sparkSession, r.count(), num_partitions)
    lagged = keyed_lag(ordered_layout(r, "device_id", order, n), "device_id", order, "state", "prev_state")
    return (lagged.withColumn("prev_state", F.coalesce(F.col("prev_state"), F.lit("")))
            .filter(F.col("prev_state") != F.col("state"))
            .select("device_id", "gateway_ts", seq, "prev_state", "state"))


# --- P10-P13: cleaning -------------------------------------------------------------------------

def valid_alerts(df: DataFrame) -> DataFrame:
    """P10: drop alerts without device_id, state or an integer gateway_ts."""
    return df.filter(F.col("device_id").isNotNull() & F.col("state").isNotNull()
                     & to_int_of(df, "gateway_ts").isNotNull())


def conform_cleaned(df: DataFrame) -> DataFrame:
    """P11-P13 + the cleaned-alert contract: tolerant coercions, farm id
    fallback (``farm_id`` or ``farmId``), struct-or-flat coordinates,
    normalised details."""
    cols = df.columns

    def opt(c):
        return F.col(c) if c in cols else F.lit(None)

    def opt_int(c):
        return to_int_of(df, c) if c in cols else F.lit(None).cast("long")

    out = df.select(
        to_str(opt("device_id")).alias("device_id"),
        to_str(opt("gateway_id")).alias("gateway_id"),
        opt_int("gateway_ts").alias("gateway_ts"),
        to_str(opt("gateway_ts_iso")).alias("gateway_ts_iso"),
        to_str(opt("state")).alias("state"),
        details_from_array(opt("details")).alias("details"),
        opt_int("ts_before_es").alias("ts_before_es"),
        opt_int("ts_kafka_ingest").alias("ts_kafka_ingest"),
        first_truthy(opt("farm_id"), opt("farmId")).alias("farm_id"),
        point_or_flat(df, "farm_location", "farm_lat", "farm_lon").alias("farm_location"),
        point_or_flat(df, "gateway_location", "gateway_lat", "gateway_lon").alias("gateway_location"),
        point_or_flat(df, "device_location", "device_lat", "device_lon").alias("device_location"),
        *[F.col(c) for c in cols if c == SEQ],
    )
    return out.select(*[f.name for f in CLEANED_ALERT.fields], *[c for c in out.columns if c == SEQ])
