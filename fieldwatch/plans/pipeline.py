"""The data flow over the driver's tables, table by table.

``Pipeline(spark, sf_dir)`` exposes every intermediate table as a DataFrame;
properties are built on first use and shared. Most are lazy plans; the ordered
folds and the written dimensions run jobs when they are built.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from fieldwatch.config import FIXTURE_PARAMS, Params
from fieldwatch.functions import jsonio
from fieldwatch.operators import alerts as A
from fieldwatch.operators import dimension as D
from fieldwatch.operators import evaluation as E
from fieldwatch.operators import telemetry as T
from fieldwatch.session import written
from fieldwatch.sources import fixtures as FX


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS,
                 num_partitions: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.params = params
        self.num_partitions = num_partitions

    # --- dimensions -------------------------------------------------------------------
    @cached_property
    def farm(self) -> DataFrame:
        return FX.farms(self.spark, self.sf_dir)

    @cached_property
    def gateway(self) -> DataFrame:
        return FX.gateways(self.spark, self.sf_dir)

    @cached_property
    def device(self) -> DataFrame:
        return FX.devices(self.spark, self.sf_dir)

    @cached_property
    def bridge(self) -> DataFrame:
        return FX.bridge(self.spark, self.sf_dir)

    @cached_property
    def routes(self) -> DataFrame:
        return FX.routes(self.spark, self.sf_dir)

    @cached_property
    def locations(self) -> DataFrame:
        return D.device_locations(self.bridge, self.farm, self.gateway, self.device)

    @cached_property
    def dev_gw(self) -> DataFrame:
        return D.device_gateway_map(self.bridge)

    # what readings and alerts are joined with: written once, see ``written``
    @cached_property
    def location_table(self) -> DataFrame:
        return written(self.locations, "locations")

    @cached_property
    def gateway_table(self) -> DataFrame:
        return written(self.dev_gw, "device-gateways")

    # --- telemetry path -----------------------------------------------------------------
    @cached_property
    def raw_readings(self) -> DataFrame:
        return FX.readings(self.spark, self.sf_dir)

    @cached_property
    def readings(self) -> DataFrame:
        """Clamped, stamped and classified readings (all devices)."""
        return FX.gateway_readings(self.spark, self.sf_dir, self.params)

    @cached_property
    def telemetry(self) -> DataFrame:
        """A1: aggregated telemetry messages."""
        return T.device_window_stats(self.readings, self.params.window_ms, self.gateway_table)

    @cached_property
    def enriched_telemetry(self) -> DataFrame:
        return T.enrich(self.telemetry, self.location_table)

    # --- alert path ------------------------------------------------------------------------
    @cached_property
    def fleet_layout(self) -> DataFrame:
        return A.fleet_layout(self.readings, self.gateway_table, self.params, "event_id", self.num_partitions)

    @cached_property
    def fleet_alerts(self) -> DataFrame:
        return A.stamped(self.fleet_layout)

    @cached_property
    def raw_alert_lines(self) -> DataFrame:
        return FX.raw_alert_lines(self.spark, self.sf_dir, self.params, self.gateway_table)

    @cached_property
    def parsed_alerts(self) -> DataFrame:
        return jsonio.parse_alerts(self.raw_alert_lines.withColumnRenamed("event_id", "seq"), keep=("seq",))

    @cached_property
    def deduped_alerts(self) -> DataFrame:
        """W1 over the alert topic (the fleet alerts), in the layout they come in."""
        return A.stamped(A.dedup_alerts(A.valid_alerts(self.fleet_layout), self.params.dedup_window, laid=True))

    @cached_property
    def cleaned_alerts(self) -> DataFrame:
        """The cleaning job's output: dedup -> enrich -> coercions (stamps omitted)."""
        return A.conform_cleaned(T.enrich(self.deduped_alerts, self.location_table))

    # --- evaluation ------------------------------------------------------------------------
    @cached_property
    def latency_source(self) -> DataFrame:
        return FX.latency_source(self.spark, self.sf_dir)

    @cached_property
    def latency_legs(self) -> DataFrame:
        return E.latency_legs(E.latency_rows(self.latency_source))

    @cached_property
    def counter_samples(self) -> DataFrame:
        return FX.counter_samples(self.spark, self.sf_dir)
