"""Location dimension: J1 (3-way inner join), J2 (one row per device, last wins),
S6 (device index / device -> gateway map), J4 (strict lookup and its rejects).

Broadcast is left to the optimizer: Catalyst broadcasts a side below
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans at run time from the
measured shuffle size, so a dimension that grows past the threshold falls back
to a shuffle join instead of exhausting executor memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.functions.scalars import geo_point

def null_point():
    """A point whose coordinates are NULL (what an unknown device gets)."""
    return F.struct(F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"))


def located_bridge(bridge: DataFrame, farm: DataFrame, gateway: DataFrame, device: DataFrame) -> DataFrame:
    """Bridge rows whose farm, gateway and device all exist (inner joins)."""
    f = farm.select(F.col("id").alias("farm_id"), F.col("latitude").alias("farm_lat"),
                    F.col("longitude").alias("farm_lon"))
    g = gateway.select(F.col("id").alias("gateway_id"), F.col("latitude").alias("gateway_lat"),
                       F.col("longitude").alias("gateway_lon"))
    d = device.select(F.col("id").alias("device_id"), F.col("latitude").alias("device_lat"),
                      F.col("longitude").alias("device_lon"))
    return bridge.join(f, "farm_id").join(g, "gateway_id").join(d, "device_id")


def device_locations(bridge: DataFrame, farm: DataFrame, gateway: DataFrame, device: DataFrame) -> DataFrame:
    """J1 + J2: one location row per device.

    The bridge key is (farm, gateway, device), so a device may occur more than
    once; the reference keeps whichever row its dict saw last. Here the winner
    is deterministic: the greatest (farm_id, gateway_id). ``max`` of a struct is
    a partial aggregate, so a device listed many times is combined map-side.
    """
    j = located_bridge(bridge, farm, gateway, device)
    best = (j.groupBy("device_id")
            .agg(F.max(F.struct("farm_id", "gateway_id", "farm_lat", "farm_lon", "gateway_lat", "gateway_lon",
                                "device_lat", "device_lon")).alias("m"))
            .select("device_id", "m.*"))
    return best.select(
        "device_id", "farm_id", "gateway_id",
        geo_point("farm_lat", "farm_lon").alias("farm_location"),
        geo_point("gateway_lat", "gateway_lon").alias("gateway_location"),
        geo_point("device_lat", "device_lon").alias("device_location"),
    )


def device_gateway_map(bridge: DataFrame) -> DataFrame:
    """S6 'gateway': device -> gateway, one row per device (J2 rule)."""
    return (bridge.groupBy("device_id")
            .agg(F.max(F.struct("farm_id", "gateway_id")).alias("m"))
            .select("device_id", F.col("m.gateway_id").alias("gateway_id")))


def device_index(bridge: DataFrame) -> DataFrame:
    """S6 'device': the set of registered devices."""
    return bridge.select("device_id").distinct()


def index_by(bridge: DataFrame, kind: str) -> DataFrame:
    """The bridge projected as the device list (``'device'``) or the
    device -> gateway map (``'gateway'``); any other kind is an error."""
    if kind == "device":
        return device_index(bridge)
    if kind == "gateway":
        return device_gateway_map(bridge)
    raise ValueError(f"Unknown index kind: {kind}")


def farm_ids(farm: DataFrame) -> DataFrame:
    """S7."""
    return farm.select("id")


def gateway_lookup(readings: DataFrame, dev_gw: DataFrame) -> DataFrame:
    """Readings with their gateway; readings of unregistered devices drop out."""
    return readings.join(dev_gw, "device_id", "inner")


def unknown_devices(readings: DataFrame, dev_gw: DataFrame) -> DataFrame:
    """J4 rejects: readings whose device is not registered (the reference would
    raise here and stop its aggregator)."""
    return readings.join(dev_gw, "device_id", "left_anti")
