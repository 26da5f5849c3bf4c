"""Explicit schemas of every message, document and dimension (nothing is inferred)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

from fieldwatch.config import METRICS

GEO = StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())])

# FIXED VALUES: field names, types and order of the messages, documents and
# dimensions below are the contract with their producers and readers.

READING = StructType([
    StructField("device_id", StringType()),
    StructField("device_ts", LongType()),
    StructField("device_ts_iso", StringType()),
    StructField("temperature", DoubleType()),
    StructField("humidity", DoubleType()),
    StructField("soil_moisture", DoubleType()),
    StructField("light_level", DoubleType()),
    StructField("device_status", StringType()),
])

RAW_RECORD = StructType(READING.fields + [
    StructField("gateway_id", StringType()),
    StructField("gateway_ts", LongType()),
    StructField("gateway_ts_iso", StringType()),
])

STAT_SUFFIXES = ("avg", "min", "max", "std")
STAT_COLUMNS = [f"{m}_{s}" for m in METRICS for s in STAT_SUFFIXES]

TELEMETRY_MSG = StructType(
    [StructField("device_id", StringType()),
     StructField("gateway_id", StringType()),
     StructField("gateway_ts", LongType()),
     StructField("gateway_ts_iso", StringType()),
     StructField("count", LongType())]
    + [StructField(c, DoubleType()) for c in STAT_COLUMNS]
)

ALERT_MSG = StructType([
    StructField("device_id", StringType()),
    StructField("gateway_id", StringType()),
    StructField("gateway_ts", LongType()),
    StructField("gateway_ts_iso", StringType()),
    StructField("state", StringType()),
    StructField("details", ArrayType(StringType())),
])

LOCATION_COLUMNS = ("farm_location", "gateway_location", "device_location")

CLEANED_ALERT = StructType([
    StructField("device_id", StringType()),
    StructField("gateway_id", StringType()),
    StructField("gateway_ts", LongType()),
    StructField("gateway_ts_iso", StringType()),
    StructField("state", StringType()),
    StructField("details", ArrayType(StringType())),
    StructField("ts_before_es", LongType()),
    StructField("ts_kafka_ingest", LongType()),
    StructField("farm_id", StringType()),  # kept as a string id; see README
    StructField("farm_location", GEO),
    StructField("gateway_location", GEO),
    StructField("device_location", GEO),
])

# Document contracts of the two indices: target type per field.
TELEMETRY_DOC = StructType(
    [StructField("created_at", TimestampType()),
     StructField("device_id", StringType()),
     StructField("gateway_id", StringType()),
     StructField("farm_id", StringType()),
     StructField("gateway_ts", LongType()),
     StructField("gateway_ts_iso", StringType()),
     StructField("count", IntegerType())]
    + [StructField(c, FloatType()) for c in STAT_COLUMNS]
    + [StructField(c, GEO) for c in ("device_location", "gateway_location", "farm_location")]
    + [StructField("ts_kafka_ingest", LongType()),
       StructField("ts_before_es", LongType())]
)

ALERT_DOC = StructType([
    StructField("created_at", TimestampType()),
    StructField("device_id", StringType()),
    StructField("gateway_id", StringType()),
    StructField("farm_id", StringType()),
    StructField("gateway_ts", LongType()),
    StructField("gateway_ts_iso", StringType()),
    StructField("state", StringType()),
    StructField("details", ArrayType(StringType())),
    StructField("device_location", GEO),
    StructField("gateway_location", GEO),
    StructField("farm_location", GEO),
    StructField("ts_kafka_ingest", LongType()),
    StructField("ts_before_es", LongType()),
])

PLACE = StructType([
    StructField("id", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
])

BRIDGE = StructType([
    StructField("farm_id", StringType()),
    StructField("gateway_id", StringType()),
    StructField("device_id", StringType()),
])

ROUTE = StructType([StructField("farm_id", StringType()), StructField("email", StringType())])
