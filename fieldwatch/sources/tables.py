"""User tables for production runs: dimension, route and document tables read
from Parquet with their explicit schemas (S4, S5, S8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldwatch.operators.dimension import device_gateway_map, device_locations
from fieldwatch.schemas import BRIDGE, PLACE, ROUTE


def read_dimensions(spark: SparkSession, dims_dir: str) -> dict[str, DataFrame]:
    """``<dims_dir>/{farm,gateway,device,farm_gateway_device}`` Parquet tables."""
    d = dims_dir.rstrip("/")
    return {
        "farm": spark.read.schema(PLACE).parquet(f"{d}/farm"),
        "gateway": spark.read.schema(PLACE).parquet(f"{d}/gateway"),
        "device": spark.read.schema(PLACE).parquet(f"{d}/device"),
        "bridge": spark.read.schema(BRIDGE).parquet(f"{d}/farm_gateway_device"),
    }


def load_locations(spark: SparkSession, dims_dir: str) -> DataFrame:
    t = read_dimensions(spark, dims_dir)
    return device_locations(t["bridge"], t["farm"], t["gateway"], t["device"])


def load_device_gateway(spark: SparkSession, dims_dir: str) -> DataFrame:
    return device_gateway_map(read_dimensions(spark, dims_dir)["bridge"])


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROUTE).parquet(path)
