"""JSON message parsing and rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldwatch.schemas import ALERT_MSG, TELEMETRY_MSG


def parse_json(df: DataFrame, schema: StructType, value: str = "value", keep: tuple = ()) -> DataFrame:
    """PERMISSIVE ``from_json`` and flatten.

    Non-JSON or empty text gives a row of NULLs (kept); a field of the wrong
    type is NULL while the others survive; extra fields are ignored.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema, {"mode": "PERMISSIVE"})
    keep = [k for k in keep]  # column names carried through unchanged
    return df.select(*keep, parsed.alias("_m")).select(*keep, "_m.*")


def parse_telemetry(df: DataFrame, value: str = "value", keep: tuple = ()) -> DataFrame:
    """P2."""
    return parse_json(df, TELEMETRY_MSG, value, keep)


def parse_alerts(df: DataFrame, value: str = "value", keep: tuple = ()) -> DataFrame:
    """P3."""
    return parse_json(df, ALERT_MSG, value, keep)


def rows_to_json(df: DataFrame, exclude: tuple = ()) -> DataFrame:
    """One JSON text per row; NULL fields are left out."""
    cols = [c for c in df.columns if c not in exclude]
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def json_path(df: DataFrame, column: str, paths: dict) -> DataFrame:
    """P5: ``get_json_object`` for each ``alias -> $.path``; JSON null is SQL NULL."""
    return df.withColumns({a: F.get_json_object(F.col(column), p) for a, p in paths.items()})
