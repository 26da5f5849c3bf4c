"""Helpers shared by the operators: table access, scratch tables, worker caches."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldwatch.session import checkpoint_dir

#: characters that separate words in every contract here: [\x20\x09-\x0D]
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, later
    passes see the same rows even when executors are lost, and joins on the
    result see a plain scan (so adaptive execution can split hot keys)."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or a variation of it that no column of ``df`` carries
    (column names are compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    name = wish
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_columns(df: DataFrame, names: list[str], kind: str) -> T.StructType:
    """The schema of ``df`` with further columns of one type."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(", ".join(f"`{n}` {kind}" for n in names)).fields])


def text_of(col: str):
    """The text column, null counted as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    module = sys.modules.setdefault("_fieldwatch_worker_store", types.ModuleType("_fieldwatch_worker_store"))
    return module.__dict__.setdefault("stores", {}).setdefault(name, {})


def total_bytes(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """(bytes of text, rows): one pass over the text column, two numbers out."""
    row = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long")), F.count(F.lit(1))).first()
    return int(row[0] or 0), int(row[1])
