"""Scalar column functions: clamp, classification, tolerant coercions, fallbacks.

Everything here is a built-in Catalyst expression, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldwatch.config import CLAMP_BOUNDS, CRITICAL_THRESHOLDS, METRICS, STATE_CRITICAL, STATE_OK


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- P14 clamp -------------------------------------------------------------

def clamp_col(c, lo: float, hi: float) -> Column:
    c = _c(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(float(lo)), F.least(c, F.lit(float(hi)))))


def clamp(df: DataFrame, bounds: dict | None = None) -> DataFrame:
    """Clamp every metric of ``bounds`` into its closed range (NULL stays NULL)."""
    bounds = CLAMP_BOUNDS if bounds is None else bounds
    return df.withColumns({m: clamp_col(m, lo, hi) for m, (lo, hi) in bounds.items() if m in df.columns})


# --- P15 / P16 classification --------------------------------------------

def violation_cond(metric: str, thresholds: dict) -> Column:
    lo, hi = thresholds[metric]
    c = F.col(metric)
    return F.coalesce((c < F.lit(float(lo))) | (c > F.lit(float(hi))), F.lit(False))


def violations_col(thresholds: dict | None = None) -> Column:
    """Ordered list of metric names outside their critical range."""
    thresholds = CRITICAL_THRESHOLDS if thresholds is None else thresholds
    ms = [m for m in METRICS if m in thresholds]
    if not ms:
        return F.array().cast("array<string>")
    return F.filter(F.array(*[F.when(violation_cond(m, thresholds), F.lit(m)) for m in ms]),
                    lambda x: x.isNotNull())


def state_col(thresholds: dict | None = None) -> Column:
    thresholds = CRITICAL_THRESHOLDS if thresholds is None else thresholds
    ms = [m for m in METRICS if m in thresholds]
    cond = F.lit(False)
    for m in ms:
        cond = cond | violation_cond(m, thresholds)
    return F.when(cond, F.lit(STATE_CRITICAL)).otherwise(F.lit(STATE_OK))


def classify(df: DataFrame, thresholds: dict | None = None) -> DataFrame:
    return df.withColumn("state", state_col(thresholds))


def violations(df: DataFrame, thresholds: dict | None = None) -> DataFrame:
    return df.withColumn("details", violations_col(thresholds))


# --- P11 tolerant coercions ------------------------------------------------

def _clean_text(c: Column) -> Column:
    """String form for numeric parsing: NULL, '' and 'null' (any case) -> NULL.

    Digit-group underscores (``1_000``) are accepted as in Python's float();
    a trailing type suffix (``1d``, ``2f``), which Spark would accept and
    Python would not, is rejected.
    """
    s = c.cast("string")
    s = F.when(s.isNull() | (s == "") | (F.lower(s) == "null"), F.lit(None)).otherwise(s)
    s = F.when(s.rlike(r"(?i)[df]\s*$") & ~s.rlike(r"(?i)^\s*[+-]?(inf|infinity)\s*$"), F.lit(None)).otherwise(s)
    return F.regexp_replace(s, r"(?<=[0-9])_(?=[0-9])", "")


def to_float(c) -> Column:
    return (_clean_text(_c(c))).try_cast("double")


def to_int(c) -> Column:
    """Integer through float, truncated toward zero; NaN/inf/unparsable -> NULL."""
    d = to_float(c)
    ok = d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(9.2e18))
    return F.when(ok, (d).try_cast("long"))


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")
_FRACTIONAL = ("float", "double")


def _dtype(df: DataFrame, name: str) -> str | None:
    return dict(df.dtypes).get(name)


def to_int_of(df: DataFrame, name: str) -> Column:
    """``to_int`` that keeps integer columns exact (Python's ``int(v)`` for
    ints) and truncates floating columns directly; text goes through
    :func:`to_int`."""
    t = _dtype(df, name)
    c = F.col(name)
    if t in _INTEGRAL:
        return c.cast("long")
    if t in _FRACTIONAL:
        return F.when(~F.isnan(c) & (F.abs(c) < F.lit(9.2e18)), c.cast("long"))
    return to_int(c)


def to_float_of(df: DataFrame, name: str) -> Column:
    t = _dtype(df, name)
    c = F.col(name)
    if t in _INTEGRAL or t in _FRACTIONAL:
        return c.cast("double")
    return to_float(c)


def to_str(c) -> Column:
    return _c(c).cast("string")


# --- P12 details normalisation -----------------------------------------------

def details_from_array(c) -> Column:
    """NULL -> []; NULL elements become the text 'None'."""
    c = _c(c)
    return F.coalesce(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("None"))),
                      F.array().cast("array<string>"))


def details_from_text(c) -> Column:
    """A JSON array text -> its elements; any other text -> a one-element list."""
    c = _c(c)
    parsed = F.from_json(c, "array<string>")
    as_list = F.when(F.trim(c).startswith("["), parsed)
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(
        F.when(as_list.isNotNull(), details_from_array(as_list)).otherwise(F.array(c)))


# --- P13 alternative-field fallback ------------------------------------------

def first_truthy(*cols) -> Column:
    """Python ``a or b``: skip NULL and empty strings."""
    return F.coalesce(*[F.nullif(_c(c).cast("string"), F.lit("")) for c in cols])


def point_or_flat(df: DataFrame, struct_col: str, lat_col: str, lon_col: str) -> Column:
    """Take lat/lon from a struct column when present, else from flat columns
    (numbers kept as they are, text parsed tolerantly)."""
    cols = df.columns

    def num(c: Column, dtype: str | None) -> Column:
        return c.cast("double") if dtype in _INTEGRAL + _FRACTIONAL else to_float(c)

    def part(name, flat):
        flat_c = to_float_of(df, flat) if flat in cols else F.lit(None).cast("double")
        if struct_col in cols:
            field = df.schema[struct_col].dataType
            sub = {f.name: f.dataType.simpleString() for f in getattr(field, "fields", [])}
            return F.when(F.col(struct_col).isNotNull(), num(F.col(struct_col)[name], sub.get(name))) \
                .otherwise(flat_c)
        return flat_c
    return F.struct(part("lat", lat_col).alias("lat"), part("lon", lon_col).alias("lon"))


# --- P6 geo structs ------------------------------------------------------------

def geo_point(lat, lon) -> Column:
    return F.struct(_c(lat).cast("double").alias("lat"), _c(lon).cast("double").alias("lon"))


# --- P19 schema-contract coercion -----------------------------------------------

def conform(df: DataFrame, contract: StructType, defaults: dict | None = None) -> DataFrame:
    """Project ``df`` onto ``contract``: every field cast to its target type,
    missing fields NULL (or a default column), extra fields dropped."""
    defaults = defaults or {}
    cols = []
    for f in contract.fields:
        if f.name in defaults:
            src = defaults[f.name]
        elif f.name in df.columns:
            src = F.col(f.name)
        else:
            src = F.lit(None)
        cols.append(src.cast(f.dataType).alias(f.name))
    return df.select(*cols)
