"""Epoch / ISO time renderings, independent of the session time zone.

All arithmetic goes through TIMESTAMP_NTZ, whose wall clock is taken as UTC, so
results do not change with ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "1970-01-01 00:00:00"
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
UTC_SUFFIX = "+00:00"


def _epoch() -> Column:
    return F.to_timestamp_ntz(F.lit(_EPOCH_NTZ))


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp (NTZ read as UTC), truncated."""
    return F.floor(F.timestamp_diff("MICROSECOND", _epoch(), ts.cast("timestamp_ntz")) / 1000).cast("long")


def ms_of_seconds(seconds: Column) -> Column:
    """Epoch seconds (fractional) -> epoch milliseconds, truncated toward zero."""
    return (seconds.cast("double") * F.lit(1000.0)).cast("long")


def ntz_of_ms(ms: Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) of epoch milliseconds."""
    return F.timestamp_add("MILLISECOND", ms, _epoch())


def iso_of_ms(ms: Column) -> Column:
    """ISO-8601 UTC with microseconds and an explicit offset: 2024-01-01T00:00:07.179000+00:00."""
    return F.when(ms.isNotNull(), F.concat(F.date_format(ntz_of_ms(ms), ISO_PATTERN), F.lit(UTC_SUFFIX)))


def iso_of_ts(ts: Column) -> Column:
    return F.when(ts.isNotNull(), F.concat(F.date_format(ts.cast("timestamp_ntz"), ISO_PATTERN), F.lit(UTC_SUFFIX)))


def ts_of_ms(ms: Column) -> Column:
    """TIMESTAMP (instant) of epoch milliseconds."""
    return F.timestamp_millis(ms)


def window_end_ms(ms: Column, window_ms: int) -> Column:
    """End of the tumbling gateway window that contains ``ms``: the gateway stamp."""
    return ((F.floor(ms / F.lit(window_ms)) + 1) * F.lit(window_ms)).cast("long")


def window_index(ms: Column, window_ms: int) -> Column:
    return F.floor(ms / F.lit(window_ms)).cast("long")
