"""Event-time helpers.

Rules compare whole seconds, exactly as ``cast(timestamp as long)`` does.
Both zoned (``TIMESTAMP``) and zone-less (``TIMESTAMP_NTZ``) event times are
accepted; for the zone-less kind the wall clock is read as UTC without going
through the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, TimestampNTZType


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, TimestampNTZType)


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since the epoch (floor), for either timestamp kind.

    A numeric column is taken to hold such seconds already.
    """
    if isinstance(df.schema[name].dataType, NumericType):
        return F.col(name).cast("long")
    if _is_ntz(df, name):
        return F.timestamp_diff("SECOND", _epoch_ntz(), F.col(name))
    return F.unix_seconds(F.col(name).cast("timestamp"))


def as_event_time(df: DataFrame, name: str) -> Column:
    """A zoned ``TIMESTAMP`` usable by ``withWatermark`` (NTZ read as UTC)."""
    if _is_ntz(df, name):
        return F.to_utc_timestamp(F.col(name), "UTC")
    return F.col(name)


def quote(name: str) -> str:
    """Backtick-quote a column name for SQL expression strings."""
    return "`" + name.replace("`", "``") + "`"


def epoch_seconds_sql(df: DataFrame, name: str) -> str:
    """SQL text of :func:`epoch_seconds` (whole seconds, floor).

    Zone-less times are read as UTC, whatever the session's zone.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, NumericType):
        return f"CAST({quote(name)} AS BIGINT)"
    if isinstance(dtype, TimestampNTZType):
        return f"timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {quote(name)})"
    return f"unix_seconds({quote(name)})"
