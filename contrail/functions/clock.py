"""Clock and time-zone expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

MINUTES_PER_DAY = 1440


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a: Column | str, b: int) -> Column:
    """Integer division truncating toward zero (SQL ``div``), bigint result."""
    return F.call_function("div", _col(a), F.lit(b)).cast("bigint")


def hhmm_to_minute(c: Column | str) -> Column:
    """Integer clock ``HHMM`` -> minutes past midnight, wrapped into a day.

    ``2400`` (and any ``24MM``) wraps to the next day's minute; NULL stays NULL.
    """
    c = _col(c)
    return ((idiv(c, 100) * 60 + c % 100) % MINUTES_PER_DAY).cast("bigint")


def minute_to_hhmm(c: Column | str) -> Column:
    """Minutes past midnight -> integer ``HHMM`` clock."""
    c = _col(c)
    return (idiv(c, 60) * 100 + c % 60).cast("bigint")


def minute_to_hour(c: Column | str) -> Column:
    """Minutes past midnight -> hour of the day (0-23)."""
    return idiv(c, 60)


def to_utc_wall(c: Column | str, data_type=None) -> Column:
    """An instant -> zone-less UTC wall-clock timestamp.

    A ``timestamp`` (instant) column is converted independently of the session
    time zone; a ``timestamp_ntz`` column is taken to be UTC wall time already.
    """
    c = _col(c)
    if isinstance(data_type, TimestampNTZType):
        return c
    if data_type is None or isinstance(data_type, TimestampType):
        return F.convert_timezone(None, F.lit("UTC"), c)
    return c.cast("timestamp_ntz")
