"""Calendar attribute expressions (Sunday-based week, full English names)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of_week_sun0(c: Column | str) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(_col(c)) - 1).cast("bigint")


def month_name(c: Column | str) -> Column:
    """Full English month name (``January``)."""
    return F.date_format(_col(c), "MMMM")


def day_name(c: Column | str) -> Column:
    """Full English day name (``Sunday``)."""
    return F.date_format(_col(c), "EEEE")


def is_weekend(c: Column | str) -> Column:
    return day_of_week_sun0(c).isin(0, 6)


def calendar_columns(c: Column | str) -> list[Column]:
    """The calendar attributes of a date column, named as in ``dim_date``."""
    d = _col(c)
    return [
        F.year(d).cast("bigint").alias("calendar_year"),
        F.quarter(d).cast("bigint").alias("calendar_quarter"),
        F.month(d).cast("bigint").alias("calendar_month"),
        month_name(d).alias("month_name"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        day_of_week_sun0(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        F.weekofyear(d).cast("bigint").alias("week_of_year"),
        is_weekend(d).alias("is_weekend"),
    ]
