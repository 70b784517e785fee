"""Cleaning expressions: blank-to-null strings, range clamps, typed nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Trim surrounding spaces; an empty result becomes NULL.

    ``F.trim`` removes spaces only (not tabs), the same rule as ANSI ``trim``.
    """
    return F.nullif(F.trim(_col(c)), F.lit(""))


def null_if_above(c: Column | str, limit: float) -> Column:
    """Keep a reading only when it is at most ``limit`` (impossible readings
    become NULL; NULL stays NULL)."""
    c = _col(c)
    return F.when(c <= F.lit(limit), c)


def typed_null(type_name: str) -> Column:
    """A NULL literal of a declared type, e.g. ``typed_null("bigint")``."""
    return F.lit(None).cast(type_name)


def equals_literal(c: Column | str, value: str) -> Column:
    """String equality as a boolean column (``'yes'`` / ``'Y'`` flags)."""
    return _col(c) == F.lit(value)
