"""Set and reshaping operators: distinct members of several columns, usage
totals over roles, stacked (unpivoted) banded summaries, the date spine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_members(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """``SELECT a UNION SELECT b ...`` in one scan: explode the columns, then
    one distinct (partial aggregation on the map side)."""
    return df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(name)).distinct()


def usage_totals(df: DataFrame, role_cols: Sequence[str], name: str,
                 count_name: str = "flight_count") -> DataFrame:
    """How often each member appears across all role columns (count per role,
    summed over roles) — one scan, one partially aggregated group-by."""
    return (df.select(F.explode(F.array(*[F.col(c) for c in role_cols])).alias(name))
              .groupBy(name)
              .agg(F.count(F.lit(1)).cast("bigint").alias(count_name)))


def stack_conditions(df: DataFrame, conditions: Mapping[str, Column],
                     type_col: str = "condition_type", band_col: str = "condition_band") -> DataFrame:
    """One output row per input row and condition: ``(type, band, *columns)``.

    This is ``UNION ALL`` of one arm per condition, but planned as a single
    scan with a generator instead of one scan per arm.
    """
    entries = F.array(*[F.struct(F.lit(t).alias("t"), b.cast("string").alias("b"))
                        for t, b in conditions.items()])
    return (df.select("*", F.explode(entries).alias("_cond"))
              .select(F.col("_cond.t").alias(type_col), F.col("_cond.b").alias(band_col),
                      *[F.col(c) for c in df.columns]))


def banded_summary(df: DataFrame, conditions: Mapping[str, Column], measures: Sequence[Column],
                   exclude_band: str | None = "unknown", type_col: str = "condition_type",
                   band_col: str = "condition_band") -> DataFrame:
    """Stack several banding dimensions, drop the excluded band *per
    condition*, and aggregate ``measures`` per (type, band)."""
    stacked = stack_conditions(df, conditions, type_col, band_col)
    if exclude_band is not None:
        stacked = stacked.where(F.col(band_col) != F.lit(exclude_band))
    return stacked.groupBy(type_col, band_col).agg(*measures)


def date_spine(df: DataFrame, col: str, name: str = "date_day") -> DataFrame:
    """Every day from ``min(col)`` to ``max(col)``: one global aggregate (a
    single row), then a generator — the spine is bounded by the number of days,
    not by the rows of ``df``."""
    bounds = df.agg(F.min(F.col(col)).alias("_lo"), F.max(F.col(col)).alias("_hi"))
    return (bounds.where(F.col("_lo").isNotNull())
                  .select(F.explode(F.sequence(F.col("_lo").cast("date"), F.col("_hi").cast("date"),
                                               F.expr("interval 1 day"))).alias(name)))
