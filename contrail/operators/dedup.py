"""Keep the first row per key under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> list[Column]:
    """``order`` followed by every other column ascending, nulls last, so ties
    are broken the same way on every run (the result never depends on which
    task a row happened to land in)."""
    named = set(keys)
    tail = [F.col(c).asc_nulls_last() for c in df.columns if c not in named]
    return [*order, *tail]


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per ``keys``, all of ``order`` ascending with NULLs last, then
    every other column likewise.

    A grouped minimum over (is NULL, value) pairs: it combines on the map side,
    and the optimiser knows that the keys are unique afterwards, so that a left join
    whose columns nobody reads is dropped.
    """
    rest = [c for c in df.columns if c not in set(keys) | set(order)]
    ranked = F.min(F.struct(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(c) for c in [*order, *rest]])).alias("_first")
    return df.groupBy(*keys).agg(ranked).select(*[F.col(c) if c in keys else F.col(f"_first.{c}.v").alias(c) for c in df.columns])


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                rank_col: str = "_rank") -> DataFrame:
    """First row per ``keys`` by ``order`` (then all columns as tie-break).

    Planned as ``row_number() = 1``: Spark adds a partial WindowGroupLimit
    before the shuffle, so each map task ships at most one row per key and a
    hot key cannot swamp the reducer.
    """
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order))
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) == 1)
              .drop(rank_col))
