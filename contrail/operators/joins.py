"""Join operators: enrichment, best-match joins, two-tier conformance,
null-aware NOT IN and gap filling.

No join here forces a strategy.  Dimensions are joined *after* the fact has
been aggregated (eager aggregation, see plans/marts.py), so the side AQE sees at
run time is small and it converts the sort-merge join into a broadcast join on
the measured size (``spark.sql.adaptive.autoBroadcastJoinThreshold``); when a
side is larger than that threshold, the sort-merge plan stays.  An explicit
``F.broadcast`` is used only for inputs whose size is bounded by construction
(at most one row, or a literal seed).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.operators.dedup import dedup_first


def attach_dim(agg: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner join of an aggregate to its dimension on the surrogate key."""
    return agg.join(dim, on=key, how="inner")


def lookup_hourly(fact: DataFrame, obs: DataFrame, fact_keys: Sequence[str],
                  obs_keys: Sequence[str]) -> DataFrame:
    """Point-in-time lookup: left join of the fact to readings that are unique
    on ``obs_keys`` (e.g. station and UTC hour).  Hashing on both key columns
    spreads the work even when there are only a handful of stations."""
    cond = [fact[f] == obs[o] for f, o in zip(fact_keys, obs_keys)]
    return fact.join(obs, on=cond, how="left")


def join_best(df: DataFrame, ref: DataFrame, left_on: str, right_on: str,
              order: Sequence[Column], how: str = "left") -> DataFrame:
    """Join each row to the single best-ranked reference row for its key.

    Ranking happens on the reference side before the join (same result as a
    ``rank = 1`` condition inside the ON clause, but it shrinks the join input).
    """
    best = dedup_first(ref.where(F.col(right_on).isNotNull()), [right_on], order)
    return df.join(best, on=df[left_on] == best[right_on], how=how)


def where_not_in(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """``df.col NOT IN (SELECT other_col FROM other)`` with SQL's null rules.

    * a NULL ``df.col`` is never returned;
    * a NULL anywhere in ``other_col`` makes the result empty.

    Planned as a left-anti join on the non-null key (hash or sort-merge, chosen
    at run time) plus an anti join against *at most one* marker row, instead of
    Spark's null-aware anti join, which insists on broadcasting the whole
    subquery side.
    """
    keys = other.select(F.col(other_col).alias("_nin_key")).where(F.col("_nin_key").isNotNull())
    kept = (df.where(F.col(col).isNotNull())
              .join(keys, on=F.col(col) == F.col("_nin_key"), how="left_anti"))
    null_marker = F.broadcast(other.where(F.col(other_col).isNull()).select(F.lit(1).alias("_nin_null")).limit(1))
    return kept.join(null_marker, on=F.lit(True), how="left_anti")


@dataclass(frozen=True)
class Tier:
    """One conformance rule: join ``base_key`` to ``ref_key`` of ``ref``."""

    label: str
    ref: DataFrame
    ref_key: str


def conform(base: DataFrame, base_key: str, tiers: Sequence[Tier], attrs: Sequence[str],
            fallback_label: str, provenance_col: str = "source_system",
            id_col: str = "ident") -> DataFrame:
    """Match each base row against several reference rules in priority order.

    Each tier must already be unique on its key (use ``dedup_first``).  The
    attributes are taken from the first tier that matched (``coalesce`` in tier
    order); ``provenance_col`` names which rule matched, or ``fallback_label``.
    All tiers are left joins, so the base row count is preserved.
    """
    out = base
    for i, tier in enumerate(tiers):
        side = tier.ref.select(
            F.col(tier.ref_key).alias(f"_t{i}_key"),
            F.col(id_col).alias(f"_t{i}_id"),
            *[F.col(a).alias(f"_t{i}_{a}") for a in attrs])
        out = out.join(side, on=F.col(base_key) == F.col(f"_t{i}_key"), how="left")
    cols = [F.coalesce(*[F.col(f"_t{i}_{a}") for i in range(len(tiers))]).alias(a) for a in attrs]
    prov = F.lit(fallback_label)
    for i in reversed(range(len(tiers))):
        prov = F.when(F.col(f"_t{i}_id").isNotNull(), F.lit(tiers[i].label)).otherwise(prov)
    return out.select(*base.columns, *cols, prov.alias(provenance_col))


def gap_fill(members: DataFrame, member_col: str, matched: DataFrame, matched_col: str,
             ref: DataFrame, ref_key: str) -> DataFrame:
    """Members absent from ``matched`` (null-aware NOT IN) that the reference
    knows by ``ref_key`` — inner join, so unknown members stay out."""
    missing = where_not_in(members, member_col, matched, matched_col)
    return missing.join(ref, on=F.col(member_col) == F.col(ref_key), how="inner")
