"""Ad-hoc analyses published with the warehouse: delay by hour of day,
holidays against other days, and the worst days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import count_where, rate_pct, round_half_up


def delay_by_hour(fct: DataFrame) -> DataFrame:
    """Departure delay rate and mean delay by scheduled local hour."""
    agg = fct.groupBy("scheduled_departure_hour_local").agg(
        F.count(F.lit(1)).cast("bigint").alias("flight_count"),
        count_where(F.col("is_departure_delayed")).alias("departure_delayed_count"),
        F.avg("departure_delay_minutes").alias("_avg_dep"),
    )
    return agg.select(
        "scheduled_departure_hour_local", "flight_count", "departure_delayed_count",
        rate_pct("departure_delayed_count", "flight_count").alias("departure_delay_rate_pct"),
        round_half_up("_avg_dep", 1).alias("avg_departure_delay_minutes"),
    ).orderBy("scheduled_departure_hour_local")


def holiday_effect(fct: DataFrame, dates: DataFrame) -> DataFrame:
    """Holidays against other days.  The fact is first reduced to one row per
    date key (partial aggregation), so the calendar join sees at most one row
    per day whatever the fact size."""
    per_day = fct.groupBy("date_key").agg(
        F.count(F.lit(1)).cast("bigint").alias("_n"),
        count_where(F.col("is_departure_delayed")).alias("_dep"),
        count_where(F.col("is_arrival_delayed")).alias("_arr"),
        count_where(F.col("is_cancelled")).alias("_can"),
    )
    joined = per_day.join(dates.select("date_key", "is_holiday"), on="date_key", how="inner")
    agg = joined.groupBy("is_holiday").agg(
        F.sum("_n").cast("bigint").alias("flight_count"),
        F.sum("_dep").cast("bigint").alias("departure_delayed_count"),
        F.sum("_arr").cast("bigint").alias("arrival_delayed_count"),
        F.sum("_can").cast("bigint").alias("cancelled_count"),
    )
    return agg.select(
        "is_holiday", "flight_count", "departure_delayed_count", "arrival_delayed_count",
        "cancelled_count",
        rate_pct("departure_delayed_count", "flight_count").alias("departure_delay_rate_pct"),
        rate_pct("arrival_delayed_count", "flight_count").alias("arrival_delay_rate_pct"),
        rate_pct("cancelled_count", "flight_count").alias("cancellation_rate_pct"),
    ).orderBy("is_holiday")


def worst_days(daily: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` (day, origin) pairs with the highest cancellation rate; ties
    broken by flight count, then date and origin, so the cut is deterministic.
    The limit is the feature here (a top-k report): Spark plans it as a
    TakeOrderedAndProject, keeping only ``n`` rows per task."""
    return (daily.select("date_day", "origin_code", "flight_count", "cancelled_count",
                         "cancellation_rate_pct")
                 .orderBy(F.col("cancellation_rate_pct").desc_nulls_last(),
                          F.col("flight_count").desc(), F.col("date_day").asc(),
                          F.col("origin_code").asc_nulls_last())
                 .limit(n))
