"""Analytical marts over the flight fact.

Every mart adds up mergeable aggregates (``contrail.plans.partials``): those that a
build has stored, or those of a fact given directly (the ``mart_*`` functions).  The
(much smaller) dimension is joined afterwards, so the only large shuffle is the partially
aggregated group-by; the dimension join runs on one row per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import band, count_where, rate_pct, round_half_up, safe_ratio
from contrail.operators.joins import attach_dim
from contrail.operators.reshape import banded_summary
from contrail.plans import partials

# Weather bands (upper bound exclusive; NULL reading -> unknown).
UNKNOWN_BAND = "unknown"
VISIBILITY_BANDS = (
    ("<", 1, "visibility under 1 mile"),
    ("<", 3, "visibility 1 to 3 miles"),
    ("<", 10, "visibility 3 to 10 miles"),
)
VISIBILITY_OTHERWISE = "visibility 10 miles or more"
PRECIPITATION_BANDS = (
    ("==", 0, "no precipitation"),
    ("<", 0.05, "light precipitation"),
    ("<", 0.2, "moderate precipitation"),
)
PRECIPITATION_OTHERWISE = "heavy precipitation"
WIND_BANDS = (
    ("<", 10, "wind under 10 mph"),
    ("<", 20, "wind 10 to 20 mph"),
    ("<", 30, "wind 20 to 30 mph"),
)
WIND_OTHERWISE = "wind 30 mph or more"


def _sums(df: DataFrame, *keys: str, **measures: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(f"{sql} AS {name}") for name, sql in measures.items()])


def _mean(total: str, n: str) -> str:
    return f"try_divide(CAST(sum({total}) AS DOUBLE), CAST(sum({n}) AS DOUBLE))"


def _carrier_measures(fct: DataFrame, exact: bool) -> DataFrame:
    """The carrier mart's measures from sketches (``exact=False``)."""
    q = F.percentile_approx("arrival_delay_minutes", [0.5, 0.9], 10000)
    agg = fct.groupBy("carrier_key").agg(
        F.count(F.lit(1)).cast("bigint").alias("flight_count"),
        count_where(F.col("is_cancelled")).alias("cancelled_count"),
        count_where(F.col("is_diverted")).alias("diverted_count"),
        count_where(F.col("is_departure_delayed")).alias("departure_delayed_count"),
        count_where(F.col("is_arrival_delayed")).alias("arrival_delayed_count"),
        F.approx_count_distinct("destination_code", 0.01).alias("destination_count"),
        F.approx_count_distinct("tail_number", 0.01).alias("aircraft_count"),
        F.avg("departure_delay_minutes").alias("_avg_dep"),
        F.avg("arrival_delay_minutes").alias("_avg_arr"),
        q.alias("_quantiles"),
        F.avg("delay_change_in_air_minutes").alias("_avg_change"),
        F.sum("distance_miles").cast("bigint").alias("total_distance_miles"),
    )
    return agg


def carrier_performance(delays: DataFrame, members: DataFrame, carriers: DataFrame, ordered: bool = True) -> DataFrame:
    """The carrier mart from ``partials.carrier_delays`` and ``partials.carrier_members``."""
    agg = _sums(
        delays, "carrier_key", flight_count="sum(n)", cancelled_count="sum(cancelled)", diverted_count="sum(diverted)",
        departure_delayed_count="sum(departure_delayed)", arrival_delayed_count="sum(arrival_delayed)",
        _avg_dep=_mean("departure_sum", "departure_n"),
        _avg_arr=_mean("arrival_delay_minutes * n", "CASE WHEN arrival_delay_minutes IS NOT NULL THEN n END"),
        _quantiles="percentile(arrival_delay_minutes, array(0.5D, 0.9D), n)",
        _avg_change=_mean("change_sum", "change_n"), total_distance_miles="sum(miles)")
    # A member of several months is one.
    counts = _sums(members.select("carrier_key", "kind", "value").distinct(), "carrier_key",
                   destination_count="count_if(kind = 'destination')", aircraft_count="count_if(kind = 'aircraft')")
    return _carrier_mart(agg.join(counts, "carrier_key", "left"), carriers, ordered)


def _carrier_mart(agg: DataFrame, carriers: DataFrame, ordered: bool) -> DataFrame:
    agg = agg.withColumns({
        "_median_arr": F.col("_quantiles")[0].cast("double"), "_p90_arr": F.col("_quantiles")[1].cast("double"),
        **{c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("destination_count", "aircraft_count")}})
    out = attach_dim(agg, carriers, "carrier_key").select(
        "carrier_code", "carrier_name", "flight_count", "cancelled_count", "diverted_count",
        "departure_delayed_count", "arrival_delayed_count", "destination_count", "aircraft_count",
        rate_pct("cancelled_count", "flight_count").alias("cancellation_rate_pct"),
        rate_pct("departure_delayed_count", "flight_count").alias("departure_delay_rate_pct"),
        rate_pct("arrival_delayed_count", "flight_count").alias("arrival_delay_rate_pct"),
        round_half_up("_avg_dep", 2).alias("avg_departure_delay_minutes"),
        round_half_up("_avg_arr", 2).alias("avg_arrival_delay_minutes"),
        round_half_up("_median_arr", 2).alias("median_arrival_delay_minutes"),
        round_half_up("_p90_arr", 2).alias("p90_arrival_delay_minutes"),
        round_half_up("_avg_change", 2).alias("avg_delay_change_in_air_minutes"),
        "total_distance_miles",
    )
    return out.orderBy(F.col("flight_count").desc(), F.col("carrier_code").asc_nulls_last()) if ordered else out


def mart_carrier_performance(fct: DataFrame, carriers: DataFrame, exact: bool = True, ordered: bool = True) -> DataFrame:
    if not exact:
        return _carrier_mart(_carrier_measures(fct, exact), carriers, ordered)
    return carrier_performance(partials.carrier_delays(fct), partials.carrier_members(fct), carriers, ordered)


def mart_route_performance(fct: DataFrame, airports: DataFrame, ordered: bool = True) -> DataFrame:
    return route_performance(partials.routes(fct), airports, ordered)


def route_performance(routes: DataFrame, airports: DataFrame, ordered: bool = True) -> DataFrame:
    """The route mart from ``partials.routes``."""
    agg = _sums(
        routes, "route_code", "origin_code", "destination_code", "origin_airport_key", "destination_airport_key",
        flight_count="sum(n)", carrier_count=partials.CARRIER_COUNT,
        cancelled_count="sum(cancelled)", arrival_delayed_count="sum(arrival_delayed)",
        _avg_arr=_mean("arrival_sum", "arrival_n"), _avg_air=_mean("air_sum", "air_n"), distance_miles="min(miles)")
    destination = airports.select(
        F.col("airport_key").alias("destination_airport_key"),
        F.col("airport_name").alias("destination_name"),
        F.col("municipality").alias("destination_city"),
        F.col("iso_region").alias("destination_region"),
    )
    out = attach_dim(agg, destination, "destination_airport_key").select(
        "route_code", "origin_code", "destination_code", "destination_name", "destination_city",
        "destination_region", "distance_miles", "flight_count", "carrier_count", "cancelled_count",
        "arrival_delayed_count",
        rate_pct("cancelled_count", "flight_count").alias("cancellation_rate_pct"),
        rate_pct("arrival_delayed_count", "flight_count").alias("arrival_delay_rate_pct"),
        round_half_up("_avg_arr", 2).alias("avg_arrival_delay_minutes"),
        round_half_up("_avg_air", 2).alias("avg_air_time_minutes"),
        round_half_up(safe_ratio("distance_miles", "_avg_air") * F.lit(60.0), 1).alias("avg_ground_speed_mph"),
    )
    return out.orderBy(F.col("flight_count").desc(), F.col("route_code").asc_nulls_last()) if ordered else out


def weather_bands() -> dict:
    return {
        "visibility": band("origin_visibility_miles", VISIBILITY_BANDS, VISIBILITY_OTHERWISE, UNKNOWN_BAND),
        "precipitation": band("origin_precipitation_in", PRECIPITATION_BANDS, PRECIPITATION_OTHERWISE,
                              UNKNOWN_BAND),
        "wind": band("origin_wind_speed_mph", WIND_BANDS, WIND_OTHERWISE, UNKNOWN_BAND),
    }


def mart_weather_impact(fct: DataFrame, exact: bool = True, ordered: bool = True) -> DataFrame:
    """Flights by weather band, three banding dimensions stacked; a flight
    with an unknown reading is left out of that condition only."""
    if exact:
        return weather_impact(partials.weather_delays(fct), ordered)
    q = F.percentile_approx("departure_delay_minutes", [0.5, 0.9], 10000)
    return _weather_mart(banded_summary(
        fct.select("origin_visibility_miles", "origin_precipitation_in", "origin_wind_speed_mph",
                   "is_cancelled", "is_departure_delayed", "departure_delay_minutes"),
        weather_bands(),
        [F.count(F.lit(1)).cast("bigint").alias("flight_count"),
         count_where(F.col("is_cancelled")).alias("cancelled_count"),
         count_where(F.col("is_departure_delayed")).alias("departure_delayed_count"),
         F.avg("departure_delay_minutes").alias("_avg_dep"),
         q.alias("_quantiles")],
        exclude_band=UNKNOWN_BAND), ordered)


def weather_impact(delays: DataFrame, ordered: bool = True) -> DataFrame:
    """The weather mart from ``partials.weather_delays``."""
    return _weather_mart(_sums(
        delays, "condition_type", "condition_band", flight_count="sum(n)", cancelled_count="sum(cancelled)",
        departure_delayed_count="sum(departure_delayed)",
        _avg_dep=_mean("departure_delay_minutes * n", "CASE WHEN departure_delay_minutes IS NOT NULL THEN n END"),
        _quantiles="percentile(departure_delay_minutes, array(0.5D, 0.9D), n)"), ordered)


def _weather_mart(summary: DataFrame, ordered: bool) -> DataFrame:
    out = summary.select(
        "condition_type", "condition_band", "flight_count", "cancelled_count",
        "departure_delayed_count",
        rate_pct("cancelled_count", "flight_count").alias("cancellation_rate_pct"),
        rate_pct("departure_delayed_count", "flight_count").alias("departure_delay_rate_pct"),
        round_half_up("_avg_dep", 2).alias("avg_departure_delay_minutes"),
        round_half_up(F.col("_quantiles")[0].cast("double"), 2).alias("median_departure_delay_minutes"),
        round_half_up(F.col("_quantiles")[1].cast("double"), 2).alias("p90_departure_delay_minutes"),
    )
    return out.orderBy("condition_type", "condition_band") if ordered else out


def mart_daily_operations(fct: DataFrame, dates: DataFrame, ordered: bool = True) -> DataFrame:
    return daily_operations(partials.daily(fct), dates, ordered)


def daily_operations(daily: DataFrame, dates: DataFrame, ordered: bool = True) -> DataFrame:
    """The daily mart from ``partials.daily``, one row of which is one of it."""
    agg = daily.selectExpr(
        "date_key", "origin_code", "n AS flight_count", "cancelled AS cancelled_count", "departure_delayed AS departure_delayed_count",
        "try_divide(CAST(departure_sum AS DOUBLE), CAST(departure_n AS DOUBLE)) AS _avg_dep",
        "departure_max AS max_departure_delay_minutes", "avg_precipitation_in", "min_visibility_miles", "max_wind_speed_mph")
    cal = dates.select("date_key", "date_day", "calendar_month", "month_name", "day_name",
                       "is_weekend", "is_holiday", "holiday_name")
    out = attach_dim(agg, cal, "date_key").select(
        "date_day", "calendar_month", "month_name", "day_name", "is_weekend", "is_holiday",
        "holiday_name", "origin_code", "flight_count", "cancelled_count", "departure_delayed_count",
        rate_pct("cancelled_count", "flight_count").alias("cancellation_rate_pct"),
        rate_pct("departure_delayed_count", "flight_count").alias("departure_delay_rate_pct"),
        round_half_up("_avg_dep", 2).alias("avg_departure_delay_minutes"),
        "max_departure_delay_minutes",
        "avg_precipitation_in",
        "min_visibility_miles", "max_wind_speed_mph",
    )
    return out.orderBy("date_day", "origin_code") if ordered else out


def mart_aircraft_utilization(fct: DataFrame, aircraft: DataFrame, ordered: bool = True) -> DataFrame:
    return aircraft_utilization(partials.aircraft(fct), aircraft, ordered)


def aircraft_utilization(usage: DataFrame, aircraft: DataFrame, ordered: bool = True) -> DataFrame:
    """The aircraft mart from ``partials.aircraft``: months have no day in common."""
    agg = _sums(
        usage, "aircraft_key", flight_count="sum(n)", active_day_count="CAST(sum(bit_count(coalesce(days, 0))) AS BIGINT)",
        carrier_count=partials.CARRIER_COUNT,
        route_count="CAST(size(array_distinct(flatten(collect_list(routes)))) AS BIGINT)",
        total_air_time_minutes="sum(air_sum)", total_distance_miles="sum(miles)", _avg_arr=_mean("arrival_sum", "arrival_n"))
    out = attach_dim(agg, aircraft, "aircraft_key").select(
        "tail_number", "manufacturer", "model", "size_class", "seat_count", "manufactured_year",
        "age_years_in_2013", "has_reference_record", "flight_count", "active_day_count",
        "carrier_count", "route_count", "total_air_time_minutes", "total_distance_miles",
        round_half_up(safe_ratio("flight_count", "active_day_count"), 2).alias("flights_per_active_day"),
        round_half_up("_avg_arr", 2).alias("avg_arrival_delay_minutes"),
    )
    return out.orderBy(F.col("flight_count").desc(), F.col("tail_number").asc_nulls_last()) if ordered else out
