"""Star schema: calendar, airport, carrier and aircraft dimensions and the
flight fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import (band, calendar_columns, flag_gt, flag_lt, minute_to_hour,
                                surrogate_key)
from contrail.operators.joins import lookup_hourly
from contrail.operators.reshape import date_spine
from contrail.sources.readers import holidays_for_years

# The three origin airports of the source data and its year.
DEFAULT_HUBS = ("EWR", "JFK", "LGA")
DEFAULT_AS_OF_YEAR = 2013

# Aircraft size classes by seat count (upper bound exclusive).
SIZE_CLASSES = (("<", 100, "regional"), ("<", 200, "narrowbody"))
SIZE_OTHERWISE = "widebody"
SIZE_UNKNOWN = "unknown"

# Delays strictly above this many minutes count as delayed.
DELAY_THRESHOLD_MIN = 15
LOW_VISIBILITY_MILES = 3


def dim_date(flights: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """One row per calendar day between the first and last flight date.

    Without a holiday table, the federal holidays of every year on the
    spine are generated from the spine itself (one aggregate of the flight
    dates feeds both)."""
    spine = date_spine(flights, "flight_date")
    if holidays is None:
        holidays = holidays_for_years(spine.select(F.year("date_day").alias("year")).distinct())
    hol = holidays.select(F.col("holiday_date").cast("date").alias("_hol_date"), "holiday_name")
    joined = spine.join(hol, on=F.col("date_day") == F.col("_hol_date"), how="left")
    return joined.select(
        surrogate_key("date_day").alias("date_key"),
        "date_day",
        *calendar_columns("date_day"),
        F.col("_hol_date").isNotNull().alias("is_holiday"),
        "holiday_name",
    )


def dim_airport(airports: DataFrame, usage: DataFrame, hubs: Sequence[str] = DEFAULT_HUBS) -> DataFrame:
    """Conformed airports with their total flight count (arrivals + departures);
    ``usage``: ``airport_code`` and ``flight_count``, one row each."""
    totals = usage.select(F.col("airport_code").alias("_usage_code"), F.col("flight_count").alias("_usage_count"))
    joined = airports.join(totals, on=F.col("airport_code") == F.col("_usage_code"), how="left")
    return joined.select(
        surrogate_key("airport_code").alias("airport_key"),
        "airport_code", "airport_name", "municipality", "iso_country", "iso_region", "airport_type",
        "latitude", "longitude", "elevation_ft", "time_zone", "utc_offset_hours",
        F.coalesce(F.col("has_scheduled_service"), F.lit(False)).alias("has_scheduled_service"),
        "source_system",
        F.col("airport_code").isin(*hubs).alias("is_nyc_origin"),
        F.coalesce(F.col("_usage_count"), F.lit(0)).cast("bigint").alias("flight_count_2013"),
    )


def dim_carrier(carriers: DataFrame) -> DataFrame:
    return carriers.select(
        surrogate_key("carrier_code").alias("carrier_key"),
        "carrier_code", "carrier_name", "icao_code", "callsign", "country",
        "is_active_in_openflights")


def dim_aircraft(flights: DataFrame, planes: DataFrame, as_of_year: int = DEFAULT_AS_OF_YEAR) -> DataFrame:
    """One row per tail number actually flown, with reference attributes."""
    flown = flights.where(F.col("tail_number").isNotNull()).select("tail_number").distinct()
    ref = planes.withColumnRenamed("tail_number", "_plane_tail")
    joined = flown.join(ref, on=F.col("tail_number") == F.col("_plane_tail"), how="left")
    return joined.select(
        surrogate_key("tail_number").alias("aircraft_key"),
        "tail_number", "manufacturer", "model", "airframe_type", "engine_type", "engine_count",
        "seat_count", "manufactured_year",
        (F.lit(as_of_year) - F.col("manufactured_year")).cast("bigint").alias("age_years_in_2013"),
        band("seat_count", SIZE_CLASSES, SIZE_OTHERWISE, SIZE_UNKNOWN).alias("size_class"),
        F.col("_plane_tail").isNotNull().alias("has_reference_record"),
    )


FACT_COLUMNS = (
    "flight_key", "date_key", "carrier_key", "origin_airport_key", "destination_airport_key",
    "aircraft_key", "flight_date", "carrier_code", "flight_number", "tail_number", "origin_code",
    "destination_code", "route_code", "scheduled_departure_hour_utc", "scheduled_departure_minute",
    "scheduled_arrival_minute", "actual_departure_minute", "actual_arrival_minute",
    "scheduled_departure_hour_local", "departure_delay_minutes", "arrival_delay_minutes",
    "air_time_minutes", "distance_miles", "is_cancelled", "is_diverted", "is_departure_delayed",
    "is_arrival_delayed", "delay_change_in_air_minutes", "origin_temperature_f",
    "origin_wind_speed_mph", "origin_precipitation_in", "origin_visibility_miles",
    "origin_had_precipitation", "origin_had_low_visibility",
)


def fct_flight(flights: DataFrame, weather: DataFrame) -> DataFrame:
    """One row per scheduled departure with its dimension keys, derived flags
    and the origin's weather in the scheduled UTC hour."""
    obs = weather.select(
        F.col("origin_code").alias("_w_origin"),
        F.col("observed_hour_utc").alias("_w_hour"),
        F.col("temperature_f").alias("origin_temperature_f"),
        F.col("wind_speed_mph").alias("origin_wind_speed_mph"),
        F.col("precipitation_in").alias("origin_precipitation_in"),
        F.col("visibility_miles").alias("origin_visibility_miles"),
    )
    j = lookup_hourly(flights, obs, ["origin_code", "scheduled_departure_hour_utc"], ["_w_origin", "_w_hour"])
    dep, arr = F.col("departure_delay_minutes"), F.col("arrival_delay_minutes")
    return j.select(
        "flight_key",
        surrogate_key("flight_date").alias("date_key"),
        surrogate_key("carrier_code").alias("carrier_key"),
        surrogate_key("origin_code").alias("origin_airport_key"),
        surrogate_key("destination_code").alias("destination_airport_key"),
        surrogate_key("tail_number").alias("aircraft_key"),
        "flight_date", "carrier_code", "flight_number", "tail_number", "origin_code",
        "destination_code",
        F.concat(F.col("origin_code"), F.lit("-"), F.col("destination_code")).alias("route_code"),
        "scheduled_departure_hour_utc", "scheduled_departure_minute", "scheduled_arrival_minute",
        "actual_departure_minute", "actual_arrival_minute",
        minute_to_hour("scheduled_departure_minute").alias("scheduled_departure_hour_local"),
        "departure_delay_minutes", "arrival_delay_minutes", "air_time_minutes", "distance_miles",
        "is_cancelled", "is_diverted",
        flag_gt(dep, DELAY_THRESHOLD_MIN).alias("is_departure_delayed"),
        flag_gt(arr, DELAY_THRESHOLD_MIN).alias("is_arrival_delayed"),
        (arr - dep).cast("bigint").alias("delay_change_in_air_minutes"),
        "origin_temperature_f", "origin_wind_speed_mph", "origin_precipitation_in",
        "origin_visibility_miles",
        flag_gt("origin_precipitation_in", 0).alias("origin_had_precipitation"),
        flag_lt("origin_visibility_miles", LOW_VISIBILITY_MILES).alias("origin_had_low_visibility"),
    )
