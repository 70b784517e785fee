"""Staging models: rename, clean, conform types; one function per model.

All are lazy DataFrame functions (views).  None shuffles except the weather
dedup (one shuffle on station and hour) and the reference rankings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import (clean, equals_literal, hhmm_to_minute, null_if_above, to_utc_wall,
                                typed_null)
from contrail.operators.dedup import dedup_first, first_by
from contrail.operators.joins import Tier, conform, gap_fill

# Readings above this many mph are instrument errors and become NULL.
MAX_PLAUSIBLE_WIND_MPH = 200


def stg_flight(flights: DataFrame) -> DataFrame:
    """One row per source row: keys, date, clocks decoded to minutes, delays,
    UTC departure hour, cancelled / diverted flags."""
    hour_utc = to_utc_wall("time_hour", flights.schema["time_hour"].dataType)
    return flights.select(
        F.col("rownames").cast("bigint").alias("flight_key"),
        F.make_date(F.col("year").cast("int"), F.col("month").cast("int"),
                    F.col("day").cast("int")).alias("flight_date"),
        F.col("carrier").alias("carrier_code"),
        F.col("flight").cast("bigint").alias("flight_number"),
        clean("tailnum").alias("tail_number"),
        F.col("origin").alias("origin_code"),
        F.col("dest").alias("destination_code"),
        hhmm_to_minute("sched_dep_time").alias("scheduled_departure_minute"),
        hhmm_to_minute("sched_arr_time").alias("scheduled_arrival_minute"),
        hhmm_to_minute("dep_time").alias("actual_departure_minute"),
        hhmm_to_minute("arr_time").alias("actual_arrival_minute"),
        F.col("dep_delay").cast("bigint").alias("departure_delay_minutes"),
        F.col("arr_delay").cast("bigint").alias("arrival_delay_minutes"),
        F.col("air_time").cast("bigint").alias("air_time_minutes"),
        F.col("distance").cast("bigint").alias("distance_miles"),
        hour_utc.alias("scheduled_departure_hour_utc"),
        F.col("dep_time").isNull().alias("is_cancelled"),
        (F.col("dep_time").isNotNull() & F.col("arr_delay").isNull()).alias("is_diverted"),
    )


def stg_weather(weather: DataFrame) -> DataFrame:
    """Hourly readings per station: renamed, impossible wind readings nulled,
    one reading per (station, UTC hour) — the coldest, NULL temperatures last."""
    hour_utc = to_utc_wall("time_hour", weather.schema["time_hour"].dataType)
    renamed = weather.select(
        F.col("origin").alias("origin_code"),
        hour_utc.alias("observed_hour_utc"),
        F.col("temp").cast("double").alias("temperature_f"),
        F.col("dewp").cast("double").alias("dew_point_f"),
        F.col("humid").cast("double").alias("relative_humidity_pct"),
        F.col("wind_dir").cast("bigint").alias("wind_direction_deg"),
        null_if_above(F.col("wind_speed").cast("double"), MAX_PLAUSIBLE_WIND_MPH).alias("wind_speed_mph"),
        null_if_above(F.col("wind_gust").cast("double"), MAX_PLAUSIBLE_WIND_MPH).alias("wind_gust_mph"),
        F.col("precip").cast("double").alias("precipitation_in"),
        F.col("pressure").cast("double").alias("sea_level_pressure_mb"),
        F.col("visib").cast("double").alias("visibility_miles"),
    )
    return first_by(renamed, ["origin_code", "observed_hour_utc"], ["temperature_f"])


def stg_plane(planes: DataFrame) -> DataFrame:
    return planes.select(
        F.col("tailnum").alias("tail_number"),
        F.col("year").cast("bigint").alias("manufactured_year"),
        clean("type").alias("airframe_type"),
        clean("manufacturer").alias("manufacturer"),
        clean("model").alias("model"),
        F.col("engines").cast("bigint").alias("engine_count"),
        F.col("seats").cast("bigint").alias("seat_count"),
        clean("engine").alias("engine_type"),
    )


def stg_carrier(airlines: DataFrame, openflights: DataFrame) -> DataFrame:
    """Carriers flown, each joined to its best active reference row (lowest
    name among active rows with that IATA code)."""
    carriers = airlines.select(F.col("carrier").alias("carrier_code"),
                               clean("name").alias("carrier_name"))
    active = openflights.where(clean("iata").isNotNull() & equals_literal("active", "Y")).select(
        clean("iata").alias("_of_code"),
        clean("name").alias("_of_name"),
        clean("icao").alias("icao_code"),
        clean("callsign").alias("callsign"),
        clean("country").alias("country"),
        equals_literal("active", "Y").alias("_of_active"),
    )
    best = dedup_first(active, ["_of_code"], [F.col("_of_name").asc_nulls_last()])
    joined = carriers.join(best, on=F.col("carrier_code") == F.col("_of_code"), how="left")
    return joined.select(
        "carrier_code", "carrier_name", "icao_code", "callsign", "country",
        F.coalesce(F.col("_of_active"), F.lit(False)).alias("is_active_in_openflights"))


def stg_airport_reference(ourairports: DataFrame) -> DataFrame:
    return ourairports.select(
        F.col("ident"),
        clean("type").alias("airport_type"),
        clean("name").alias("airport_name"),
        clean("iso_country").alias("iso_country"),
        clean("iso_region").alias("iso_region"),
        clean("municipality").alias("municipality"),
        equals_literal("scheduled_service", "yes").alias("has_scheduled_service"),
        F.col("latitude_deg").cast("double").alias("latitude"),
        F.col("longitude_deg").cast("double").alias("longitude"),
        F.col("elevation_ft").cast("bigint").alias("elevation_ft"),
        clean("iata_code").alias("iata_code"),
        clean("local_code").alias("local_code"),
    )


# Provenance labels of the airport conformance.
MATCHED_IATA = "faa_matched_iata"
MATCHED_LOCAL = "faa_matched_local"
UNMATCHED = "faa_only"
REFERENCE_ONLY = "reference_only"

_REFERENCE_ATTRS = ["airport_type", "iso_country", "iso_region", "municipality",
                    "has_scheduled_service"]


def reference_tiers(reference: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two match rules over the airport reference, each unique on its key:
    by IATA code; by local code among rows without IATA (lowest ident wins)."""
    by_iata = dedup_first(reference.where(F.col("iata_code").isNotNull()), ["iata_code"],
                          [F.col("ident").asc_nulls_last()])
    by_local = dedup_first(reference.where(F.col("local_code").isNotNull() & F.col("iata_code").isNull()),
                           ["local_code"], [F.col("ident").asc_nulls_last()])
    return by_iata, by_local


def stg_airport(airports: DataFrame, reference: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Airports of the source conformed to the global reference, plus flight
    endpoints (distinct ``airport_code``) that the source lacks but the reference
    knows (``reference_only``)."""
    base = airports.select(
        F.col("faa").alias("airport_code"),
        clean("name").alias("airport_name"),
        F.col("lat").cast("double").alias("latitude"),
        F.col("lon").cast("double").alias("longitude"),
        F.col("alt").cast("bigint").alias("elevation_ft"),
        F.col("tz").cast("bigint").alias("utc_offset_hours"),
        clean("tzone").alias("time_zone"),
    )
    by_iata, by_local = reference_tiers(reference)
    matched = conform(base, "airport_code",
                      [Tier(MATCHED_IATA, by_iata, "iata_code"), Tier(MATCHED_LOCAL, by_local, "local_code")],
                      _REFERENCE_ATTRS, UNMATCHED)
    filled = gap_fill(endpoints, "airport_code", matched, "airport_code", by_iata, "iata_code").select(
        "airport_code", "airport_name", "latitude", "longitude", "elevation_ft",
        typed_null("bigint").alias("utc_offset_hours"),
        typed_null("string").alias("time_zone"),
        *_REFERENCE_ATTRS,
        F.lit(REFERENCE_ONLY).alias("source_system"),
    )
    return matched.unionByName(filled)
