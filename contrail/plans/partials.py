"""Mergeable aggregates of the fact, from which marts and dimensions are made.

Each function reduces the fact to rows that can be added up: counts, sums,
smallest and largest values, sets of members, a bit for each day of a month, and for
exact quantiles the rows of a value-to-count histogram.  With ``by`` (the fact's
partition columns) a build stores them for each month of the fact; after a merge
only the months that changed are reduced again, and marts and dimensions are made from
the stored rows, whose number follows groups and months, not flights.  Without ``by``
the same functions serve the queries straight from the fact.

All are one pass with a partial aggregation on the map side, so a carrier or
airport that holds a third of all flights is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import MISSING_TOKEN, surrogate_key
from contrail.operators.reshape import stack_conditions

MONTH = ("flight_year", "flight_month")
#: The carriers of a group; one without a code is the missing one, as its key has it.
CARRIERS = f"collect_set(coalesce(carrier_code, '{MISSING_TOKEN}'))"
CARRIER_COUNT = f"CAST(size(array_remove(array_distinct(flatten(collect_list(carriers))), '{MISSING_TOKEN}')) AS BIGINT)"


def with_months(fct: DataFrame) -> DataFrame:
    """The fact with its partition columns, derived where it lacks them."""
    return fct if MONTH[0] in fct.columns else fct.selectExpr("*", "year(flight_date) AS flight_year", "month(flight_date) AS flight_month")


def _agg(df: DataFrame, keys: Sequence[str], **measures: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(f"{sql} AS {name}") for name, sql in measures.items()])


def carrier_delays(fct: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per carrier and arrival delay (NULL included): a histogram that carries the sums."""
    return _agg(
        fct, [*by, "carrier_key", "arrival_delay_minutes"],
        n="count(1)", cancelled="count_if(is_cancelled)", diverted="count_if(is_diverted)",
        departure_delayed="count_if(is_departure_delayed)", arrival_delayed="count_if(is_arrival_delayed)",
        departure_sum="sum(departure_delay_minutes)", departure_n="count(departure_delay_minutes)",
        change_sum="sum(delay_change_in_air_minutes)", change_n="count(delay_change_in_air_minutes)", miles="sum(distance_miles)")


def carrier_members(fct: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The destinations and aircraft of each carrier, one row each."""
    kinds = "explode(array(named_struct('kind', 'destination', 'value', destination_code), named_struct('kind', 'aircraft', 'value', tail_number))) AS m"
    return fct.selectExpr(*by, "carrier_key", kinds).selectExpr(*by, "carrier_key", "m.kind", "m.value").where("value IS NOT NULL").distinct()


def routes(fct: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _agg(
        fct, [*by, "route_code", "origin_code", "destination_code", "origin_airport_key", "destination_airport_key"],
        n="count(1)", carriers=CARRIERS, cancelled="count_if(is_cancelled)", arrival_delayed="count_if(is_arrival_delayed)",
        arrival_sum="sum(arrival_delay_minutes)", arrival_n="count(arrival_delay_minutes)",
        air_sum="sum(air_time_minutes)", air_n="count(air_time_minutes)", miles="min(distance_miles)")


def weather_delays(fct: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per condition, band and departure delay: a histogram that carries the counts."""
    from contrail.plans.marts import UNKNOWN_BAND, weather_bands
    narrow = fct.select(*by, "origin_visibility_miles", "origin_precipitation_in", "origin_wind_speed_mph",
                        "is_cancelled", "is_departure_delayed", "departure_delay_minutes")
    stacked = stack_conditions(narrow, weather_bands()).where(f"condition_band != '{UNKNOWN_BAND}'")
    return _agg(stacked, [*by, "condition_type", "condition_band", "departure_delay_minutes"],
                n="count(1)", cancelled="count_if(is_cancelled)", departure_delayed="count_if(is_departure_delayed)")


def daily(fct: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per day and origin; a day lies in one month, so this is final."""
    return _agg(
        fct, [*by, "flight_date", "date_key", "origin_code"],
        n="count(1)", cancelled="count_if(is_cancelled)", departure_delayed="count_if(is_departure_delayed)",
        departure_sum="sum(departure_delay_minutes)", departure_n="count(departure_delay_minutes)",
        departure_max="max(departure_delay_minutes)",
        # Summed as decimals: the order of doubles would show in the rounded mean.
        avg_precipitation_in="CAST(round(avg(CAST(origin_precipitation_in AS DECIMAL(38,20))), 4) AS DOUBLE)",
        min_visibility_miles="min(origin_visibility_miles)", max_wind_speed_mph="max(origin_wind_speed_mph)")


def aircraft(fct: DataFrame) -> DataFrame:
    """Per aircraft and month, the days flown as bits of one number."""
    return _agg(
        with_months(fct.where("tail_number IS NOT NULL")), [*MONTH, "aircraft_key", "tail_number"],
        n="count(1)", days="bit_or(shiftleft(1, day(flight_date) - 1))", carriers=CARRIERS, routes="collect_set(route_code)",
        air_sum="sum(air_time_minutes)", miles="sum(distance_miles)", arrival_sum="sum(arrival_delay_minutes)", arrival_n="count(arrival_delay_minutes)")


def airport_usage(routes: DataFrame) -> DataFrame:
    """``airport_code`` and ``flight_count``, departures and arrivals, from stored routes."""
    return _agg(routes.selectExpr("n", "explode(array(destination_code, origin_code)) AS airport_code"), ["airport_code"], flight_count="sum(n)")


def members_of(routes: DataFrame, aircraft: DataFrame) -> DataFrame:
    """:func:`carrier_members` from stored routes and aircraft."""
    def of(stored: DataFrame, kind: str, value: str) -> DataFrame:
        each = stored.selectExpr("explode(carriers) AS code", f"'{kind}' AS kind", f"{value} AS value")
        return each.select(surrogate_key("code").alias("carrier_key"), "kind", "value")

    both = of(routes, "destination", "destination_code").unionByName(of(aircraft, "aircraft", "tail_number"))
    return both.where("value IS NOT NULL").distinct()


#: Stored by a build: name -> its rows for each month of the fact.
STORED = {
    "carrier_delays": lambda fct: carrier_delays(fct, MONTH),
    "routes": lambda fct: routes(fct, MONTH),
    "weather_delays": lambda fct: weather_delays(fct, MONTH),
    "daily": lambda fct: daily(fct, MONTH),
    "aircraft": aircraft,
}
