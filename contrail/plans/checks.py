"""The declared check catalogue of the warehouse and its singular checks.

Table names are those of ``contrail.plans.models.Models`` plus ``raw.<source>``
for the raw inputs.  ``hubs`` are the accepted origin codes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators import quality as Q
from contrail.operators.quality import Check
from contrail.plans.models import Models
from contrail.plans.staging import MATCHED_IATA, MATCHED_LOCAL, REFERENCE_ONLY, UNMATCHED
from contrail.plans.warehouse import SIZE_OTHERWISE, SIZE_UNKNOWN

# Accepted labels.
SIZE_CLASS_VALUES = ("regional", "narrowbody", SIZE_OTHERWISE, SIZE_UNKNOWN)
SOURCE_SYSTEM_VALUES = (MATCHED_IATA, MATCHED_LOCAL, UNMATCHED, REFERENCE_ONLY)
CONDITION_TYPES = ("visibility", "precipitation", "wind")
MIN_WEATHER_COVERAGE_PCT = 99.0


def _un(table: str, col: str, where: str | None = None) -> list[Check]:
    return [Check(table, "unique", col, where=where), Check(table, "not_null", col)]


def declared_checks(hubs: Sequence[str]) -> list[Check]:
    hubs = tuple(hubs)
    c: list[Check] = []
    # raw sources
    c += _un("raw.flights", "rownames") + [Check("raw.flights", "not_null", "carrier"),
                                           Check("raw.flights", "not_null", "origin"),
                                           Check("raw.flights", "accepted_values", "origin", values=hubs)]
    c += [Check("raw.weather", "not_null", "origin"), Check("raw.weather", "not_null", "time_hour")]
    c += _un("raw.planes", "tailnum") + _un("raw.airlines", "carrier") + _un("raw.airports", "faa")
    c += _un("raw.ourairports_airports", "id") + _un("raw.ourairports_airports", "ident")
    c += _un("raw.openflights_airlines", "airline_id")
    # staging
    c += _un("stg_flight", "flight_key") + [
        Check("stg_flight", "not_null", "flight_date"),
        Check("stg_flight", "not_null", "carrier_code"),
        Check("stg_flight", "relationships", "carrier_code", parent="stg_carrier", parent_field="carrier_code"),
        Check("stg_flight", "not_null", "origin_code"),
        Check("stg_flight", "not_null", "scheduled_departure_minute"),
        Check("stg_flight", "within_range", "scheduled_departure_minute", lo=0, hi=1439),
        Check("stg_flight", "non_negative", "distance_miles"),
        Check("stg_flight", "non_negative", "air_time_minutes"),
    ]
    c += [Check("stg_weather", "unique", "concat(origin_code, cast(observed_hour_utc as string))",
                label="unique__stg_weather__origin_code_observed_hour_utc"),
          Check("stg_weather", "not_null", "origin_code"),
          Check("stg_weather", "not_null", "observed_hour_utc"),
          Check("stg_weather", "within_range", "wind_speed_mph", lo=0, hi=200,
                where="wind_speed_mph is not null")]
    c += _un("stg_plane", "tail_number") + [
        Check("stg_plane", "non_negative", "seat_count"),
        Check("stg_plane", "within_range", "manufactured_year", lo=1950, hi=2013,
              where="manufactured_year is not null")]
    c += _un("stg_carrier", "carrier_code") + [Check("stg_carrier", "not_null", "carrier_name")]
    c += _un("stg_airport_reference", "ident") + [
        Check("stg_airport_reference", "unique", "iata_code", where="iata_code is not null")]
    c += _un("stg_airport", "airport_code") + [
        Check("stg_airport", "accepted_values", "source_system", values=SOURCE_SYSTEM_VALUES),
        Check("stg_airport", "within_range", "latitude", lo=-90, hi=90),
        Check("stg_airport", "within_range", "longitude", lo=-180, hi=180)]
    # warehouse
    c += _un("dim_date", "date_key") + _un("dim_date", "date_day") + [
        Check("dim_date", "within_range", "calendar_month", lo=1, hi=12)]
    c += _un("dim_airport", "airport_key") + _un("dim_airport", "airport_code") + [
        Check("dim_airport", "not_null", "airport_name"),
        Check("dim_airport", "non_negative", "flight_count_2013")]
    c += _un("dim_carrier", "carrier_key") + _un("dim_carrier", "carrier_code")
    c += _un("dim_aircraft", "aircraft_key") + _un("dim_aircraft", "tail_number") + [
        Check("dim_aircraft", "accepted_values", "size_class", values=SIZE_CLASS_VALUES),
        Check("dim_aircraft", "non_negative", "age_years_in_2013", where="age_years_in_2013 is not null")]
    c += _un("fct_flight", "flight_key")
    for col, parent, pf in (("date_key", "dim_date", "date_key"), ("carrier_key", "dim_carrier", "carrier_key"),
                            ("origin_airport_key", "dim_airport", "airport_key"),
                            ("destination_airport_key", "dim_airport", "airport_key")):
        c += [Check("fct_flight", "not_null", col),
              Check("fct_flight", "relationships", col, parent=parent, parent_field=pf)]
    c += [Check("fct_flight", "relationships", "aircraft_key", parent="dim_aircraft", parent_field="aircraft_key",
                where="tail_number is not null"),
          Check("fct_flight", "non_negative", "distance_miles"),
          Check("fct_flight", "within_range", "scheduled_departure_hour_local", lo=0, hi=23)]
    # marts
    c += _un("mart_carrier_performance", "carrier_code") + [
        Check("mart_carrier_performance", "non_negative", "flight_count"),
        Check("mart_carrier_performance", "within_range", "cancellation_rate_pct", lo=0, hi=100),
        Check("mart_carrier_performance", "within_range", "arrival_delay_rate_pct", lo=0, hi=100)]
    c += _un("mart_route_performance", "route_code") + [
        Check("mart_route_performance", "not_null", "destination_name"),
        Check("mart_route_performance", "within_range", "cancellation_rate_pct", lo=0, hi=100),
        Check("mart_route_performance", "within_range", "avg_ground_speed_mph", lo=50, hi=800,
              where="avg_ground_speed_mph is not null")]
    c += [Check("mart_weather_impact", "unique", "concat(condition_type, condition_band)",
                label="unique__mart_weather_impact__condition_type_condition_band"),
          Check("mart_weather_impact", "accepted_values", "condition_type", values=CONDITION_TYPES),
          Check("mart_weather_impact", "within_range", "departure_delay_rate_pct", lo=0, hi=100)]
    c += [Check("mart_daily_operations", "unique", "concat(cast(date_day as string), origin_code)",
                label="unique__mart_daily_operations__date_day_origin_code"),
          Check("mart_daily_operations", "not_null", "date_day"),
          Check("mart_daily_operations", "not_null", "origin_code"),
          Check("mart_daily_operations", "accepted_values", "origin_code", values=hubs),
          Check("mart_daily_operations", "non_negative", "flight_count")]
    c += _un("mart_aircraft_utilization", "tail_number") + [
        Check("mart_aircraft_utilization", "within_range", "flights_per_active_day", lo=1, hi=30)]
    return c


def check_level(table: str) -> int:
    """Build level a checked table belongs to: 0 raw inputs and staging views,
    1 dimensions and fact (and the airports, which take flights' endpoints), 2 marts."""
    if table.startswith("raw.") or table.startswith("stg_") and table != "stg_airport":
        return 0
    return 2 if table.startswith("mart_") else 1


def tables_for(m: Models, cat: Sequence[Check]) -> dict[str, DataFrame]:
    """Only the tables (and foreign-key parents) the given checks read."""
    names = {c.table for c in cat} | {c.parent for c in cat if c.parent}
    return {n: (m.raw[n[4:]] if n.startswith("raw.") else getattr(m, n)) for n in names}


def check_tables(m: Models) -> dict[str, DataFrame]:
    tables = {f"raw.{k}": v for k, v in m.raw.items()}
    for name in ("stg_flight", "stg_weather", "stg_plane", "stg_carrier", "stg_airport_reference",
                 "stg_airport", "dim_date", "dim_airport", "dim_carrier", "dim_aircraft", "fct_flight",
                 "mart_carrier_performance", "mart_route_performance", "mart_weather_impact",
                 "mart_daily_operations", "mart_aircraft_utilization"):
        tables[name] = getattr(m, name)
    return tables


def of_stored_tables(catalogue: Sequence[Check]) -> dict[str, list[Check]]:
    """The checks of each table that a build stores."""
    out: dict[str, list[Check]] = {}
    for c in catalogue:
        if check_level(c.table) > 0 or c.table == "stg_weather":
            out.setdefault(c.table, []).append(c)
    return out


def quality_report(m: Models, threads: int = 8) -> DataFrame:
    """The whole catalogue.  Row-level checks that the jobs which wrote the tables have
    counted (a ``Warehouse`` that was asked to) aren't scanned for again."""
    catalogue, tables = declared_checks(m.hubs), check_tables(m)
    counted = getattr(m, "observed", {})
    left = [c for c in catalogue if c.kind not in Q.ROW_LEVEL or c.table not in counted]
    rows = Q.count_checks(left, tables, threads)
    rows += [row for name, seen in counted.items() for row in seen.rows(tables[name])]
    return Q.report_of(next(iter(tables.values())).sparkSession, rows)


def cancelled_with_times(m: Models, fact: DataFrame | None = None) -> DataFrame:
    return Q.assert_implies_null(m.fct_flight if fact is None else fact, "is_cancelled",
                                 ["actual_departure_minute", "arrival_delay_minutes"], "flight_key")


def fact_count_mismatch(m: Models, fact: DataFrame | None = None) -> DataFrame:
    return Q.reconcile_counts(m.raw["flights"], m.fct_flight if fact is None else fact)


SINGULAR = ("cancelled_flights_have_no_times", "every_flight_is_in_the_fact", "weather_covers_the_flights")


def singular_checks(m: Models) -> dict[str, DataFrame]:
    """The checks that need more than a rule on one column: name -> violating rows."""
    return dict(zip(SINGULAR, (cancelled_with_times(m), fact_count_mismatch(m), weather_coverage_gap(m)), strict=True))


# Facts with planted faults, so that the checks are seen finding them.

def cancelled_with_planted_times(m: Models) -> DataFrame:
    wrong = F.col("is_cancelled") & (F.col("flight_key") % 2 == 0)
    return cancelled_with_times(m, m.fct_flight.withColumn(
        "actual_departure_minute", F.when(wrong, F.lit(77)).otherwise(F.col("actual_departure_minute")).cast("bigint")))


def planted_fact_gap(m: Models) -> DataFrame:
    return fact_count_mismatch(m, m.fct_flight.where(F.col("flight_key") % 13 != 0))


def weather_coverage_gap(m: Models) -> DataFrame:
    return Q.assert_coverage(m.fct_flight, "origin_temperature_f", MIN_WEATHER_COVERAGE_PCT)


# Checks returning the violating rows themselves, on inputs where violations
# occur naturally (repeated line numbers, cancelled flights, outlying readings).

def duplicate_order_lines(lineitem: DataFrame) -> DataFrame:
    return Q.unique(lineitem, "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))")


def flights_without_departure(m: Models) -> DataFrame:
    return Q.not_null(m.stg_flight, "actual_departure_minute").select(
        "flight_key", "flight_date", "origin_code", "is_cancelled")


def origins_outside(m: Models, accepted: Sequence[str]) -> DataFrame:
    return Q.accepted_values(m.raw["flights"], "origin", accepted).select("rownames", "origin")


def implausible_wind(m: Models) -> DataFrame:
    return Q.within_range(m.raw["weather"], "wind_speed", 0, 200).select("rownames", "origin", "wind_speed")
