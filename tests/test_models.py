"""Every model on the invented network of conftest.py; the expected values are
worked out by hand from the model contracts."""

import datetime as dt

import pytest

from conftest import rows

D = dt.date
FIXED = {
    "stg_flight": (
        ("flight_key", "scheduled_departure_minute", "actual_departure_minute", "actual_arrival_minute", "is_cancelled", "is_diverted"),
        [(11, 545, 565, 705, False, False), (12, 1425, 0, 80, False, False), (13, 420, None, None, True, False),
         (14, 720, 715, 775, False, False), (15, 840, 840, None, False, True), (16, 600, 610, 690, False, False)]),
    "stg_weather": (
        ("origin_code", "temperature_f", "wind_speed_mph", "precipitation_in"),
        [("AAB", 79.0, 25.0, 0.3), ("AAB", None, None, 0.0), ("CCD", 70.0, 9.0, 0.02), ("EEF", 40.0, 21.0, 0.1)]),
    "fct_flight": (
        ("flight_key", "route_code", "scheduled_departure_hour_local", "is_departure_delayed", "is_arrival_delayed",
         "delay_change_in_air_minutes", "origin_temperature_f", "origin_had_precipitation", "origin_had_low_visibility"),
        [(11, "AAB-CCD", 9, True, True, 20, 79.0, True, True), (12, "CCD-AAB", 23, False, False, -25, 70.0, True, False),
         (13, "AAB-EEF", 7, False, False, None, None, False, False), (14, "EEF-AAB", 12, False, False, 0, 40.0, True, False),
         (15, "EEF-XXY", 14, False, False, None, None, False, False), (16, "AAB-ZZX", 10, False, False, -5, None, False, False)]),
    "dim_airport": (
        ("airport_code", "source_system", "flight_count_2013", "is_nyc_origin"),
        [("AAB", "faa_matched_iata", 5, True), ("CCD", "faa_matched_iata", 2, True), ("EEF", "faa_matched_local", 3, True),
         ("XXY", "reference_only", 1, False)]),
    "dim_carrier": (
        ("carrier_code", "carrier_name", "icao_code", "is_active_in_openflights"),
        [("KV", "Kilo Vector", None, False), ("ZQ", "Zenith Quick", "AZQ", True)]),
    "dim_aircraft": (
        ("tail_number", "age_years_in_2013", "size_class", "has_reference_record"),
        [("K2KV", None, "unknown", False), ("Q1ZQ", 10, "narrowbody", True)]),
    "mart_carrier_performance": (
        ("carrier_code", "flight_count", "cancelled_count", "diverted_count", "destination_count", "aircraft_count",
         "cancellation_rate_pct", "arrival_delay_rate_pct", "avg_arrival_delay_minutes", "median_arrival_delay_minutes",
         "p90_arrival_delay_minutes", "avg_delay_change_in_air_minutes", "total_distance_miles"),
        [("KV", 3, 1, 1, 3, 1, 33.33, 0.0, -5.0, -5.0, -5.0, 0.0, 1050),
         ("ZQ", 3, 0, 0, 3, 1, 0.0, 33.33, 11.67, 5.0, 33.0, -3.33, 1550)]),
    "mart_route_performance": (
        ("route_code", "avg_air_time_minutes", "avg_ground_speed_mph", "arrival_delay_rate_pct"),
        [("AAB-CCD", 90.0, 400.0, 100.0), ("AAB-EEF", None, None, 0.0), ("CCD-AAB", 80.0, 450.0, 0.0),
         ("EEF-AAB", 50.0, 360.0, 0.0), ("EEF-XXY", None, None, 0.0)]),
    "mart_weather_impact": (
        ("condition_type", "condition_band", "flight_count", "cancellation_rate_pct", "median_departure_delay_minutes", "p90_departure_delay_minutes"),
        [("precipitation", "heavy precipitation", 1, 0.0, 20.0, 20.0), ("precipitation", "light precipitation", 1, 0.0, 15.0, 15.0),
         ("precipitation", "moderate precipitation", 1, 0.0, -5.0, -5.0), ("precipitation", "no precipitation", 1, 100.0, None, None),
         ("visibility", "visibility 1 to 3 miles", 1, 0.0, 20.0, 20.0), ("visibility", "visibility 10 miles or more", 2, 50.0, -5.0, -5.0),
         ("visibility", "visibility 3 to 10 miles", 1, 0.0, 15.0, 15.0), ("wind", "wind 20 to 30 mph", 2, 0.0, 7.5, 17.5),
         ("wind", "wind under 10 mph", 1, 0.0, 15.0, 15.0)]),
    "mart_daily_operations": (
        ("date_day", "origin_code", "is_holiday", "cancellation_rate_pct", "avg_precipitation_in"),
        [(D(2013, 7, 3), "AAB", False, 0.0, 0.3), (D(2013, 7, 4), "AAB", True, 100.0, 0.0), (D(2013, 7, 4), "CCD", True, 0.0, 0.02),
         (D(2013, 11, 28), "EEF", True, 0.0, 0.1), (D(2013, 11, 29), "AAB", False, 0.0, None)]),
    "mart_aircraft_utilization": (
        ("tail_number", "flight_count", "active_day_count", "flights_per_active_day", "total_air_time_minutes", "total_distance_miles"),
        [("K2KV", 2, 1, 2.0, 50, 750), ("Q1ZQ", 3, 3, 1.0, 230, 1550)]),
    "delay_by_hour": (("scheduled_departure_hour_local", "flight_count"), [(h, 1) for h in (7, 9, 10, 12, 14, 23)]),
    "holiday_effect": (("is_holiday", "flight_count"), [(False, 2), (True, 4)]),
}


@pytest.mark.parametrize("model", sorted(FIXED))
def test_model(models, model):
    columns, expected = FIXED[model]
    assert rows(getattr(models, model), *columns) == expected


def test_instants_become_utc_wall_time(models):
    hours = dict(rows(models.stg_flight, "flight_key", "scheduled_departure_hour_utc"))
    assert hours[11] == dt.datetime(2013, 7, 3, 13) and hours[12] == dt.datetime(2013, 7, 5, 3)


def test_calendar_spans_all_flights(models):
    assert models.dim_date.count() == 150
    assert [d for d, in rows(models.dim_date.where("is_holiday"), "date_day")] == [
        D(2013, 7, 4), D(2013, 9, 2), D(2013, 10, 14), D(2013, 11, 11), D(2013, 11, 28)]
    sunday = models.dim_date.where("date_day = date'2013-07-07'").first()
    assert (sunday.day_of_week, sunday.day_name, sunday.month_name, sunday.is_weekend) == (0, "Sunday", "July", True)


def test_holidays_by_rule_equal_the_seed(spark):
    from contrail.sources.readers import holidays_for_years, read_seed
    years = spark.createDataFrame([(2013,)], "year int")
    assert rows(holidays_for_years(years), "holiday_date", "holiday_name") == rows(read_seed(spark), "holiday_date", "holiday_name")
    last = rows(holidays_for_years(spark.createDataFrame([(2021,)], "year int")).where("holiday_name = 'Memorial Day'"), "holiday_date")
    assert last == [(D(2021, 5, 31),)]


def test_fact_has_all_its_columns(models):
    assert len(models.fct_flight.columns) == 34


def test_worst_day(models):
    assert [(r.origin_code, r.cancellation_rate_pct) for r in models.worst_days(1).collect()] == [("AAB", 100.0)]
