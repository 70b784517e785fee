"""The model graph: raw sources -> staging -> star schema -> marts.

``Models`` holds lazy DataFrames only (no data is cached), so every model is a
plan that Catalyst optimises end to end — column pruning reaches the Parquet
scans of the raw tables.  ``contrail.plans.build`` materialises the same graph
table by table for production runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from contrail.operators import reshape
from contrail.plans import analyses, marts, staging, warehouse
from contrail.sources import feed


class Models:
    """Lazy model graph over a mapping of raw source DataFrames."""

    #: Whether marts come sorted; tables that are stored are not.
    ordered = True

    def __init__(self, raw: Mapping[str, DataFrame], holidays: DataFrame | None = None,
                 hubs: Sequence[str] = warehouse.DEFAULT_HUBS,
                 as_of_year: int = warehouse.DEFAULT_AS_OF_YEAR):
        self.raw = raw
        self._holidays = holidays
        self.hubs = tuple(hubs)
        self.as_of_year = as_of_year

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str) -> "Models":
        """The graph over the generated tables (see ``contrail.sources.feed``):
        hubs are the feed's stations; holidays are the federal holidays of every
        year the flights span."""
        return cls(feed.raw_sources(spark, sf_dir), holidays=None, hubs=feed.STATIONS)

    def _model(self, name: str, build) -> DataFrame:
        """Hook for materialisation; the lazy graph just returns the plan."""
        return build()

    # staging -----------------------------------------------------------
    @cached_property
    def stg_flight(self) -> DataFrame:
        return self._model("stg_flight", lambda: staging.stg_flight(self.raw["flights"]))

    @cached_property
    def stg_weather(self) -> DataFrame:
        return self._model("stg_weather", lambda: staging.stg_weather(self.raw["weather"]))

    @cached_property
    def stg_plane(self) -> DataFrame:
        return self._model("stg_plane", lambda: staging.stg_plane(self.raw["planes"]))

    @cached_property
    def stg_carrier(self) -> DataFrame:
        return self._model("stg_carrier", lambda: staging.stg_carrier(self.raw["airlines"], self.raw["openflights_airlines"]))

    @cached_property
    def stg_airport_reference(self) -> DataFrame:
        return self._model("stg_airport_reference", lambda: staging.stg_airport_reference(self.raw["ourairports_airports"]))

    @cached_property
    def stg_airport(self) -> DataFrame:
        return self._model("stg_airport", lambda: staging.stg_airport(self.raw["airports"], self.stg_airport_reference, self.endpoints))

    # what the dimensions take from the flights (a build has it stored) ------
    @cached_property
    def flight_days(self) -> DataFrame:
        return self.stg_flight.select("flight_date")

    @cached_property
    def tails(self) -> DataFrame:
        return self.stg_flight.select("tail_number")

    @cached_property
    def endpoints(self) -> DataFrame:
        return reshape.distinct_members(self.stg_flight, ["origin_code", "destination_code"], "airport_code")

    @cached_property
    def airport_usage(self) -> DataFrame:
        return reshape.usage_totals(self.stg_flight, ["destination_code", "origin_code"], "airport_code")

    # warehouse ---------------------------------------------------------
    @cached_property
    def holidays(self) -> DataFrame | None:
        """The holiday seed, or None: then ``dim_date`` generates the
        federal holidays of the years it spans."""
        return self._holidays

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._model("dim_date", lambda: warehouse.dim_date(self.flight_days, self.holidays))

    @cached_property
    def dim_airport(self) -> DataFrame:
        return self._model("dim_airport", lambda: warehouse.dim_airport(self.stg_airport, self.airport_usage, self.hubs))

    @cached_property
    def dim_carrier(self) -> DataFrame:
        return self._model("dim_carrier", lambda: warehouse.dim_carrier(self.stg_carrier))

    @cached_property
    def dim_aircraft(self) -> DataFrame:
        return self._model("dim_aircraft", lambda: warehouse.dim_aircraft(self.tails, self.stg_plane, self.as_of_year))

    @cached_property
    def fct_flight(self) -> DataFrame:
        return self._model("fct_flight", lambda: warehouse.fct_flight(self.stg_flight, self.stg_weather))

    # marts -------------------------------------------------------------
    @cached_property
    def mart_carrier_performance(self) -> DataFrame:
        return self._model("mart_carrier_performance", lambda: marts.mart_carrier_performance(self.fct_flight, self.dim_carrier, ordered=self.ordered))

    @cached_property
    def mart_route_performance(self) -> DataFrame:
        return self._model("mart_route_performance", lambda: marts.mart_route_performance(self.fct_flight, self.dim_airport, ordered=self.ordered))

    @cached_property
    def mart_weather_impact(self) -> DataFrame:
        return self._model("mart_weather_impact", lambda: marts.mart_weather_impact(self.fct_flight, ordered=self.ordered))

    @cached_property
    def mart_daily_operations(self) -> DataFrame:
        return self._model("mart_daily_operations", lambda: marts.mart_daily_operations(self.fct_flight, self.dim_date, ordered=self.ordered))

    @cached_property
    def mart_aircraft_utilization(self) -> DataFrame:
        return self._model("mart_aircraft_utilization", lambda: marts.mart_aircraft_utilization(self.fct_flight, self.dim_aircraft, ordered=self.ordered))

    # analyses ----------------------------------------------------------
    @cached_property
    def delay_by_hour(self) -> DataFrame:
        return self._model("delay_by_hour", lambda: analyses.delay_by_hour(self.fct_flight))

    @cached_property
    def holiday_effect(self) -> DataFrame:
        return self._model("holiday_effect", lambda: analyses.holiday_effect(self.fct_flight, self.dim_date))

    def worst_days(self, n: int = 10) -> DataFrame:
        return analyses.worst_days(self.mart_daily_operations, n)


MODEL_NAMES = (
    "stg_flight", "stg_weather", "stg_plane", "stg_carrier", "stg_airport_reference", "stg_airport",
    "dim_date", "dim_airport", "dim_carrier", "dim_aircraft", "fct_flight",
    "mart_carrier_performance", "mart_route_performance", "mart_weather_impact",
    "mart_daily_operations", "mart_aircraft_utilization",
)
