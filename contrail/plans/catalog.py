"""Registry of runnable queries over the generated tables.

Each entry is ``name -> callable(spark, sf_dir) -> DataFrame``.  Every query
reads the whole driver tables (through the feed in ``contrail.sources.feed``
or directly), so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.plans.models import Models

Query = Callable[[SparkSession, str], DataFrame]


def _model(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Models.from_driver_tables(spark, sf_dir), name)
    run.__name__ = name
    return run


def _worst_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Models.from_driver_tables(spark, sf_dir).worst_days(10)


MODEL_QUERIES: dict[str, Query] = {
    name: _model(name) for name in (
        "stg_flight", "stg_weather", "stg_plane", "stg_carrier", "stg_airport_reference",
        "stg_airport", "dim_date", "dim_airport", "dim_carrier", "dim_aircraft", "fct_flight",
        "mart_carrier_performance", "mart_route_performance", "mart_weather_impact",
        "mart_daily_operations", "mart_aircraft_utilization", "delay_by_hour", "holiday_effect",
    )
}
MODEL_QUERIES["worst_days"] = _worst_days


def _checks(fn_name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from contrail.plans import checks
        return getattr(checks, fn_name)(Models.from_driver_tables(spark, sf_dir))
    run.__name__ = fn_name
    return run


def _fk_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.operators.quality import relationships
    m = Models.from_driver_tables(spark, sf_dir)
    return relationships(m.fct_flight, "destination_airport_key", m.dim_airport, "airport_key")


def _dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole check catalogue over a materialised build: each model is computed
    once and stored, row-level checks are counted by the job that stores it, the others
    read the stored tables."""
    from contrail.plans import checks
    from contrail.plans.build import Warehouse
    from contrail.session import scratch_dir
    from contrail.sources import feed
    wh = Warehouse(spark, scratch_dir(spark, "wh"), feed.raw_sources(spark, sf_dir), hubs=feed.STATIONS,
                   watched=checks.of_stored_tables(checks.declared_checks(feed.STATIONS)))
    return checks.quality_report(wh)


def _dq_rows(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from contrail.plans import checks
        from contrail.sources.feed import read_driver
        if kind == "unique":
            return checks.duplicate_order_lines(read_driver(spark, sf_dir, "lineitem"))
        m = Models.from_driver_tables(spark, sf_dir)
        if kind == "not_null":
            return checks.flights_without_departure(m)
        if kind == "accepted_values":
            return checks.origins_outside(m, ("CLI", "ERR", "PUR"))
        return checks.implausible_wind(m)
    run.__name__ = f"dq_{kind}_rows"
    return run


CHECK_QUERIES: dict[str, Query] = {
    "dq_unique_rows": _dq_rows("unique"),
    "dq_not_null_rows": _dq_rows("not_null"),
    "dq_accepted_values_rows": _dq_rows("accepted_values"),
    "dq_range_rows": _dq_rows("within_range"),
    "dq_report": _dq_report,
    "dq_cancelled_times": _checks("cancelled_with_planted_times"),
    "dq_reconcile": _checks("planted_fact_gap"),
    "dq_coverage": _checks("weather_coverage_gap"),
    "dq_fk_destination": _fk_destination,
}


def _job(fn_name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from contrail.plans import jobs
        return getattr(jobs, fn_name)(spark, sf_dir)
    run.__name__ = fn_name
    return run


JOB_QUERIES: dict[str, Query] = {
    "incremental_fact": _job("build_fact_incrementally"),
    "monthly_reload": _job("monthly_reload"),
    "full_load_counts": _job("full_load_counts"),
    "audit_recent": _job("audit_recent"),
    "csv_roundtrip": _job("csv_roundtrip"),
    "snap_airport_reference": _job("snapshot_history"),
    "streamed_fact": _job("streamed_fact"),
    "source_files": _job("source_files"),
    "schema_drift_reload": _job("schema_drift_reload"),
    "incremental_correction": _job("incremental_correction"),
    "incremental_null_partition": _job("incremental_null_partition"),
    "full_refresh_fact": _job("full_refresh_fact"),
    "gated_build": _job("gated_build"),
    "rejected_rows": _job("rejected_rows"),
    "seeded_calendar": _job("seeded_calendar"),
    "empty_targets": _job("empty_targets"),
    "audit_now": _job("audit_now"),
}


def _direct(fn_name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from contrail.plans import direct
        return getattr(direct, fn_name)(spark, sf_dir)
    run.__name__ = fn_name
    return run


DIRECT_QUERIES: dict[str, Query] = {
    "lineitem_first_shipment": _direct("first_shipment"),
    "lineitem_bands": _direct("lineitem_bands"),
    "lineitem_best_part": _direct("best_part_per_brand"),
    "lineitem_key_usage": _direct("key_usage"),
    "customer_clean": _direct("customer_clean"),
    "order_clock_minutes": _direct("order_clock_minutes"),
    "order_keys": _direct("order_keys"),
    "clamped_readings": _direct("clamped_readings"),
    "part_size_classes": _direct("part_size_classes"),
}


def queries() -> dict[str, Query]:
    out: dict[str, Query] = dict(MODEL_QUERIES)
    out.update(DIRECT_QUERIES)
    out.update(CHECK_QUERIES)
    out.update(JOB_QUERIES)
    return out
