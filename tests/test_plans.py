"""Plan-shape guards for the scale properties the README claims."""

import datetime as dt
import re
import tempfile

import pytest

from pyspark.sql import functions as F

from conftest import SF_TINY
from contrail.plans.catalog import queries


def plan_of(df) -> str:
    """The physical plan of a fresh execution of ``df`` (after a run AQE prints
    its final and initial plans both)."""
    text = df.select("*")._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_weather_unpivot_is_one_scan_with_a_generator(spark):
    plan = plan_of(queries()["mart_weather_impact"](spark, SF_TINY))
    assert plan.count("orders.parquet") == 1          # no scan per UNION arm
    assert "Generate explode" in plan


def test_fact_scan_reads_only_needed_columns(spark):
    plan = plan_of(queries()["mart_carrier_performance"](spark, SF_TINY))
    schema = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*orders\.parquet", plan).group(1)
    assert len(schema.split(",")) <= 3                 # orders has 6 columns


def test_weather_dedup_combines_before_the_shuffle(spark):
    plan = plan_of(queries()["stg_weather"](spark, SF_TINY))
    assert "partial_min" in plan and "Window" not in plan
    assert "Exchange hashpartitioning(origin_code" in plan


@pytest.mark.parametrize("name", ["mart_carrier_performance", "mart_route_performance", "mart_aircraft_utilization",
                                  "delay_by_hour", "holiday_effect"])
def test_no_weather_is_read_where_none_is_used(spark, name):
    scans = [line for line in plan_of(queries()[name](spark, SF_TINY)).splitlines() if "FileScan" in line and "events.parquet" in line]
    # The airports' station list reads the event type, and nothing else of it.
    assert all(line.split("ReadSchema: ")[1].startswith("struct<event_type:string>") for line in scans)


@pytest.mark.parametrize("name", ["mart_carrier_performance", "mart_route_performance", "mart_aircraft_utilization"])
def test_distinct_counts_expand_no_fact(spark, name):
    assert "Expand" not in plan_of(queries()[name](spark, SF_TINY))


def test_orphans_are_found_by_distinct_keys(spark):
    plan = plan_of(queries()["dq_fk_destination"](spark, SF_TINY))
    anti = plan.index("LeftAnti")
    # Below the anti join the child is reduced to its keys.
    assert "HashAggregate(keys=[_child_key" in plan[anti:] and "LeftSemi" in plan


def test_the_stored_weather_is_broadcast_to_the_fact(spark, raw):
    from contrail.plans.build import Warehouse
    from contrail.plans import warehouse
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="contrail-wx-"), raw)
    plan = plan_of(warehouse.fct_flight(wh.stg_flight, wh.stg_weather))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_a_query_sees_files_that_come_later(spark):
    import shutil
    folder = tempfile.mkdtemp(prefix="contrail-later-")
    for t in ("orders", "events"):
        spark.read.parquet(f"{SF_TINY}/{t}.parquet").limit(20).write.parquet(f"{folder}/{t}.parquet")
    for t in ("region", "nation", "customer", "supplier", "part", "lineitem"):
        shutil.copy(f"{SF_TINY}/{t}.parquet", f"{folder}/{t}.parquet")
    assert queries()["stg_flight"](spark, folder).count() == 20
    spark.read.parquet(f"{SF_TINY}/orders.parquet").limit(5).write.mode("append").parquet(f"{folder}/orders.parquet")
    assert queries()["stg_flight"](spark, folder).count() == 25


def test_marts_aggregate_before_the_dimension_join(spark):
    plan = plan_of(queries()["mart_route_performance"](spark, SF_TINY))
    join = plan.index("Join")
    assert plan.find("HashAggregate", join) > 0        # the aggregate sits below the join


def test_incremental_read_prunes_raw_month_partitions(spark, raw):
    from contrail.operators.incremental import months_from
    from contrail.plans.ingest import ingest
    from contrail.plans.staging import stg_flight
    root = tempfile.mkdtemp(prefix="contrail-plan-")
    ingest(spark, raw, root)
    mark = dt.date(2013, 11, 28)
    df = stg_flight(spark.read.parquet(f"{root}/flights").where(months_from(mark))) \
        .where(F.col("flight_date") >= F.lit(mark))
    scan = [line for line in plan_of(df).splitlines() if "FileScan" in line][0]
    assert re.search(r"PartitionFilters: \[[^\]]*year", scan)
    assert df.count() == 3
