"""The materialised build: a second build over the same inputs changes no
table (the incremental fact merge is idempotent), and the report covers the
whole catalogue."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from conftest import HUBS, SF_TINY
from contrail.operators.history import read_snapshots
from contrail.operators.sinks import read_raw
from contrail.plans import build as B
from contrail.sources import feed


def snapshot_of(spark, path):
    df = read_snapshots(spark, path) if "snapshots/" in path else read_raw(spark, path)
    rows = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    return sorted(rows, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_second_build_is_a_no_op(spark):
    root = tempfile.mkdtemp(prefix="contrail-build-")
    raw = feed.raw_sources(spark, SF_TINY)
    first = B.build(spark, root, raw, hubs=feed.STATIONS, as_of=dt.datetime(2024, 1, 1), gate=False)
    assert first.report.count() == 106
    tables = ["fct_flight", "dim_date", "dim_airport", "dim_carrier", "dim_aircraft",
              "mart_carrier_performance", "mart_daily_operations", "snapshots/snap_airport_reference"]
    before = {t: snapshot_of(spark, f"{root}/{t}") for t in tables}
    second = B.build(spark, root, feed.raw_sources(spark, SF_TINY), hubs=feed.STATIONS,
                     as_of=dt.datetime(2024, 1, 1), gate=False)
    assert set(second.timings) == {"tables", "checks"}
    for t in tables:
        assert snapshot_of(spark, f"{root}/{t}") == before[t], t
    fact = spark.read.parquet(f"{root}/fct_flight")
    assert fact.count() == fact.select("flight_key").distinct().count()


def test_a_failed_check_publishes_nothing(spark, raw):
    import pytest
    from contrail.operators.sinks import table_exists
    from contrail.session import child_names
    root = tempfile.mkdtemp(prefix="contrail-gate-")
    # the flight to ZZX breaks a dimension foreign key, and the gate is the default
    with pytest.raises(AssertionError, match="destination_airport_key"):
        B.build(spark, root, raw, hubs=HUBS)
    assert not table_exists(spark, f"{root}/fct_flight")
    assert child_names(spark, f"{root}/mart_carrier_performance") == []
    assert read_raw(spark, f"{root}/quality_report").where("violations > 0").count() > 0
    # Without the gate it is published; a later build that fails leaves it as it is.
    B.build(spark, root, raw, hubs=HUBS, gate=False)
    before = {t: snapshot_of(spark, f"{root}/{t}") for t in ("fct_flight", "mart_carrier_performance", "dim_airport")}
    with pytest.raises(AssertionError):
        B.build(spark, root, {**raw, "flights": raw["flights"].withColumn("dep_delay", F.lit(99).cast("bigint"))}, hubs=HUBS, full_refresh=True)
    assert {t: snapshot_of(spark, f"{root}/{t}") for t in before} == before
    assert not [n for t in before for n in child_names(spark, f"{root}/{t}") if n.startswith("_staged")]


def test_an_incremental_build_equals_a_full_one_and_reads_new_months_only(spark, raw):
    flights = raw["flights"]
    root, whole = (tempfile.mkdtemp(prefix="contrail-inc-") for _ in range(2))
    july = {**raw, "flights": flights.where("month = 7")}
    B.build(spark, root, july, hubs=HUBS, gate=False)
    partial = read_raw(spark, f"{root}/partials/daily")
    assert {r.flight_month for r in partial.collect()} == {7}
    second = B.build(spark, root, raw, hubs=HUBS, gate=False)
    B.build(spark, whole, raw, hubs=HUBS, gate=False)
    for t in ("fct_flight", "dim_date", "dim_airport", "dim_aircraft", "mart_carrier_performance", "mart_route_performance",
              "mart_weather_impact", "mart_daily_operations", "mart_aircraft_utilization", "partials/carrier_delays", "partials/aircraft"):
        assert snapshot_of(spark, f"{root}/{t}") == snapshot_of(spark, f"{whole}/{t}"), t
    assert second.warehouse._months and all("flight_month=7" not in m or "2013" in m for m in second.warehouse._months)


def test_a_publication_is_finished_after_a_crash(spark):
    import pytest
    from contrail.operators import publish
    from contrail.session import child_names
    root = tempfile.mkdtemp(prefix="contrail-pub-")
    for t in ("a", "b"):
        spark.range(1).write.parquet(f"{root}/{t}/v1")
    p = publish.Publication(spark, root)
    for t in ("a", "b"):
        spark.range(2).write.parquet(p.stage(f"{root}/{t}"))
        p.put(p._staged[-1], f"{root}/{t}/v2")
        p.drop(f"{root}/{t}/v1")
    calls = []

    def die_after_one(spark, moves):
        publish_apply(spark, moves[:1])
        calls.append(1)
        raise KeyboardInterrupt

    publish_apply = publish._apply
    publish._apply = die_after_one
    try:
        with pytest.raises(KeyboardInterrupt):
            p.commit()
    finally:
        publish._apply = publish_apply
    assert child_names(spark, f"{root}/b") != ["v2"]
    assert publish.recover(spark, root) == 1 and publish.recover(spark, root) == 0
    assert [child_names(spark, f"{root}/{t}") for t in ("a", "b")] == [["v2"], ["v2"]]
    # Nothing is decided before the list of moves is there.
    with publish.Publication(spark, root) as q:
        spark.range(3).write.parquet(q.stage(f"{root}/a"))
    assert child_names(spark, f"{root}/a") == ["v2"]
