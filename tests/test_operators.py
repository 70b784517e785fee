"""Edge cases of the conformance, dedup and anti-join operators, and the
streaming ingester's exactly-once file handling."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from contrail.operators.dedup import dedup_first
from contrail.operators.joins import where_not_in
from contrail.operators.reshape import distinct_members
from contrail.plans import staging

REF = ("id bigint, ident string, type string, name string, latitude_deg double, longitude_deg double, "
       "elevation_ft bigint, continent string, iso_country string, iso_region string, municipality string, "
       "scheduled_service string, icao_code string, iata_code string, gps_code string, local_code string, "
       "home_link string, wikipedia_link string, keywords string")
AIRPORTS = "rownames bigint, faa string, name string, lat double, lon double, alt bigint, tz bigint, dst string, tzone string"


def ref_row(i, ident, iata, local, town):
    return (i, ident, "small_airport", f"Field {ident}", 1.0, 2.0, 3, "NA", "US", "US-XX", town, "no",
            None, iata, None, local, None, None, None)


def test_two_tier_conformance_and_gap_fill(spark):
    reference = staging.stg_airport_reference(spark.createDataFrame([
        ref_row(1, "K001", "AAA", None, "Alpha"),
        ref_row(2, "X002", None, "BBB", "Second pick"),      # two local candidates for BBB ...
        ref_row(3, "X001", None, "BBB", "First pick"),       # ... lowest ident wins
        ref_row(4, "K004", "BBB", None, "Has IATA"),          # IATA rows never count as local candidates
        ref_row(5, "K005", "ZZZ", None, "Only in reference"),
    ], REF))
    airports = spark.createDataFrame([
        (1, "AAA", "A", 0.0, 0.0, 1, -5, "A", "t"), (2, "CCC", "C", 0.0, 0.0, 1, -5, "A", "t"),
        (3, "DDD", "D", 0.0, 0.0, 1, -5, "A", "t")], AIRPORTS)
    # make BBB reachable by local code only: drop its IATA row from the reference
    reference = reference.where(F.col("ident") != "K004")
    airports = airports.unionByName(spark.createDataFrame([(4, "BBB", "B", 0.0, 0.0, 1, -5, "A", "t")], AIRPORTS))
    flights = spark.createDataFrame([("AAA", "ZZZ"), ("BBB", "QQQ")], "origin_code string, destination_code string")
    endpoints = distinct_members(flights, ["origin_code", "destination_code"], "airport_code")
    out = {r.airport_code: (r.source_system, r.municipality) for r in
           staging.stg_airport(airports, reference, endpoints).collect()}
    assert out == {"AAA": ("faa_matched_iata", "Alpha"), "BBB": ("faa_matched_local", "First pick"),
                   "CCC": ("faa_only", None), "DDD": ("faa_only", None),
                   "ZZZ": ("reference_only", "Only in reference")}   # QQQ: known nowhere, not added


def test_not_in_is_null_aware(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",)], "k2 string")
    assert [r.k for r in where_not_in(left, "k", right, "k2").collect()] == ["b"]
    with_null = spark.createDataFrame([("a",), (None,)], "k2 string")
    assert where_not_in(left, "k", with_null, "k2").count() == 0


def test_dedup_prefers_non_null_and_is_deterministic(spark):
    df = spark.createDataFrame([("EWR", 1, None, "x"), ("EWR", 1, 40.0, "y"), ("EWR", 1, 40.0, "a"),
                                ("JFK", 1, None, "z")], "st string, h int, temp double, other string")
    out = sorted(tuple(r) for r in dedup_first(df, ["st", "h"], [F.col("temp").asc_nulls_last()]).collect())
    assert out == [("EWR", 1, 40.0, "a"), ("JFK", 1, None, "z")]


def test_diverted_and_edge_delays(spark, raw):
    extra = spark.createDataFrame(
        [(4, 2013, 1, 3, 600, 600, 15, None, 900, None, "UA", 1, " ", "EWR", "IAH", None, 1400, 6, 0,
          dt.datetime(2013, 1, 3, 11)),
         (5, 2013, 1, 3, 616, 600, 16, 930, 900, 16, "UA", 1, "", "EWR", "IAH", 200, 1400, 6, 0,
          dt.datetime(2013, 1, 3, 11))], raw["flights"].schema)
    rows = {r.flight_key: r for r in staging.stg_flight(extra).collect()}
    assert rows[4].is_diverted and not rows[4].is_cancelled and rows[4].tail_number is None
    assert rows[5].tail_number is None
    from contrail.plans.warehouse import fct_flight
    weather = staging.stg_weather(raw["weather"])
    fact = {r.flight_key: r for r in fct_flight(staging.stg_flight(extra), weather).collect()}
    assert (fact[4].is_departure_delayed, fact[5].is_departure_delayed) == (False, True)
    assert fact[4].aircraft_key == "76609817ef09e965e8a38a96c0603756"   # NULL tail -> missing-token key


def test_streaming_ingest_processes_each_file_once(spark):
    from contrail.streaming import ingest_available
    root = tempfile.mkdtemp(prefix="contrail-stream-")
    schema = "k bigint, d date, v string, y int, m int"
    spark.createDataFrame([(1, dt.date(2013, 1, 1), "a", 2013, 1)], schema).write.mode("append").parquet(f"{root}/in")
    args = (f"{root}/in", spark.createDataFrame([], schema).schema, f"{root}/out", f"{root}/ckpt", ["k"], ["y", "m"])
    assert ingest_available(spark, *args) == 1
    assert ingest_available(spark, *args) == 0          # nothing new: no batch, offsets kept
    spark.createDataFrame([(1, dt.date(2013, 1, 1), "A", 2013, 1), (2, dt.date(2013, 2, 1), "b", 2013, 2)],
                          schema).write.mode("append").parquet(f"{root}/in")
    assert ingest_available(spark, *args) == 1
    out = sorted((r.k, r.v) for r in spark.read.parquet(f"{root}/out").collect())
    assert out == [(1, "A"), (2, "b")]
