"""Loading: properties that hold for any set of files, on the files of conftest.py."""

import datetime as dt
import re
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import FILES, MONTHS, ROWS, write_raw
from contrail.operators import sinks
from contrail.plans.ingest import ingest
from contrail.sources.readers import SOURCES, SOURCES_BY_NAME, Source, read_source

CLOCK = dt.datetime(2024, 1, 1, 12, 0)


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="contrail-wh-")


def read_all(spark, **changed):
    folder = write_raw(tempfile.mkdtemp(prefix="contrail-raw-"), {**FILES, **{k.replace("__", "."): v for k, v in changed.items()}})
    return {s.name: read_source(spark, s, folder) for s in SOURCES}


def months_in(spark, path):
    return {f"{r.year}-{r.month:02d}": r["count"] for r in spark.read.parquet(path).groupBy("year", "month").count().collect()}


def content(df):
    return sorted(map(str, df.collect()))


# --- reading ----------------------------------------------------------------

def test_every_file_row_is_read_once(raw):
    assert {name: df.count() for name, df in raw.items()} == ROWS


def test_declared_types_hold_and_empty_fields_are_null(raw):
    for source in SOURCES:
        assert raw[source.name].dtypes == [(f.name, f.dataType.simpleString()) for f in source.declared_schema().fields]
    cancelled = raw["flights"].where("rownames = 13").first()
    assert (cancelled.dep_time, cancelled.arr_delay, cancelled.tailnum) == (None, None, None)


def test_header_decides_where_a_column_is(spark, raw):
    lines = FILES["airlines.csv"].splitlines()
    turned = "\n".join(",".join((x.split(",")[2], x.split(",")[0], x.split(",")[1])) for x in lines) + "\n"
    assert content(read_all(spark, airlines__csv=turned)["airlines"]) == content(raw["airlines"])


def test_a_missing_column_is_refused(spark):
    with pytest.raises(ValueError, match="carrier"):
        read_all(spark, airlines__csv=FILES["airlines.csv"].replace("carrier", "code"))


@pytest.mark.parametrize(("column", "old", "new"), [("year", "Q1ZQ,2003", "Q1ZQ,20o3"), ("seats", "2,180", "2,1e2")])
def test_a_value_of_the_wrong_type_fails_the_job(spark, column, old, new):
    planes = read_all(spark, planes__csv=FILES["planes.csv"].replace(old, new))["planes"]
    with pytest.raises(PySparkException, match=f"column {column} holds"):
        planes.collect()


def test_headerless_files_quotes_and_null_tokens(raw):
    names = {r.name: r for r in raw["openflights_airlines"].collect()}
    assert names["Aero, Zenith"].callsign == "AERO"
    assert all(r.alias is None for r in names.values())


def test_quoted_line_breaks(spark):
    folder = write_raw(tempfile.mkdtemp(), {"airlines.csv": 'rownames,carrier,name\n1,KV,"Kilo\nVector"\n2,ZQ,"Say ""Z"""\n'})
    source = Source("airlines", "airlines.csv", multiline=True)
    assert sorted(r.name for r in read_source(spark, source, folder).collect()) == ["Kilo\nVector", 'Say "Z"']


def test_inferring_a_new_file(spark, raw_dir):
    assert dict(read_source(spark, SOURCES_BY_NAME["planes"], raw_dir, infer=True).dtypes)["seats"] == "int"


# --- full and monthly replacement ------------------------------------------

def test_loading_twice_equals_loading_once(spark, raw, root):
    first = ingest(spark, raw, root, loaded_at=CLOCK)
    stored = {n: content(sinks.read_raw(spark, f"{root}/{n}")) for n in raw}
    assert ingest(spark, raw, root, loaded_at=CLOCK) == first
    assert {n: content(sinks.read_raw(spark, f"{root}/{n}")) for n in raw} == stored
    assert {n: sum(per.values()) for n, per in first.items()} == ROWS


def test_reloading_a_month_changes_that_month_only(spark, raw, root):
    path = f"{root}/flights"
    assert sinks.load_monthly(spark, raw["flights"], path, MONTHS) == {"2013-07": 3, "2013-11": 3}
    newer = raw["flights"].withColumn("distance", F.col("distance") * 2)
    assert sinks.load_monthly(spark, newer, path, MONTHS[1:]) == {"2013-11": 3}
    sums = {r.month: r.d for r in spark.read.parquet(path).groupBy("month").agg(F.sum("distance").alias("d")).collect()}
    assert sums == {7: 1500, 11: 2 * 1100}


def test_unselected_months_are_not_loaded(spark, raw, root):
    sinks.load_monthly(spark, raw["flights"], f"{root}/flights", MONTHS[:1])
    assert months_in(spark, f"{root}/flights") == {"2013-07": 3}


def test_a_selected_month_without_rows_is_cleared(spark, raw, root):
    path = f"{root}/flights"
    sinks.load_monthly(spark, raw["flights"], path, MONTHS)
    assert sinks.load_monthly(spark, raw["flights"].where("month = 7"), path, MONTHS) == {"2013-07": 3, "2013-11": 0}
    assert months_in(spark, path) == {"2013-07": 3}


def test_a_crash_before_the_commit_keeps_the_old_table(spark, raw, root):
    path = f"{root}/planes"
    sinks.load_full(spark, raw["planes"], path)
    broken = raw["planes"].withColumn("seats", F.raise_error(F.lit("no disk")).cast("bigint"))
    with pytest.raises(PySparkException):
        sinks.load_full(spark, broken, path)
    assert sinks.read_raw(spark, path).count() == ROWS["planes"]
    assert sinks.load_full(spark, raw["planes"].limit(1), path) == 1
    assert len(sinks.versions(spark, path)) == 1


def test_no_scratch_is_left(spark, raw, root):
    from contrail.session import child_names, scratch_dir
    shared = scratch_dir(spark).rsplit("/", 1)[0]
    before = child_names(spark, shared)
    sinks.load_monthly(spark, raw["flights"], f"{root}/flights", MONTHS)
    sinks.load_monthly(spark, raw["flights"].withColumn("gate", F.lit("A")), f"{root}/flights", MONTHS[:1])
    assert child_names(spark, shared) == before


# --- drift --------------------------------------------------------------------

def test_a_new_column_in_the_file_keeps_the_stored_months(spark, raw, root):
    path = f"{root}/flights"
    sinks.load_monthly(spark, raw["flights"], path, MONTHS)
    lines = FILES["flights.csv"].splitlines()
    newer = [lines[0] + ",gate"] + [x + ",G1" for x in lines[1:] if ",2013,11," in x]
    flights = read_all(spark, flights__csv="\n".join(newer) + "\n")["flights"]
    assert flights.columns[-1] == "gate"
    assert sinks.schema_drift(spark.read.parquet(path).schema, flights.schema, ("year", "month")) == ["gate: absent -> string"]
    assert sinks.load_monthly(spark, flights, path, MONTHS[1:]) == {"2013-07": 3, "2013-11": 3}
    gates = {r.month: r.n for r in spark.read.parquet(path).groupBy("month").agg(F.count("gate").alias("n")).collect()}
    assert gates == {7: 0, 11: 3}
    # The next file without that column doesn't take it away.
    sinks.load_monthly(spark, raw["flights"], path, MONTHS[1:])
    assert "gate" in spark.read.parquet(path).columns and months_in(spark, path) == {"2013-07": 3, "2013-11": 3}


def test_an_empty_partitioned_table_has_its_schema(spark, raw, root):
    schema = raw["flights"].schema
    table = sinks.ensure_table(spark, f"{root}/flights", schema, ("year", "month"))
    assert table.count() == 0 and {f.name: f.dataType for f in table.schema} == {f.name: f.dataType for f in schema}
    assert sinks.table_exists(spark, f"{root}/flights")
    assert sinks.load_monthly(spark, raw["flights"], f"{root}/flights", MONTHS) == {"2013-07": 3, "2013-11": 3}
    assert sinks.ensure_table(spark, f"{root}/flights", schema, ("year", "month")).count() == ROWS["flights"]


# --- audit, counts, months, driver program ----------------------------------------

def test_audit_has_a_row_for_each_load(spark, raw, root):
    ingest(spark, raw, root, loaded_at=CLOCK)
    audit = spark.read.parquet(f"{root}/load_audit")
    assert {(r.table_name, r.month) for r in audit.collect()} == {
        (s.name, m) for s in SOURCES for m in (MONTHS if s.monthly else [None])}
    latest = sinks.recent_loads(audit, 4).collect()
    assert len(latest) == 4 and latest[0].loaded_at == max(r.loaded_at for r in audit.collect())


def test_months_are_checked():
    assert sinks.parse_months(["2013-11", " 2013-07", "2013-11"]) == [(2013, 7), (2013, 11)]
    for wrong in ("2013-13", "2013-7", "July"):
        with pytest.raises(ValueError, match=re.escape(repr(wrong))):
            sinks.parse_months([wrong])


def test_table_counts(spark, raw):
    got = sinks.table_counts({n: raw[n] for n in ("planes", "flights")}).collect()
    assert {r.table_name: r.rows for r in got} == {"planes": ROWS["planes"], "flights": ROWS["flights"]}


def test_driver_program(spark, raw_dir, capsys):
    from contrail.__main__ import main
    root = tempfile.mkdtemp(prefix="contrail-cli-")
    run = lambda *words: (main([words[0], "--warehouse", root, *words[1:]]), capsys.readouterr().out)
    code, said = run("status")
    assert code == 0 and root in said
    code, said = run("ingest", "--raw-dir", raw_dir, "--months", ",".join(MONTHS))
    assert code == 0 and f"{ROWS['flights']} rows into flights" in said
    hubs = ("--hubs", "AAB,CCD,EEF")
    with pytest.raises(AssertionError, match="destination_airport_key"):  # nobody knows ZZX
        run("build", *hubs)
    code, said = run("build", "--no-gate", *hubs)
    assert code == 0 and "2 of 106 checks failed" in said
    code, said = run("status")
    assert code == 0 and "planes" in said and MONTHS[1] in said
    with pytest.raises(ValueError):
        run("ingest", "--raw-dir", raw_dir, "--months", "2013-13")


# --- rejects, code generation ---------------------------------------------------

def test_rejects_are_stored_and_limited(spark, root):
    from contrail.operators.rejects import TooManyRejects
    lines = FILES["flights.csv"].splitlines()
    lines[2] = lines[2].replace(",600,", ",far,")
    lines[4] = lines[4].replace(",300,", ",3o0,").replace("-5,1255", "x,1255")
    lines.append("17,2013,7")
    folder = write_raw(tempfile.mkdtemp(), {**FILES, "flights.csv": "\n".join(lines) + "\n"})
    files = {"flights": read_source(spark, SOURCES_BY_NAME["flights"], folder, on_bad="keep")}
    with pytest.raises(TooManyRejects, match="3 rows"):
        ingest(spark, files, root, loaded_at=CLOCK, reject_limit=2)
    assert not sinks.table_exists(spark, f"{root}/flights")
    assert ingest(spark, files, root, loaded_at=CLOCK, reject_limit=3)["flights"] == {"2013-07": 2, "2013-11": 2}
    found = sinks.read_versioned(spark, f"{root}/rejects").collect()
    assert sorted((r.column or "", r.value) for r in found) == [("", "17,2013,7"), ("dep_delay", "x"), ("distance", "3o0"), ("distance", "far")]
    assert {r.file for r in found} == {"flights.csv"} and all(r.record for r in found)
    with pytest.raises(PySparkException):
        read_source(spark, SOURCES_BY_NAME["flights"], folder).collect()


def test_a_load_of_many_months_is_compiled(spark, raw, root, capfd):
    """The filter on months doesn't outgrow what Spark compiles to bytecode."""
    spark.sparkContext.setLogLevel("WARN")
    try:
        months = [f"{y}-{m:02d}" for y in range(2005, 2020) for m in range(1, 13)]
        sinks.load_monthly(spark, raw["flights"], f"{root}/flights", months)
    finally:
        spark.sparkContext.setLogLevel("ERROR")
    said = "".join(capfd.readouterr())
    assert "64 KB" not in said and "Whole-stage codegen disabled" not in said and "Failed to compile" not in said
