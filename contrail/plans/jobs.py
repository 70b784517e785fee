"""Write-path jobs over the generated tables: loading, incremental fact
maintenance, snapshots.  Each writes under a fresh folder below the shared
checkpoint root and returns a scan of what it wrote, so the registered query
checks the stored state, not just the plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators import sinks
from contrail.operators.history import write_snapshot
from contrail.operators.incremental import incremental_filter, write_incremental
from contrail.plans import warehouse
from contrail.plans.build import FACT_PARTITIONS, SNAPSHOT_CHECK_COLS, SNAPSHOT_COLS
from contrail.plans.models import Models
from contrail.session import scratch_dir
from contrail.sources import feed
from contrail.sources.readers import SOURCES_BY_NAME, read_source

# Injected clock for audit and snapshot timestamps, so reruns are comparable.
AUDIT_CLOCK = dt.datetime(2024, 2, 1, 6, 0, 0)
SNAPSHOT_TIMES = (dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1))
INCREMENTAL_CUTOFF = dt.date(1998, 6, 30)
RELOAD_MONTH = "1998-02"
DROPPED_MONTH = "1999-03"


def with_fact_partitions(fct: DataFrame) -> DataFrame:
    return fct.withColumns({"flight_year": F.year("flight_date"), "flight_month": F.month("flight_date")})


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*warehouse.FACT_COLUMNS)


def build_fact_incrementally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the incremental fact: a first run over flights up to a
    cut-off date (with wrong delays on the cut-off day), then a run over the
    full feed that only takes rows on or after the stored maximum date and
    replaces them by key.  The stored table must equal a full build."""
    m = Models.from_driver_tables(spark, sf_dir)
    path = scratch_dir(spark, "fact") + "/fct_flight"
    first = m.stg_flight.where(F.col("flight_date") <= F.lit(INCREMENTAL_CUTOFF))
    first = first.withColumn(
        "departure_delay_minutes",
        F.when(F.col("flight_date") == F.lit(INCREMENTAL_CUTOFF), F.col("departure_delay_minutes") + 1000)
         .otherwise(F.col("departure_delay_minutes")))
    write_incremental(spark, with_fact_partitions(warehouse.fct_flight(first, m.stg_weather)), path,
                      ["flight_key"], FACT_PARTITIONS, fixed_partition=True)
    replay = incremental_filter(m.stg_flight, spark.read.parquet(path), "flight_date",
                                partition_cols=FACT_PARTITIONS)
    write_incremental(spark, with_fact_partitions(warehouse.fct_flight(replay, m.stg_weather)), path,
                      ["flight_key"], FACT_PARTITIONS)
    return read_fact(spark, path)


def monthly_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every month of the flight feed, then reload two months from a
    newer file in which one month has no rows any more: that month is
    cleared, the reloaded month is replaced, all others are untouched."""
    root = scratch_dir(spark, "raw")
    path = f"{root}/flights"
    flights = feed.flights(feed.read_driver(spark, sf_dir, "orders"))
    sinks.load_monthly(spark, flights, path)
    dropped_y, dropped_m = (int(x) for x in DROPPED_MONTH.split("-"))
    newer = flights.where(~((F.col("year") == dropped_y) & (F.col("month") == dropped_m)))
    # Corrected distances in the newer file: only the reloaded month may show them.
    newer = newer.withColumn("distance", F.col("distance") + 7)
    sinks.load_monthly(spark, newer, path, [RELOAD_MONTH, DROPPED_MONTH])
    table = spark.read.parquet(path)
    return (table.groupBy(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))
                 .agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.sum("distance").cast("bigint").alias("distance")))


def schema_drift_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month is reloaded from a file that has one more column and holds no
    other month: the stored months stay, without a value in the new column."""
    root = scratch_dir(spark, "drift")
    path = f"{root}/flights"
    flights = feed.flights(feed.read_driver(spark, sf_dir, "orders"))
    sinks.load_monthly(spark, flights, path)
    y, m = (int(x) for x in RELOAD_MONTH.split("-"))
    newer = flights.where((F.col("year") == y) & (F.col("month") == m)).withColumn("gate", F.col("rownames") % 10)
    sinks.load_monthly(spark, newer, path, [RELOAD_MONTH])
    return (spark.read.parquet(path).groupBy(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.count("gate").cast("bigint").alias("gates"),
                 F.sum("gate").cast("bigint").alias("gate_sum")))


def _order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.read_driver(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("order_key"), F.col("o_totalprice").cast("double").alias("price"),
        F.lit(1).cast("bigint").alias("revision"), (F.col("o_orderkey") % 7).cast("int").alias("bucket"))


def incremental_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch holds rows and their corrections (a later revision, in another
    partition): each key is stored once, as its latest revision has it."""
    path = scratch_dir(spark, "fix") + "/orders"
    orders = _order_table(spark, sf_dir)
    write_incremental(spark, orders, path, ["order_key"], ["bucket"])
    late = orders.where("order_key % 5 = 0")
    fixed = late.withColumns({"revision": F.col("revision") + 1, "price": F.col("price") + 1000,
                              "bucket": F.pmod(F.col("bucket") + 1, F.lit(7)).cast("int")})
    write_incremental(spark, late.unionByName(fixed), path, ["order_key"], ["bucket"], latest_by=["revision"])
    return spark.read.parquet(path).select("order_key", F.col("price").cast("double"), "revision", F.col("bucket").cast("bigint").alias("bucket"))


def incremental_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a partition value: a batch that touches the NULL partition
    keeps the rows it doesn't replace there."""
    path = scratch_dir(spark, "nulls") + "/orders"
    orders = _order_table(spark, sf_dir).withColumn("bucket", F.when(F.col("bucket") > 1, F.col("bucket")))
    write_incremental(spark, orders, path, ["order_key"], ["bucket"])
    late = orders.where("bucket is null and order_key % 3 = 0").withColumn("revision", F.col("revision") + 1)
    write_incremental(spark, late, path, ["order_key"], ["bucket"])
    return spark.read.parquet(path).select("order_key", F.col("price").cast("double"), "revision", F.col("bucket").cast("bigint").alias("bucket"))


def full_refresh_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh replaces a stored fact whose old rows are wrong."""
    from contrail.plans.build import Warehouse
    root = scratch_dir(spark, "refresh")
    raw = feed.raw_sources(spark, sf_dir)
    wrong = {**raw, "flights": raw["flights"].withColumn("dep_delay", F.col("dep_delay") + 500)}
    Warehouse(spark, root, wrong, hubs=feed.STATIONS).fct_flight
    return Warehouse(spark, root, raw, hubs=feed.STATIONS, full_refresh=True).fct_flight


def load_all_and_audit(spark: SparkSession, sf_dir: str) -> tuple[dict[str, str], str]:
    """Ingest all seven raw sources of the feed (monthly ones month by month,
    every month present) with an audit row per load."""
    from contrail.plans.ingest import ingest
    root = scratch_dir(spark, "load")
    raw = feed.raw_sources(spark, sf_dir)
    ingest(spark, raw, root, loaded_at=AUDIT_CLOCK)
    return {name: f"{root}/{name}" for name in raw}, f"{root}/load_audit"


def full_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = load_all_and_audit(spark, sf_dir)
    return sinks.table_counts({n: sinks.read_raw(spark, p) for n, p in sorted(paths.items())})


def audit_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, audit_path = load_all_and_audit(spark, sf_dir)
    return sinks.recent_loads(spark.read.parquet(audit_path), 10)


def write_source_files(raw: dict[str, DataFrame], folder: str) -> None:
    """The raw sources as the delimited files that their registry describes:
    instants in UTC with a Z, NULLs empty or as the null token, columns of files
    with a header in reverse order."""
    for name, source in SOURCES_BY_NAME.items():
        df = raw[name].select(*[
            F.date_format(F.col(f.name).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(f.name)
            if f.dataType.simpleString().startswith("timestamp") else F.col(f.name) for f in raw[name].schema.fields])
        df = df.select(*source.columns) if source.columns else df.select(*reversed(df.columns))
        writer = df.write.mode("overwrite").option("header", str(source.header).lower()).option("escape", '"')
        if source.nullstr is not None:
            writer = writer.option("nullValue", source.nullstr)
        writer.csv(f"{folder}/{source.file}")


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven sources written as files and read back: a digest per source and
    column type (rows, filled fields, sums of numbers, earliest and latest instant)."""
    root = scratch_dir(spark, "files")
    raw = feed.raw_sources(spark, sf_dir)
    write_source_files(raw, root)
    parts = []
    for name, source in SOURCES_BY_NAME.items():
        df = read_source(spark, source, root)
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        filled = sum((F.col(c).isNotNull().cast("bigint") for c in kinds), F.lit(0).cast("bigint"))
        whole = [F.coalesce(F.col(c), F.lit(0)) for c, k in kinds.items() if k == "bigint"]
        instants = [F.col(c).cast("timestamp_ntz") for c, k in kinds.items() if k.startswith("timestamp")]
        at = instants[0] if instants else F.lit(None).cast("timestamp_ntz")
        parts.append(df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.sum(filled).cast("bigint").alias("filled"),
                            F.sum(sum(whole, F.lit(0).cast("bigint"))).cast("bigint").alias("whole_sum"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))
                     .select(F.lit(name).alias("source"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the two carrier sources as delimited text the way the source
    systems publish them — one with a header, one header-less with ``\\N`` for
    NULL and names containing commas and quotes — read them back through the
    source registry, and build the carrier staging model from the files."""
    root = scratch_dir(spark, "csv")
    raw = feed.raw_sources(spark, sf_dir)
    airlines = raw["airlines"].withColumn("name", F.concat(F.col("name"), F.lit(', "Intl"')))
    airlines.write.mode("overwrite").option("header", "true").option("escape", '"').csv(f"{root}/airlines.csv")
    of = raw["openflights_airlines"].withColumn("name", F.concat(F.col("name"), F.lit(', Co "X"')))
    (of.write.mode("overwrite").option("header", "false").option("nullValue", "\\N").option("escape", '"')
       .csv(f"{root}/openflights_airlines.dat"))
    back_airlines = read_source(spark, SOURCES_BY_NAME["airlines"], root)
    back_of = read_source(spark, SOURCES_BY_NAME["openflights_airlines"], root)
    from contrail.plans import staging
    return staging.stg_carrier(back_airlines, back_of)


def reference_versions(m: Models) -> list[DataFrame]:
    """Three snapshots of the airport reference: as loaded; with renamed
    airports, a changed unchecked column and deleted rows; as loaded again."""
    v1 = m.stg_airport_reference.select(*SNAPSHOT_COLS)
    rule = F.substring("ident", 2, 20).cast("bigint") % 5
    v2 = (v1.where(rule != 2)
            .withColumn("airport_name", F.when(rule == 0, F.concat(F.col("airport_name"), F.lit(" II")))
                                         .otherwise(F.col("airport_name")))
            .withColumn("iso_country", F.when(rule == 1, F.lit("ZZ")).otherwise(F.col("iso_country"))))
    return [v1, v2, v1]


def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-2 history after three snapshots; each one rewrites the open versions
    and adds the closed ones, so the lineage never grows with the number of runs."""
    m = Models.from_driver_tables(spark, sf_dir)
    path = scratch_dir(spark, "snap") + "/airport_reference"
    for version, at in zip(reference_versions(m), SNAPSHOT_TIMES):
        history = write_snapshot(spark, path, version, "ident", SNAPSHOT_CHECK_COLS, at)
    return history


def streamed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact maintained by the streaming ingester: the flight feed lands
    as files in two arrivals (orders before and after a cut-off), each
    arrival is picked up by one ``availableNow`` run, and every micro-batch
    is staged, joined to the weather and merged by key.  The stored table
    must equal a full build."""
    from contrail.plans import staging
    from contrail.streaming import ingest_available
    m = Models.from_driver_tables(spark, sf_dir)
    root = scratch_dir(spark, "stream")
    landing, target, ckpt = f"{root}/landing", f"{root}/fct_flight", f"{root}/_checkpoint"
    raw = m.raw["flights"]
    cut = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    weather = m.stg_weather

    def to_fact(batch: DataFrame) -> DataFrame:
        return with_fact_partitions(warehouse.fct_flight(staging.stg_flight(batch), weather))

    raw.where(cut <= F.lit(INCREMENTAL_CUTOFF)).write.mode("append").parquet(landing)
    ingest_available(spark, landing, raw.schema, target, ckpt, ["flight_key"], FACT_PARTITIONS, to_fact)
    raw.where(cut > F.lit(INCREMENTAL_CUTOFF)).write.mode("append").parquet(landing)
    ingest_available(spark, landing, raw.schema, target, ckpt, ["flight_key"], FACT_PARTITIONS, to_fact)
    return read_fact(spark, target)


#: Checks that the generated flights fail by themselves (unknown airports, hours without a
#: reading, invented air times).
KNOWN_FAILURES = ("relationships__fct_flight__destination_airport_key", "weather_covers_the_flights",
                  "within_range__mart_route_performance__avg_ground_speed_mph")


def gated_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build that passes the gate is published; a second one, over flights of
    which some have a negative distance and all another delay, is refused.  The carrier
    mart as it then stands, with the checks that refused the second build."""
    from contrail.plans import build as B
    root = scratch_dir(spark, "gated")
    raw = feed.raw_sources(spark, sf_dir)
    first = B.build(spark, root, raw, hubs=feed.STATIONS, warn_only=KNOWN_FAILURES)
    wrong = raw["flights"].withColumns({"distance": F.when(F.col("rownames") % 10 == 0, F.lit(-5)).otherwise(F.col("distance")).cast("bigint"),
                                        "dep_delay": F.col("dep_delay") + 30})
    try:
        B.build(spark, root, {**raw, "flights": wrong}, hubs=feed.STATIONS, full_refresh=True, warn_only=KNOWN_FAILURES)
        refused = []
    except B.GateFailed as failure:
        # Those of the staging views; whether others had run by then is a matter of time.
        refused = [c for c in failure.checks if "__stg_" in c]
    return first.warehouse.table("mart_carrier_performance").withColumn("refused_by", F.lit(",".join(refused)))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with planted faults, loaded with a limit: what was rejected, by field and
    value, beside the rows that were loaded and their key sums."""
    from contrail.plans.ingest import ingest
    root = scratch_dir(spark, "rejects")
    raw = dict(feed.raw_sources(spark, sf_dir))
    raw["flights"] = raw["flights"].withColumn(
        "distance", F.when(F.col("rownames") % 101 == 3, F.lit("n/a")).otherwise(F.col("distance").cast("string")))
    raw["planes"] = raw["planes"].withColumns({
        "seats": F.when(F.col("rownames") % 7 == 2, F.lit("12x")).otherwise(F.col("seats").cast("string")),
        "year": F.when(F.col("rownames") % 14 == 2, F.lit("MCM")).otherwise(F.col("year").cast("string"))})
    write_source_files(raw, f"{root}/files")
    names = ("flights", "planes", "airlines")
    files = {n: read_source(spark, SOURCES_BY_NAME[n], f"{root}/files", on_bad="keep") for n in names}
    ingest(spark, files, f"{root}/raw", reject_limit=10 ** 9)
    rejects = sinks.read_versioned(spark, f"{root}/raw/rejects").groupBy("source", "column", "value").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"), F.lit(None).cast("bigint").alias("key_sum"))
    for n in names:
        loaded = sinks.read_raw(spark, f"{root}/raw/{n}").agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.sum("rownames").cast("bigint").alias("key_sum"))
        rejects = rejects.unionByName(loaded.select(F.lit(n).alias("source"), F.lit(None).cast("string").alias("column"),
                                                    F.lit(None).cast("string").alias("value"), "rows", "key_sum"))
    return rejects


SEED_YEAR = 1995


def seeded_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar with a holiday seed file, which covers one year of it only."""
    from contrail.sources.readers import holidays_for_years, read_seed
    path = scratch_dir(spark, "seed") + "/holidays.csv"
    holidays_for_years(spark.range(SEED_YEAR, SEED_YEAR + 1).withColumnRenamed("id", "year")).coalesce(1).write.option("header", "true").csv(path)
    m = Models(feed.raw_sources(spark, sf_dir), holidays=read_seed(spark, path=path), hubs=feed.STATIONS)
    return m.dim_date


def empty_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly tables first loaded with a month that no file holds, which makes them empty
    with their schema, then with all months: columns and rows before and after."""
    root = scratch_dir(spark, "empty")
    raw = feed.raw_sources(spark, sf_dir)
    out = None
    for name in ("flights", "weather"):
        path = f"{root}/{name}"
        sinks.load_monthly(spark, raw[name], path, ["1901-01"])
        empty = spark.read.parquet(path)
        before, columns = empty.count(), len(empty.columns)
        sinks.load_monthly(spark, raw[name], path)
        after = spark.read.parquet(path).where("year is not null").agg(F.count(F.lit(1)).cast("bigint").alias("rows_after"))
        one = after.select(F.lit(name).alias("table_name"), F.lit(columns).cast("bigint").alias("columns"),
                           F.lit(before).cast("bigint").alias("rows_before"), "rows_after")
        out = one if out is None else out.unionByName(one)
    return out


def audit_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ingest that isn't given a time audits the time it ran at: per table the
    rows loaded, and whether every entry lies within the run (a second is added for
    each source, to keep the order of loads)."""
    from contrail.plans.ingest import ingest
    root = scratch_dir(spark, "now")
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    ingest(spark, feed.raw_sources(spark, sf_dir), root)
    ended = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(seconds=len(SOURCES_BY_NAME))
    inside = (F.col("loaded_at") >= F.lit(started).cast("timestamp_ntz")) & (F.col("loaded_at") <= F.lit(ended).cast("timestamp_ntz"))
    return spark.read.parquet(f"{root}/load_audit").groupBy("table_name").agg(
        F.sum("rows").cast("bigint").alias("rows"), F.every(inside).alias("is_current"))
