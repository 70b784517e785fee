"""Production build: materialise the model graph table by table.

Every dimension, the fact and every mart are written as Parquet tables under
``root`` and read back by their consumers — each table is computed once, and
the lineage of every downstream job starts at a stored table (this is also
what lets a long build survive executor loss without recomputing from the raw
files).  Staging models stay lazy views: they are narrow projections that fuse
into their consumers' scans, and writing a copy of the fact-sized flight staging
would cost a full rewrite of the largest input.  The hourly weather is stored: it
is small once deduplicated, and Spark then knows so when it plans the fact.  So are the
conformed airports, which take several joins and are read three times.

Write, check, publish: a build stages all of its tables, checks what it staged, and
switches them together at the end (``contrail.operators.publish``).  A build that fails a
check, or dies, leaves the tables of the last one as they were.

The fact is incremental: on a rebuild only flights on or after the stored
high-water mark are recomputed and merged by key into the touched
``(flight_year, flight_month)`` partitions.  Marts, and what dimensions take from the
flights, come from stored aggregates of each month (``contrail.plans.partials``),
of which only those of touched months are computed again: no table but the fact's
touched partitions and the newest raw months is read by flight.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators import quality, sinks
from contrail.operators.history import read_snapshots, stage_snapshot
from contrail.operators.incremental import high_water_mark, in_partitions, index_path, months_from, stage_incremental
from contrail.operators.publish import Publication, recover
from contrail.operators.sinks import table_exists
from contrail.plans import checks, marts, partials, staging, warehouse
from contrail.plans.models import Models

VIEWS = ("stg_flight", "stg_plane", "stg_carrier", "stg_airport_reference")
FACT_PARTITIONS = ("flight_year", "flight_month")
FACT_SORT = ("flight_date", "origin_code")
SNAPSHOT_COLS = ("ident", "airport_type", "airport_name", "municipality", "iso_country", "iso_region",
                 "has_scheduled_service")
SNAPSHOT_CHECK_COLS = ("airport_type", "airport_name", "municipality", "has_scheduled_service")


class Warehouse(Models):
    """The model graph, materialised under ``root``.

    With a ``publication`` the tables are staged and left to it; else each one is
    published as soon as it is written."""

    ordered = False

    def __init__(self, spark: SparkSession, root: str, raw: Mapping[str, DataFrame],
                 full_refresh: bool = False, lookback_days: int = 0, fixed_partition: bool = False,
                 publication: Publication | None = None, watched: Mapping[str, Sequence[quality.Check]] | None = None, **kwargs):
        super().__init__(raw, **kwargs)
        self.spark = spark
        self.root = root.rstrip("/")
        self.full_refresh = full_refresh
        self.lookback_days = lookback_days
        self.fixed_partition = fixed_partition
        self.publication = publication
        #: Checks by table, whose row-level ones are counted by the job that writes it.
        self.watched = dict(watched or {})
        self.observed: dict[str, quality.Observed] = {}
        self.written: list[str] = []
        #: Rows of the fact's months that this build changed, and the months (None: all).
        self._changed: Callable[[], DataFrame] | None = None
        self._months: list[str] | None = None
        self._partials: dict[str, DataFrame] = {}
        self._published = False

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        """A published table."""
        if name == "fct_flight":
            return self.spark.read.parquet(self.path(name)).select(*warehouse.FACT_COLUMNS)
        return sinks.read_versioned(self.spark, self.path(name))

    def reread(self) -> None:
        """After a publication: tables, and views over them, are taken from their places when
        they are asked for again."""
        self._published = True
        self._partials = {}
        for name in (*self.written, "endpoints", "airport_usage", "flight_days", "tails"):
            self.__dict__.pop(name, None)

    def _model(self, name: str, build) -> DataFrame:
        if name in VIEWS:
            return build()
        if self._published:
            return self.table(name)
        if name == "fct_flight":
            return self._fact()
        with self._publishing(self.path(name)) as publication:
            out = sinks.stage_table(publication, self._watch(name, build()), self.path(name))
        self.written.append(name)
        return out if self.publication else self.table(name)

    @contextmanager
    def _publishing(self, path: str) -> Iterator[Publication]:
        """The build's publication, which commits at its end, or one of the table's own,
        which commits here and leaves nothing behind if the table can't be written."""
        if self.publication is not None:
            yield self.publication
            return
        with Publication(self.spark, path) as own:
            yield own
            own.commit()

    def _watch(self, name: str, df: DataFrame) -> DataFrame:
        if name in self.watched:
            self.observed[name] = quality.Observed(self.watched[name])
            return self.observed[name].watch(df)
        return df

    def _fact(self) -> DataFrame:
        path = self.path("fct_flight")
        exists = table_exists(self.spark, path) and not self.full_refresh
        flights = self.stg_flight
        if exists:
            mark = high_water_mark(self.spark.read.parquet(path), "flight_date",
                                   partition_cols=FACT_PARTITIONS) - dt.timedelta(days=self.lookback_days)
            # coarse month predicate on the raw table (partition pruning), then the exact date cut
            recent = self.raw["flights"].where(months_from(mark))
            flights = staging.stg_flight(recent).where(F.col("flight_date") >= F.lit(mark))
        new = warehouse.fct_flight(flights, self.stg_weather).withColumns(
            {"flight_year": F.year("flight_date"), "flight_month": F.month("flight_date")})
        read = self.spark.read.schema(new.schema)
        with self._publishing(path) as publication:
            if exists:
                merge = stage_incremental(publication, new, path, ["flight_key"], FACT_PARTITIONS, FACT_SORT, fixed_partition=self.fixed_partition)
                merge.put()
                out, self._months = merge.preview(), merge.touched
                self._changed = lambda: read.parquet(merge.staged)
            else:
                out = sinks.stage_partitions(publication, self._watch("fct_flight", new), path, FACT_PARTITIONS, FACT_SORT)
                publication.drop(index_path(path))  # of the rows that were there
                self._changed = lambda: out
        self.written.append("fct_flight")
        if self.publication is None:
            out = read.parquet(path)
            self._changed = lambda: out if self._months is None else out.where(in_partitions(FACT_PARTITIONS, self._months))
        return out.select(*warehouse.FACT_COLUMNS)

    def partial(self, name: str) -> DataFrame:
        """Stored monthly aggregates of the fact; those of changed months are made anew."""
        if self._published:
            return sinks.read_versioned(self.spark, self.path(f"partials/{name}"))
        if name not in self._partials:
            self.fct_flight  # noqa: B018 - says which months changed
            path, make = self.path(f"partials/{name}"), partials.STORED[name]
            old = sinks.read_versioned(self.spark, path)
            if old is None and self._months is not None:  # a warehouse from before they were stored
                rows = make(partials.with_months(self.fct_flight))
            elif self._months is None:
                rows = make(self._changed())
            elif not self._months:
                self._partials[name] = old
                return old
            else:
                rows = old.where(~in_partitions(partials.MONTH, self._months)).unionByName(make(self._changed()))
            with self._publishing(path) as publication:
                out = sinks.stage_table(publication, rows, path)
            self._partials[name] = out if self.publication else sinks.read_versioned(self.spark, path)
        return self._partials[name]

    @cached_property
    def flight_days(self) -> DataFrame:
        return self.partial("daily").select("flight_date")

    @cached_property
    def tails(self) -> DataFrame:
        return self.partial("aircraft").select("tail_number")

    @cached_property
    def endpoints(self) -> DataFrame:
        return self.airport_usage.select("airport_code")

    @cached_property
    def airport_usage(self) -> DataFrame:
        return partials.airport_usage(self.partial("routes"))

    @cached_property
    def mart_carrier_performance(self) -> DataFrame:
        return self._model("mart_carrier_performance", lambda: marts.carrier_performance(
            self.partial("carrier_delays"), partials.members_of(self.partial("routes"), self.partial("aircraft")), self.dim_carrier, ordered=False))

    @cached_property
    def mart_route_performance(self) -> DataFrame:
        return self._model("mart_route_performance", lambda: marts.route_performance(self.partial("routes"), self.dim_airport, ordered=False))

    @cached_property
    def mart_weather_impact(self) -> DataFrame:
        return self._model("mart_weather_impact", lambda: marts.weather_impact(self.partial("weather_delays"), ordered=False))

    @cached_property
    def mart_daily_operations(self) -> DataFrame:
        return self._model("mart_daily_operations", lambda: marts.daily_operations(self.partial("daily"), self.dim_date, ordered=False))

    @cached_property
    def mart_aircraft_utilization(self) -> DataFrame:
        return self._model("mart_aircraft_utilization", lambda: marts.aircraft_utilization(self.partial("aircraft"), self.dim_aircraft, ordered=False))

    def snapshot(self, as_of: dt.datetime) -> DataFrame:
        """Add a type-2 snapshot of the airport reference taken at ``as_of``."""
        path = self.path("snapshots/snap_airport_reference")
        with self._publishing(path) as publication:
            out = stage_snapshot(publication, path, self.stg_airport_reference.select(*SNAPSHOT_COLS), "ident", SNAPSHOT_CHECK_COLS, as_of)
        return out if self.publication else read_snapshots(self.spark, path)


@dataclass
class BuildResult:
    warehouse: Warehouse
    report: DataFrame
    timings: dict


# What each step of a build reads, in an order in which they can be done.
STEPS: dict[str, tuple[str, ...]] = {
    "fct_flight": (), "dim_carrier": (),
    **{name: ("fct_flight",) for name in partials.STORED},
    "stg_airport": ("routes",), "dim_airport": ("stg_airport", "routes"),
    "dim_date": ("daily",), "dim_aircraft": ("aircraft",),
    "mart_weather_impact": ("weather_delays",), "mart_route_performance": ("routes", "dim_airport"),
    "mart_carrier_performance": ("carrier_delays", "routes", "aircraft", "dim_carrier"),
    "mart_daily_operations": ("daily", "dim_date"), "mart_aircraft_utilization": ("aircraft", "dim_aircraft"),
}


def build(spark: SparkSession, root: str, raw: Mapping[str, DataFrame], *,
          hubs: Sequence[str] = warehouse.DEFAULT_HUBS, holidays: DataFrame | None = None,
          as_of: dt.datetime | None = None, full_refresh: bool = False, lookback_days: int = 0,
          fixed_partition: bool = False, fail_on_violation: bool = False, gate: bool = True,
          warn_only: Sequence[str] = (), threads: int = 32) -> BuildResult:
    """Build every table, take the snapshot, run the check catalogue, publish.

    Steps are submitted from ``threads`` driver threads, each as soon as what it reads
    is there; Spark runs their jobs side by side on the shared executors.  The checks of a table
    run as soon as it, and those its keys refer to, are staged, while others are still
    being built; row-level checks of a table that is written whole are counted by
    the job that writes it.  If a check fails nothing is published (with ``gate=False`` all of it is).  Checks named in
    ``warn_only`` are reported, and gate nothing.  ``lookback_days`` re-reads
    that many days before the stored high-water mark (late flights);
    ``full_refresh`` rebuilds the fact; ``fixed_partition`` says that flights never
    change their date.  The report is written to
    ``{root}/quality_report`` in any case; ``fail_on_violation`` raises after the build
    when any check failed.
    """
    import time
    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    recover(spark, root)
    catalogue = checks.declared_checks(tuple(hubs))
    with Publication(spark, root) as publication:
        wh = Warehouse(spark, root, raw, full_refresh=full_refresh, lookback_days=lookback_days, fixed_partition=fixed_partition,
                       publication=publication, watched=checks.of_stored_tables(catalogue), holidays=holidays, hubs=hubs)
        at = as_of or dt.datetime(2024, 1, 1)
        done: dict[str, Future] = {}

        def after(needed: Sequence[str], work: Callable[[], object]) -> object:
            for name in needed:
                if name in done:
                    done[name].result()
            return work()

        def run_checks(some: Sequence[quality.Check]) -> list:
            counted = {c.table for c in some if c.table in wh.observed}
            left = [c for c in some if c.kind not in quality.ROW_LEVEL or c.table not in counted]
            found = [row for table in counted for row in wh.observed[table].rows(getattr(wh, table))]
            return found + quality.count_checks(left, checks.tables_for(wh, left), threads=2)

        checking: dict[str, list] = {}
        for c in catalogue:
            checking.setdefault(c.table, []).append(c)

        def check(pool: ThreadPoolExecutor, table: str) -> None:
            some = checking.pop(table)
            found.append(pool.submit(after, [table, *(c.parent for c in some if c.parent)], lambda: run_checks(some)))

        found: list[Future] = []
        # A step waits for those it reads, which were submitted before it; the checks of a
        # table wait for it and for the tables that its keys refer to.  Most threads wait.
        with ThreadPoolExecutor(max_workers=max(2, threads)) as pool:
            for table in [t for t in checking if t.startswith("raw.")]:
                check(pool, table)  # while the weather is stored
            for name in ("stg_flight", "stg_weather", "stg_plane", "stg_carrier", "stg_airport_reference", "holidays"):
                getattr(wh, name)  # views, and the weather, resolved once before the steps
            for name, needed in STEPS.items():
                make = (lambda n=name: wh.partial(n)) if name in partials.STORED else (lambda n=name: getattr(wh, n))
                done[name] = pool.submit(after, needed, make)
            history = pool.submit(wh.snapshot, at)
            for table in list(checking):
                check(pool, table)
            found += [pool.submit(after, ["fct_flight"], lambda name=name: [(name, "fct_flight", checks.singular_checks(wh)[name].count())])
                      for name in checks.SINGULAR]
            for step in done.values():
                step.result()
            timings["tables"] = round(time.perf_counter() - t0, 3)
            t0 = time.perf_counter()
            reports = [row for one in found for row in one.result()]
            history.result()
        if gate:
            _gate(spark, root, reports, warn_only)
        publication.commit()
    wh.reread()
    report = _store_report(spark, root, reports)
    timings["checks"] = round(time.perf_counter() - t0, 3)
    if fail_on_violation:
        quality.gate(report)
    return BuildResult(wh, report, timings)


def _store_report(spark: SparkSession, root: str, rows: list) -> DataFrame:
    return sinks.replace_table(spark, quality.report_of(spark, rows).coalesce(1), f"{root.rstrip('/')}/quality_report")


class GateFailed(AssertionError):
    """A build was refused; ``checks`` are the names of those that failed."""

    def __init__(self, failed: Mapping[str, int]):
        super().__init__("data checks failed, nothing published: " + ", ".join(f"{k}={v}" for k, v in failed.items()))
        self.checks = sorted(failed)


def _gate(spark: SparkSession, root: str, rows: list, warn_only: Sequence[str]) -> None:
    failed = {name: violations for name, _, violations in rows if violations and name not in warn_only}
    if failed:
        _store_report(spark, root, rows)
        raise GateFailed(failed)
