"""Sinks: full replace, idempotent month-by-month replace, schema-drift
detection, the load audit, table counts and materialisation.

Tables are Parquet directories.  Monthly tables are partitioned by
``(year, month)``; a reload writes exactly the selected months, into a staging
folder, and swaps them in together (``contrail.operators.publish``); every other
month is untouched.  A lost executor only re-runs tasks.

Tables that are replaced whole are written as a new version folder beside the old
one, staged likewise; readers take the newest version, and older ones go when it is
published.  A crash before that leaves the old version in place.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators.publish import Publication, partition_folders, recover
from contrail.session import child_names
from contrail.sources.schemas import LOAD_AUDIT

_MONTH = re.compile(r"^(\d{4})-(\d{2})$")


def parse_months(months: Iterable[str]) -> list[tuple[int, int]]:
    """``["2013-02", "2013-01"]`` -> sorted unique ``[(2013, 1), (2013, 2)]``."""
    out = set()
    for m in months:
        hit = _MONTH.match(m.strip())
        if not hit or not 1 <= int(hit.group(2)) <= 12:
            raise ValueError(f"month must look like YYYY-MM: {m!r}")
        out.add((int(hit.group(1)), int(hit.group(2))))
    return sorted(out)


def month_label(year: int, month: int) -> str:
    return f"{year:04d}-{month:02d}"


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds more than staging folders and journals."""
    return any(n[0] not in "._" for n in child_names(spark, path))


def schema_drift(old: T.StructType, new: T.StructType,
                 partition_cols: Sequence[str] = ()) -> list[str]:
    """Differences in column names and types between two schemas, one line each.

    Partition columns are compared by name only (a Parquet read infers their type
    from the directory names)."""
    before, after = ({f.name: "" if f.name in partition_cols else f.dataType.simpleString() for f in s.fields} for s in (old, new))
    return [f"{name}: {before.get(name, 'absent')} -> {after.get(name, 'absent')}"
            for name in {**before, **after} if before.get(name) != after.get(name)]


def drifted(old: T.StructType, new: T.StructType, partition_cols: Sequence[str] = ()) -> bool:
    """Whether ``new`` has a column that ``old`` lacks or holds otherwise."""
    known = {f.name: f.dataType for f in old.fields}
    return any(f.name not in partition_cols and known.get(f.name) != f.dataType for f in new.fields)


_VERSION = re.compile(r"^v(\d{8})$")


def versions(spark: SparkSession, path: str) -> list[str]:
    """Version folders of a table, oldest first; a folder takes its name when it is published."""
    return [n for n in child_names(spark, path) if _VERSION.match(n)]


def read_versioned(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of a table; None when there is none."""
    found = versions(spark, path)
    return spark.read.parquet(f"{path}/{found[-1]}") if found else None


def stage_table(publication: Publication, df: DataFrame, path: str, partition_by: Sequence[str] = (),
                sort_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as the next version of the table, unpublished, and return a
    scan of it, which cuts the lineage for everything downstream.  ``df`` may
    read the current version."""
    spark, path = publication.spark, path.rstrip("/")
    last = versions(spark, path)
    new = f"v{int(_VERSION.match(last[-1])[1]) + 1 if last else 1:08d}"
    staged = publication.stage(path)
    for_partitioned_write(df, partition_by, sort_by).write.partitionBy(*partition_by).parquet(staged)
    publication.put(staged, f"{path}/{new}")
    for old in last:
        publication.drop(f"{path}/{old}")
    return spark.read.schema(df.schema).parquet(staged) if partition_by else spark.read.parquet(staged)


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as the next version of the table and drop the older ones."""
    recover(spark, path)
    with Publication(spark, path) as publication:
        stage_table(publication, df, path)
        publication.commit()
    return read_versioned(spark, path)


def load_full(spark: SparkSession, df: DataFrame, path: str, check: Callable[[], None] | None = None) -> int:
    """Replace the whole table; return its row count (answered from Parquet
    footers, not by rescanning the data).  ``check`` runs between the write and
    its publication and may raise."""
    recover(spark, path)
    with Publication(spark, path) as publication:
        rows = stage_table(publication, df, path).count()
        if check:
            check()
        publication.commit()
    return rows


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A loaded raw table, versioned or month-partitioned."""
    found = read_versioned(spark, path)
    return found if found is not None else spark.read.parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType,
                 partition_cols: Sequence[str] = ()) -> DataFrame:
    """The table at ``path``, created empty with ``schema`` when there is none.

    An empty partitioned table has no partition folder, so it is created with one
    empty file in the NULL partition, which carries the schema."""
    if not table_exists(spark, path):
        data = T.StructType([f for f in schema.fields if f.name not in partition_cols])
        folder = "".join(f"/{c}=__HIVE_DEFAULT_PARTITION__" for c in partition_cols)
        spark.createDataFrame([], data).coalesce(1).write.mode("ignore").parquet(path + folder)
    # The types of partition values are those asked for, not guessed from names.
    stored = spark.read.parquet(path)
    kinds = {f.name: f.dataType for f in schema.fields if f.name in partition_cols}
    return spark.read.schema(T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in stored.schema.fields])).parquet(path)


def _month_filter(months: Sequence[tuple[int, int]]):
    """One predicate on the month's number, however many months there are: each of
    the two columns (or what they are parsed from) is read once.  On stored
    tables it prunes, as it reads partition columns only."""
    return (F.col("year") * 12 + F.col("month")).isin([12 * y + m for y, m in months]) if months else F.lit(False)


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``, by name; missing ones are NULL."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both, the new types where they differ, old order first."""
    kinds = {f.name: f.dataType for f in old.fields} | {f.name: f.dataType for f in new.fields}
    return T.StructType([T.StructField(n, k, True) for n, k in kinds.items()])


def _months_of(df: DataFrame) -> list[tuple[int, int]]:
    """The (year, month) pairs of a monthly table: bounded by its months."""
    return sorted((int(r[0]), int(r[1])) for r in df.select("year", "month").distinct().collect() if r[0] is not None and r[1] is not None)


def load_monthly(spark: SparkSession, df: DataFrame, path: str, months: Iterable[str] | None = None,
                 check: Callable[[], None] | None = None) -> dict[str, int]:
    """Idempotent month replace; without ``months``, of every month that ``df`` holds.

    * One job parses ``df`` and writes the selected months into a staging folder;
      they are swapped in together.  Selected months without incoming rows are
      cleared.  Each file is parsed once and each month written once.
    * Schema drift against the existing table (a column that is new, or of
      another type) rebuilds every stored month in the merged schema: months the
      file holds come from the file, all others from the table, so no month is
      lost.  A column that the file no longer has stays, NULL in the new rows.
    * ``check`` runs between the write and its publication and may raise: then
      the table stays as it was.
    * A first load that selects nothing leaves an empty table with the schema.

    Returns ``{"YYYY-MM": rows}`` for every selected or rebuilt month (0 when
    empty), counted from the footers of the written files.
    """
    path = path.rstrip("/")
    recover(spark, path)
    selected = parse_months(months) if months is not None else None
    old = spark.read.parquet(path) if table_exists(spark, path) else None
    incoming, wanted = df, selected
    if old is not None:
        schema = merged_schema(old.schema, df.schema)
        incoming = conformed(df, schema)
        if drifted(old.schema, df.schema, ("year", "month")):
            stored, held = _months_of(old), _months_of(df.select("year", "month"))
            wanted = sorted({*(selected if selected is not None else held), *stored})
            keep = [ym for ym in stored if ym not in held and ym not in (selected or ())]
            incoming = incoming.where(_month_filter(wanted)).unionByName(conformed(old.where(_month_filter(keep)), schema))
    with Publication(spark, path) as publication:
        staged = publication.stage(path)
        rows = incoming if wanted is None else incoming.where(_month_filter(wanted))
        for_partitioned_write(rows, ("year", "month")).write.partitionBy("year", "month").parquet(staged)
        if check:
            check()
        written = {}
        for folder in partition_folders(spark, staged, 2):
            if "__HIVE_DEFAULT_PARTITION__" in folder:
                raise ValueError("the source holds rows without a year or month")
            written[tuple(int(part.split("=")[1]) for part in folder.split("/"))] = folder
        counts = {}
        if written:
            loaded = spark.read.schema(incoming.schema).parquet(staged)
            counts = {(int(r["year"]), int(r["month"])): r["count"] for r in loaded.groupBy("year", "month").count().collect()}
        wanted = sorted(written) if wanted is None else wanted
        for ym in wanted:
            name = f"year={ym[0]}/month={ym[1]}"
            if ym in written:
                publication.put(f"{staged}/{written[ym]}", f"{path}/{name}")
            else:
                publication.drop(f"{path}/{name}")
        publication.commit()
    if not written and old is None:
        ensure_table(spark, path, df.schema, ("year", "month"))
    return {month_label(y, m): int(counts.get((y, m), 0)) for y, m in wanted}


def audit_rows(spark: SparkSession, table: str, counts: Mapping[str | None, int], source_file: str,
               loaded_at: dt.datetime | None = None) -> DataFrame:
    """Audit records for one load (one row per month, or one with NULL month).
    ``loaded_at`` defaults to the current UTC wall time; pass a fixed value to
    make reruns comparable."""
    if loaded_at is None:
        loaded_at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    data = [(loaded_at, table, month, int(n), source_file) for month, n in counts.items()]
    return spark.createDataFrame(data, LOAD_AUDIT)


def append_audit(audit: DataFrame, path: str) -> None:
    audit.write.mode("append").parquet(path)


def recent_loads(audit: DataFrame, n: int = 10) -> DataFrame:
    """Latest ``n`` audit rows, month shown as ``-`` when absent.  A top-k
    report: ``orderBy + limit`` plans as TakeOrderedAndProject."""
    return (audit.select("loaded_at", "table_name", F.coalesce(F.col("month"), F.lit("-")).alias("month"),
                         "rows")
                 .orderBy(F.col("loaded_at").desc(), F.col("table_name").asc(), F.col("month").desc())
                 .limit(n))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table, one row each, evaluated in a single job."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(
        F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def for_partitioned_write(df: DataFrame, partition_by: Sequence[str],
                          sort_by: Sequence[str] = ()) -> DataFrame:
    """Lay rows out for a partitioned write.

    The ``rebalance`` hint shuffles by the partition columns and lets AQE
    split oversized (hot) partitions and merge small ones, so each table
    partition gets a few right-sized files instead of one file per task per
    partition, and a month holding a third of the rows is still written by
    many tasks.  Sorting inside each file by ``sort_by`` keeps Parquet
    min/max statistics tight, so date filters skip row groups.
    """
    if not partition_by:
        return df
    out = df.hint("rebalance", *partition_by)
    return out.sortWithinPartitions(*partition_by, *sort_by) if sort_by else out


def stage_partitions(publication: Publication, df: DataFrame, path: str, partition_by: Sequence[str],
                     sort_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as all partitions of the table, unpublished, and return a scan of it."""
    spark, path = publication.spark, path.rstrip("/")
    staged = publication.stage(path)
    for_partitioned_write(df, partition_by, sort_by).write.partitionBy(*partition_by).parquet(staged)
    present = partition_folders(spark, staged, len(partition_by))
    for folder in present:
        publication.put(f"{staged}/{folder}", f"{path}/{folder}")
    for folder in set(partition_folders(spark, path, len(partition_by))) - set(present):
        publication.drop(f"{path}/{folder}")
    return spark.read.schema(df.schema).parquet(staged)
