"""Incremental maintenance of a keyed, partitioned fact table.

Strategy "delete + insert by key": rows of the new batch replace the stored
rows with the same key; everything else stays.  Only the partitions the batch
touches are rewritten — the partitions of the new rows *and* the partitions
where the replaced keys used to live (a key may move, e.g. a corrected date),
and partitions left empty by a move are removed.  They are written once, into a
staging folder, and renamed into place together (``contrail.operators.publish``).  A batch with several rows of
one key is resolved by an explicit order (``latest_by``) or refused, so a key is
never stored twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators.key_index import index_rows, partitions_of
from contrail.operators.publish import Publication, partition_folders, recover
from contrail.operators.sinks import for_partitioned_write, table_exists
from contrail.session import path_exists, remove_path, scratch_dir

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
DEFAULT_FLOOR = dt.date(1900, 1, 1)


def high_water_mark(existing: DataFrame | None, date_col: str,
                    floor: dt.date = DEFAULT_FLOOR, partition_cols: Sequence[str] = ()) -> dt.date:
    """Largest stored ``date_col`` (``floor`` for an empty or missing table).

    With ``partition_cols`` (ordered like the date, e.g. year then month) the
    newest partition is found from the partition values alone — Parquet
    footers, no column data — and only that partition's dates are scanned,
    instead of the date column of the whole table."""
    if existing is None:
        return floor
    scoped = existing
    if partition_cols:
        newest = existing.select(*partition_cols).distinct() \
            .orderBy(*[F.col(c).desc() for c in partition_cols]).first()
        if newest is None:
            return floor
        for c in partition_cols:
            scoped = scoped.where(F.col(c) == F.lit(newest[c]))
    value = scoped.agg(F.max(F.col(date_col)).alias("m")).first()["m"]
    return value if value is not None else floor


def incremental_filter(new: DataFrame, existing: DataFrame | None, date_col: str,
                       lookback_days: int = 0, full_refresh: bool = False,
                       partition_cols: Sequence[str] = ()) -> DataFrame:
    """Rows of ``new`` on or after the stored high-water mark (minus an
    optional look-back window).  The mark is a literal by the time the plan
    runs, so where ``date_col`` is a stored column the filter reaches the Parquet
    scan as a pushed predicate; where it is derived (from year, month and day,
    say) put :func:`months_from` on the stored columns before it."""
    if full_refresh or existing is None:
        return new
    mark = high_water_mark(existing, date_col, partition_cols=partition_cols) - dt.timedelta(days=lookback_days)
    return new.where(F.col(date_col) >= F.lit(mark))


def months_from(mark: dt.date, year_col: str = "year", month_col: str = "month"):
    """``(year, month) >= (mark.year, mark.month)`` as a predicate on month
    partition columns: on a ``(year, month)``-partitioned raw table it prunes
    every older partition, so an incremental run reads only the newest months
    of the history instead of all of it."""
    y, m = F.col(year_col), F.col(month_col)
    return (y > F.lit(mark.year)) | ((y == F.lit(mark.year)) & (m >= F.lit(mark.month)))


def upsert_by_key(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose key is not in ``new``, plus all of ``new``."""
    return existing.join(new.select(*keys), on=list(keys), how="left_anti").select(*new.columns).unionByName(new)


def partition_label(cols: Sequence[str]) -> Column:
    """A partition's values as one string: predicates on it prune, as they read
    partition columns only, and stay short however many partitions are named."""
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION)) for c in cols])


def in_partitions(cols: Sequence[str], folders: Sequence[str]) -> Column:
    """Whether a row belongs to one of the partitions (named as folders, ``a=1/b=2``)."""
    return partition_label(cols).isin([_label(f) for f in folders]) if folders else F.lit(False)


def _label(folder: str) -> str:
    """``a=1/b=2`` as :func:`partition_label` has it."""
    return "/".join(part.split("=", 1)[1] for part in folder.split("/"))


def _folders(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The partitions that the rows of ``df`` belong to: bounded by their number."""
    rows = df.select(*[F.col(c).cast("int") for c in cols]).distinct().collect()
    return ["/".join(f"{c}={NULL_PARTITION if v is None else v}" for c, v in zip(cols, r)) for r in rows]


def _values(folder: str) -> tuple:
    return tuple(None if v == NULL_PARTITION else int(v) for v in _label(folder).split("/"))


@dataclass
class Merge:
    """A staged merge: what :meth:`preview` reads is not visible yet."""

    spark: SparkSession
    path: str
    schema: T.StructType
    partition_cols: tuple[str, ...]
    staged: str
    touched: list[str]
    publication: Publication

    def preview(self) -> DataFrame:
        """The table as it will be."""
        read = self.spark.read.schema(self.schema)
        if not table_exists(self.spark, self.path):
            return read.parquet(self.staged)
        old = read.parquet(self.path)
        return old.where(~in_partitions(self.partition_cols, self.touched)).unionByName(read.parquet(self.staged)) if self.touched else old

    def put(self) -> None:
        """Add the moves to the publication."""
        present = partition_folders(self.spark, self.staged, len(self.partition_cols))
        for folder in present:
            self.publication.put(f"{self.staged}/{folder}", f"{self.path}/{folder}")
        for folder in set(self.touched) - set(present):
            self.publication.drop(f"{self.path}/{folder}")


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}/_keys"


def read_index(spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], partition_cols: Sequence[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in schema.fields}
    key = kinds[keys[0]] if len(keys) == 1 else T.StringType()
    fields = [("slots", T.IntegerType()), ("slot", T.IntegerType()), ("lo", key), ("hi", key), ("bits", T.BinaryType())]
    return spark.read.schema(T.StructType([T.StructField(n, k) for n, k in [*fields, *((c, kinds[c]) for c in partition_cols)]])).parquet(folder)


def stage_incremental(publication: Publication, new: DataFrame, path: str, keys: Sequence[str],
                      partition_cols: Sequence[str], sort_by: Sequence[str] = (), latest_by: Sequence[str] = (),
                      fixed_partition: bool = False) -> Merge:
    """Merge ``new`` into the table at ``path`` by ``keys``, into a staging folder.

    ``new`` is computed once, into a scratch folder below the shared checkpoint
    root, and everything else starts from that copy.  Several rows of one key in
    the batch: the one that comes last by ``latest_by`` is taken; without an order
    the batch is refused.  Rows whose partition is NULL live in the NULL partition.

    Only partitions that change are read and staged, once: those of the new rows, and
    those that a replaced key leaves.  ``fixed_partition`` says that a key never moves;
    else the key index names the partitions that may hold a key of the batch
    (see :mod:`contrail.operators.key_index`), and only the keys of those are read to confirm
    it.  The index is made on the first merge, from one scan of the key columns of the
    other partitions, and published with the partitions that change."""
    spark, path, by = publication.spark, path.rstrip("/"), list(partition_cols)
    scratch = scratch_dir(spark, "merge")
    schema = new.schema
    try:
        if latest_by:
            last = F.max(F.struct(*latest_by, F.struct(*new.columns).alias("row")))
            new = new.groupBy(*keys).agg(last.alias("last")).select("last.row.*")
        staged = publication.stage(path)
        if not table_exists(spark, path):
            for_partitioned_write(new, by, sort_by).write.partitionBy(*by).parquet(staged)
            if not latest_by:
                _refuse_twice(spark.read.schema(schema).parquet(staged), keys)
            return Merge(spark, path, schema, tuple(by), staged, [], publication)
        new.write.parquet(f"{scratch}/new")
        batch = spark.read.schema(schema).parquet(f"{scratch}/new")
        if not latest_by:
            _refuse_twice(batch, keys)
        existing = spark.read.schema(schema).parquet(path)
        touched = set(_folders(batch, by))
        indexed = path_exists(spark, index_path(path))
        if not fixed_partition and touched:
            index, others = index_path(path), ~in_partitions(by, sorted(touched))
            if not indexed:
                index, indexed = publication.stage(path), True
                index_rows(existing.where(others), keys, by).write.partitionBy(*by).parquet(index)
                for folder in partition_folders(spark, index, len(by)):
                    publication.put(f"{index}/{folder}", f"{index_path(path)}/{folder}")
            asked = read_index(spark, index, schema, keys, by).where(others)
            named = set(_folders(partitions_of(asked, batch, keys, by), by))
            if named:
                some = existing.where(in_partitions(by, sorted(named)))
                touched |= set(_folders(some.join(batch.select(*keys), on=list(keys), how="left_semi"), by))
        folders = sorted(touched)
        if folders:
            kept = existing.where(in_partitions(by, folders))
            for_partitioned_write(upsert_by_key(kept, batch, keys), by, sort_by).write.partitionBy(*by).parquet(staged)
            if indexed:
                again = publication.stage(path)
                index_rows(spark.read.schema(schema).parquet(staged), keys, by).write.partitionBy(*by).parquet(again)
                present = partition_folders(spark, again, len(by))
                for folder in present:
                    publication.put(f"{again}/{folder}", f"{index_path(path)}/{folder}")
                for folder in set(folders) - set(present):
                    publication.drop(f"{index_path(path)}/{folder}")
        return Merge(spark, path, schema, tuple(by), staged, folders, publication)
    finally:
        remove_path(spark, scratch)


def _refuse_twice(batch: DataFrame, keys: Sequence[str]) -> None:
    twice = batch.groupBy(*keys).count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"the batch holds several rows of a key and no order to choose by: {[tuple(r)[:-1] for r in twice]}")


def write_incremental(spark: SparkSession, new: DataFrame, path: str, keys: Sequence[str],
                      partition_cols: Sequence[str], sort_by: Sequence[str] = (),
                      latest_by: Sequence[str] = (), fixed_partition: bool = False) -> list[tuple]:
    """:func:`stage_incremental`, published at once; returns the partitions
    rewritten."""
    path = path.rstrip("/")
    recover(spark, path)
    with Publication(spark, path) as publication:
        merge = stage_incremental(publication, new, path, keys, partition_cols, sort_by, latest_by, fixed_partition)
        touched = merge.touched or partition_folders(spark, merge.staged, len(merge.partition_cols))
        merge.put()
        publication.commit()
    return [_values(f) for f in touched]
