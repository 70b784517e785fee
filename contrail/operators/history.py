"""Type-2 history (slowly changing dimension snapshot), "check" strategy.

History rows carry the source columns plus ``version_id``, ``valid_from``,
``valid_to`` (NULL = current) and ``updated_at``.  On each snapshot at time
``as_of``:

* a new key opens a version;
* a key whose checked columns changed (NULL-safe comparison) closes its open
  version at ``as_of`` and opens a new one;
* a key missing from the input closes its open version (hard delete), when
  ``invalidate_hard_deletes``;
* a key that comes back after a delete opens a new version;
* unchanged keys and closed history are kept as they are, so re-running the
  same snapshot is a no-op;
* a row without a key fails the job: it could never be matched again.

One full outer join of the open versions against the input decides every
key; each joined row then emits one or two output rows through a generator,
so the join is computed once.

Stored (:func:`write_snapshot`), a history is two parts: ``open``, the current
versions, replaced by each snapshot, and ``closed``, to which each snapshot adds
the versions it closes.  A closed version is written once and its file never
touched again, so a snapshot costs what is current, not what has been.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.keys import surrogate_key
from contrail.operators.publish import Publication, recover
from contrail.operators.sinks import read_versioned, versions
from contrail.session import child_names

META = ("version_id", "valid_from", "valid_to", "updated_at")


def _version_id(key: str, valid_from) -> F.Column:
    return surrogate_key(F.col(key), valid_from)


def scd2_changes(current: DataFrame, open_: DataFrame | None, key: str, check_cols: Sequence[str],
                 as_of: dt.datetime, invalidate_hard_deletes: bool = True) -> DataFrame:
    """The open versions after a snapshot, and those that it closes."""
    cols = current.columns
    refused = F.raise_error(F.lit(f"snapshot row without {key}"))
    current = current.withColumn(key, F.coalesce(F.col(key), refused.cast(current.schema[key].dataType)))
    ts = F.lit(as_of).cast("timestamp_ntz")
    if open_ is None:
        return current.select(*cols, _version_id(key, ts).alias("version_id"), ts.alias("valid_from"),
                              F.lit(None).cast("timestamp_ntz").alias("valid_to"), ts.alias("updated_at"))
    o = open_.select(*[F.col(c).alias(f"_o_{c}") for c in [*cols, *META]])
    n = current.select(*[F.col(c).alias(f"_n_{c}") for c in cols])
    j = o.join(n, on=F.col(f"_o_{key}") == F.col(f"_n_{key}"), how="full_outer")

    has_old, has_new = F.col(f"_o_{key}").isNotNull(), F.col(f"_n_{key}").isNotNull()
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}"))
    changed = has_old & has_new & ~same
    deleted = has_old & ~has_new
    close_old = changed | (deleted if invalidate_hard_deletes else F.lit(False))
    open_new = has_new & (~has_old | changed)

    def old_row(valid_to):
        return F.struct(*[F.col(f"_o_{c}").alias(c) for c in cols],
                        F.col("_o_version_id").alias("version_id"), F.col("_o_valid_from").alias("valid_from"),
                        valid_to.alias("valid_to"),
                        F.when(close_old, ts).otherwise(F.col("_o_updated_at")).alias("updated_at"))

    new_row = F.struct(*[F.col(f"_n_{c}").alias(c) for c in cols],
                       _version_id(f"_n_{key}", ts).alias("version_id"), ts.alias("valid_from"),
                       F.lit(None).cast("timestamp_ntz").alias("valid_to"), ts.alias("updated_at"))
    kept_old = F.when(has_old, old_row(F.when(close_old, ts).otherwise(F.col("_o_valid_to"))))
    emitted = F.filter(F.array(kept_old, F.when(open_new, new_row)), lambda x: x.isNotNull())
    return j.select(F.explode(emitted).alias("r")).select("r.*")


def scd2_snapshot(current: DataFrame, history: DataFrame | None, key: str,
                  check_cols: Sequence[str], as_of: dt.datetime,
                  invalidate_hard_deletes: bool = True) -> DataFrame:
    """The whole history after a snapshot, as one frame."""
    if history is None:
        return scd2_changes(current, None, key, check_cols, as_of, invalidate_hard_deletes)
    changes = scd2_changes(current, history.where(F.col("valid_to").isNull()), key, check_cols, as_of, invalidate_hard_deletes)
    return history.where(F.col("valid_to").isNotNull()).select(*changes.columns).unionByName(changes)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored history: its closed and open versions; None when there is none."""
    path = path.rstrip("/")
    open_ = read_versioned(spark, f"{path}/open")
    if not child_names(spark, f"{path}/closed"):
        return open_
    closed = spark.read.parquet(f"{path}/closed").drop("snapshot")
    return closed if open_ is None else closed.select(*open_.columns).unionByName(open_)


def stage_snapshot(publication: Publication, path: str, current: DataFrame, key: str, check_cols: Sequence[str],
                   as_of: dt.datetime, invalidate_hard_deletes: bool = True) -> DataFrame:
    """Write a snapshot, unpublished, and return the history as it will be.

    One job: the open versions and the newly closed ones are two partitions of what
    it writes, and each is renamed to its place."""
    spark, path = publication.spark, path.rstrip("/")
    open_ = read_versioned(spark, f"{path}/open")
    done = child_names(spark, f"{path}/closed")
    changes = scd2_changes(current, open_, key, check_cols, as_of, invalidate_hard_deletes)
    staged = publication.stage(path)
    changes.withColumn("is_closed", F.col("valid_to").isNotNull()).write.partitionBy("is_closed").parquet(staged)
    held = child_names(spark, staged)
    last = versions(spark, f"{path}/open")
    if "is_closed=false" in held:
        number = int(last[-1][1:]) + 1 if last else 1
        publication.put(f"{staged}/is_closed=false", f"{path}/open/v{number:08d}")
    for old in last:
        publication.drop(f"{path}/open/{old}")
    if "is_closed=true" in held:
        number = max((int(n.split("=")[1]) for n in done if "=" in n), default=0) + 1
        publication.put(f"{staged}/is_closed=true", f"{path}/closed/snapshot={number}")
    after = spark.read.schema(changes.schema).parquet(staged).select(*changes.columns)
    return spark.read.parquet(f"{path}/closed").select(*changes.columns).unionByName(after) if done else after


def write_snapshot(spark: SparkSession, path: str, current: DataFrame, key: str, check_cols: Sequence[str],
                   as_of: dt.datetime, invalidate_hard_deletes: bool = True) -> DataFrame:
    """:func:`stage_snapshot`, published at once."""
    path = path.rstrip("/")
    recover(spark, path)
    with Publication(spark, path) as publication:
        stage_snapshot(publication, path, current, key, check_cols, as_of, invalidate_hard_deletes)
        publication.commit()
    return read_snapshots(spark, path)
