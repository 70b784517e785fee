"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contrail.session import is_local

#: Fixed value: the white space that separates words.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which all executors share: ``spark.checkpoint.dir``
    of the session.  Only a session with a local master may go without one
    (tests); elsewhere that is an error."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not is_local(spark):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="contrail-ckpt-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared checkpoint folder, its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables in the shared checkpoint folder that cut lineage, each with a life
    of its own: what a later table no longer needs is removed at once."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._folder = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
        self._paths: dict[int, tuple[str, DataFrame]] = {}
        self._made = 0

    def store(self, df: DataFrame, instead_of: Iterable[DataFrame] = ()) -> DataFrame:
        """``df`` as a stored table; then ``instead_of``, tables of this scratch, go."""
        path = f"{self._folder}/{self._made}"
        self._made += 1
        df.write.parquet(path)
        out = self._spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path, out
        self.remove(*instead_of)
        return out

    def remove(self, *tables: DataFrame) -> None:
        for table in tables:
            path, _ = self._paths.pop(id(table), (None, None))
            if path:
                remove_folder(self._spark, path)

    def keep_only(self, *tables: DataFrame) -> None:
        kept = {id(t) for t in tables}
        self.remove(*(t for k, (_, t) in list(self._paths.items()) if k not in kept))


def remove_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """``df.filter(condition)`` after its columns are computed.

    The optimiser pushes a plain filter below the projections it reads from, and
    writes their expressions into it again, once for each mention; for long chains
    over whole texts that costs far more than the rows it saves.  A condition
    that needs a row number can't be pushed there."""
    number = fresh_name(df, "row_number")
    return df.withColumn(number, F.monotonically_increasing_id()).filter(condition & (F.col(number) >= 0)).drop(number)


_shipped: set[str] = set()


def map_batches(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow``, with this package on the executors' Python path (once
    for each application), so that they need no installation of it."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(), "contrail.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(archive)
        _shipped.add(sc.applicationId)
    return df.mapInArrow(function, schema)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text: runs of anything but ASCII white space."""
    return F.array_remove(F.split(text, SPACE), "")


def fresh_name(df: DataFrame, wish: str) -> str:
    """``wish``, or a longer name where ``df`` already has such a column."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish
