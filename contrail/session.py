"""Session construction and the shared scratch area.

A session that spark-submit (or the caller) has configured stays as it is: the
master, the shuffle partitions and every setting given there win over the
defaults below.

On a cluster the scratch area lives under the shared folder named by
``spark.checkpoint.dir``, and it is an error not to name one; only a local
master (unit tests, a laptop) gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the library relies on.  Dynamic partition overwrite is the
# session default so ``insertInto`` never wipes untouched months (see
# operators/sinks.py); full replaces ask for static mode explicitly.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}

# Static settings (only effective when this library starts the session).
# Capturing the Python call site of every Column operation costs several JVM
# round trips each, and the plans here are built from thousands of them.
STATIC_CONF = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Defaults for a cluster (any master that isn't local).  Input splits and
# shuffle partitions aim at the same size; estimate-based broadcasts stay small
# (10 MB), and AQE may still broadcast a side whose *measured* size is under its
# own threshold.  AQE only merges shuffle partitions, so their number is an upper
# bound: `shuffle_partitions_for` takes it from the input.
CLUSTER_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxRecordsPerFile": "20000000",
}

SHUFFLE_BYTES = 256 << 20


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "contrail", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    ``master``, ``shuffle_partitions`` and ``extra`` are set only when given.
    Otherwise the session takes what spark-submit or the environment says (Spark's own
    default is ``local[*]``); see :func:`configure` for the rest.
    """
    builder = SparkSession.builder.appName(app_name)
    given = dict(extra or {})
    if master:
        given["spark.master"] = master
    if shuffle_partitions:
        given["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if SparkSession.getActiveSession() is None:
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        for key, value in STATIC_CONF.items():
            builder = builder.config(key, value)
    for key, value in given.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the defaults to whatever the session's configuration leaves open."""
    told = spark.sparkContext.getConf()
    defaults = dict(SESSION_CONF)
    if is_local(spark):
        # Spark's default of 200 is for clusters: one per core here.
        defaults["spark.sql.shuffle.partitions"] = str(max(8, spark.sparkContext.defaultParallelism))
    else:
        defaults |= CLUSTER_CONF
    for key, value in defaults.items():
        if not told.contains(key):
            spark.conf.set(key, value)
    return spark


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Shuffle partitions for an input of that size: 256 MB each, and at least
    one for each core (400,000 for 100 TB)."""
    return max(cores, -(-input_bytes // SHUFFLE_BYTES))


def size_shuffles(spark: SparkSession, *tables: DataFrame) -> int:
    """Set the shuffle partitions from the size of the tables a job will read,
    unless the session's configuration names a number; returns the number."""
    key = "spark.sql.shuffle.partitions"
    if not spark.sparkContext.getConf().contains(key) and not is_local(spark):
        size = sum(int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables)
        spark.conf.set(key, str(shuffle_partitions_for(size, spark.sparkContext.defaultParallelism)))
    return int(spark.conf.get(key))


def _checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not is_local(spark):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="contrail-ckpt-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, label: str = "work") -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = _checkpoint_root(spark).rstrip("/")
    return f"{root}/contrail-{label}-{uuid.uuid4().hex[:12]}"


_known_jvm: list = [None, None]


def _path(spark: SparkSession, path: str):
    """A Hadoop path; its class is looked up once, as every package on the way is a call."""
    jvm = spark.sparkContext._jvm
    if _known_jvm[0] is not jvm:
        _known_jvm[:] = jvm, jvm.org.apache.hadoop.fs.Path
    return _known_jvm[1](path)


def _file_system(spark: SparkSession, path: str):
    p = _path(spark, path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made, once nothing reads it any more."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path`` (none if it doesn't exist)."""
    fs, p = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder or file; the target must not exist, its parent may."""
    fs, to = _file_system(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(_path(spark, source), to):
        raise OSError(f"can't move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or not there: written beside its place, then renamed."""
    fs, p = _file_system(spark, path)
    part = _path(spark, f"{path.rsplit('/', 1)[0]}/.{path.rsplit('/', 1)[1]}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, p):
        raise OSError(f"can't write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
