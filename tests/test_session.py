"""A submitted session keeps its settings; scratch needs a shared folder."""

import os
import subprocess
import sys
import tempfile

import pytest

from contrail.session import scratch_dir, shuffle_partitions_for

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = """
from contrail.session import get_session
spark = get_session()
print("GOT", spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.session.timeZone"))
"""


def submitted(*options):
    with tempfile.NamedTemporaryFile("w", suffix=".py", delete=False) as f:
        f.write(PROGRAM)
    submit = os.path.join(os.path.dirname(__import__("pyspark").__file__), "bin", "spark-submit")
    env = {**os.environ, "PYTHONPATH": REPO, "PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable}
    out = subprocess.run(["timeout", "120", submit, *options, "--conf", "spark.ui.enabled=false", f.name], env=env, capture_output=True, text=True)
    return next((x.split()[1:] for x in out.stdout.splitlines() if x.startswith("GOT")), out.stderr[-2000:])


def test_spark_submit_keeps_master_and_settings():
    got = submitted("--master", "local[2]", "--conf", "spark.sql.shuffle.partitions=4321", "--conf", "spark.sql.session.timeZone=Asia/Tokyo")
    assert got == ["local[2]", "4321", "Asia/Tokyo"]


def test_defaults_fill_what_is_left_open():
    assert submitted("--master", "local[2]") == ["local[2]", "8", "UTC"]


def test_scratch_without_a_shared_folder_is_refused_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session())


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions_for(100 << 40, 4000) == 409_600
    assert shuffle_partitions_for(1 << 20, 8) == 8
