"""Incremental fact maintenance and type-2 history."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from contrail.operators.history import scd2_snapshot
from contrail.operators.incremental import (high_water_mark, incremental_filter, upsert_by_key,
                                            write_incremental)

SCHEMA = "k bigint, d date, v string, y int, m int"


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def stored(spark, path):
    return sorted((r.k, r.d, r.v, r.y, r.m) for r in spark.read.parquet(path).select("k", "d", "v", "y", "m").collect())


def test_upsert_by_key(spark):
    old = table(spark, [(1, dt.date(2013, 1, 1), "a", 2013, 1), (2, dt.date(2013, 1, 2), "b", 2013, 1)])
    new = table(spark, [(2, dt.date(2013, 1, 2), "B", 2013, 1), (3, dt.date(2013, 1, 3), "c", 2013, 1)])
    out = sorted((r.k, r.v) for r in upsert_by_key(old, new, ["k"]).collect())
    assert out == [(1, "a"), (2, "B"), (3, "c")]


def test_high_water_mark_and_filter(spark):
    old = table(spark, [(1, dt.date(2013, 1, 5), "a", 2013, 1)])
    assert high_water_mark(None, "d") == dt.date(1900, 1, 1)
    assert high_water_mark(old, "d") == dt.date(2013, 1, 5)
    new = table(spark, [(1, dt.date(2013, 1, 4), "late", 2013, 1), (2, dt.date(2013, 1, 5), "same", 2013, 1)])
    assert [r.k for r in incremental_filter(new, old, "d").collect()] == [2]
    assert sorted(r.k for r in incremental_filter(new, old, "d", lookback_days=1).collect()) == [1, 2]


def test_write_incremental_replay_change_move(spark):
    path = tempfile.mkdtemp(prefix="contrail-fact-") + "/t"
    first = table(spark, [(1, dt.date(2013, 1, 1), "a", 2013, 1), (2, dt.date(2013, 1, 31), "b", 2013, 1),
                          (3, dt.date(2013, 2, 1), "c", 2013, 2)])
    write_incremental(spark, first, path, ["k"], ["y", "m"])
    # replay of the same batch changes nothing
    write_incremental(spark, first, path, ["k"], ["y", "m"])
    assert len(stored(spark, path)) == 3
    # a changed row and a key moving from January to March
    batch = table(spark, [(3, dt.date(2013, 2, 1), "C", 2013, 2), (2, dt.date(2013, 3, 1), "moved", 2013, 3)])
    touched = write_incremental(spark, batch, path, ["k"], ["y", "m"])
    assert set(touched) == {(2013, 1), (2013, 2), (2013, 3)}
    assert stored(spark, path) == [(1, dt.date(2013, 1, 1), "a", 2013, 1),
                                   (2, dt.date(2013, 3, 1), "moved", 2013, 3),
                                   (3, dt.date(2013, 2, 1), "C", 2013, 2)]
    # the only key of a month moves away: the month is emptied, not left stale
    write_incremental(spark, table(spark, [(1, dt.date(2013, 3, 2), "a2", 2013, 3)]), path, ["k"], ["y", "m"])
    months = {(r.y, r.m) for r in spark.read.parquet(path).select("y", "m").distinct().collect()}
    assert months == {(2013, 2), (2013, 3)}


T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
SNAP = "ident string, name string, country string"


def test_scd2_versions(spark):
    v1 = spark.createDataFrame([("A", "a", "X"), ("B", "b", "X"), ("C", "c", "X"), ("D", None, "X")], SNAP)
    h1 = scd2_snapshot(v1, None, "ident", ["name"], T1)
    assert h1.count() == 4 and h1.where("valid_to is null").count() == 4
    # A renamed, B changes an unchecked column only, C deleted, D's NULL name unchanged
    v2 = spark.createDataFrame([("A", "a2", "X"), ("B", "b", "Y"), ("D", None, "X")], SNAP)
    h2 = scd2_snapshot(v2, h1, "ident", ["name"], T2)
    got = sorted((r.ident, r.name, r.country, r.valid_from, r.valid_to) for r in h2.collect())
    assert got == [("A", "a", "X", T1, T2), ("A", "a2", "X", T2, None), ("B", "b", "X", T1, None),
                   ("C", "c", "X", T1, T2), ("D", None, "X", T1, None)]
    # rerun of the same snapshot is a no-op
    again = scd2_snapshot(v2, h2, "ident", ["name"], T2)
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in h2.collect())
    # C comes back
    v3 = spark.createDataFrame([("A", "a2", "X"), ("B", "b", "Y"), ("C", "c", "X"), ("D", None, "X")], SNAP)
    h3 = scd2_snapshot(v3, h2, "ident", ["name"], T3)
    c_rows = sorted((r.valid_from, r.valid_to) for r in h3.where("ident = 'C'").collect())
    assert c_rows == [(T1, T2), (T3, None)]
    assert h3.where(F.col("valid_to").isNull()).count() == 4
    assert h3.select("version_id").distinct().count() == h3.count()


def _stored(spark, path):
    return sorted((r.k, r.v, r.p) for r in spark.read.parquet(path).collect())


def test_a_batch_with_a_row_and_its_correction(spark):
    import pytest
    path = tempfile.mkdtemp(prefix="contrail-dup-") + "/t"
    rows_of = lambda data: spark.createDataFrame(data, "k bigint, v bigint, p int")
    write_incremental(spark, rows_of([(1, 1, 1), (2, 1, 1)]), path, ["k"], ["p"])
    batch = rows_of([(2, 2, 1), (2, 3, 2), (3, 1, 2)])
    with pytest.raises(ValueError, match="several rows of a key"):
        write_incremental(spark, batch, path, ["k"], ["p"])
    assert _stored(spark, path) == [(1, 1, 1), (2, 1, 1)]
    write_incremental(spark, batch, path, ["k"], ["p"], latest_by=["v"])
    assert _stored(spark, path) == [(1, 1, 1), (2, 3, 2), (3, 1, 2)]


def test_rows_without_a_partition_value(spark):
    path = tempfile.mkdtemp(prefix="contrail-null-") + "/t"
    rows_of = lambda data: spark.createDataFrame(data, "k bigint, v bigint, p int")
    write_incremental(spark, rows_of([(1, 1, None), (2, 1, None)]), path, ["k"], ["p"])
    write_incremental(spark, rows_of([(2, 2, None), (3, 1, 5)]), path, ["k"], ["p"])
    got = {r.k: (r.v, r.p) for r in spark.read.parquet(path).collect()}
    assert got == {1: (1, None), 2: (2, None), 3: (1, 5)}
    write_incremental(spark, rows_of([(1, 2, 5), (2, 3, 5)]), path, ["k"], ["p"])
    assert _stored(spark, path) == [(1, 2, 5), (2, 3, 5), (3, 1, 5)]


def test_a_snapshot_row_without_a_key_is_refused(spark):
    import pytest
    from pyspark.errors import PySparkException
    rows_of = spark.createDataFrame([("a", "x"), (None, "y")], "id string, c string")
    with pytest.raises(PySparkException, match="without id"):
        scd2_snapshot(rows_of, None, "id", ["c"], dt.datetime(2024, 1, 1)).collect()



def test_a_merge_reads_no_partition_that_it_does_not_change(spark):
    """Files of untouched partitions are taken away: the merge never misses them."""
    import glob
    import os
    import shutil
    path = tempfile.mkdtemp(prefix="contrail-index-") + "/t"
    rows_of = lambda data: spark.createDataFrame(data, "k bigint, v bigint, p int")
    write_incremental(spark, rows_of([(i, 0, i % 12) for i in range(6000)]), path, ["k"], ["p"])
    # The first merge makes the index.
    write_incremental(spark, rows_of([(5, 1, 5)]), path, ["k"], ["p"])
    index = sorted(os.listdir(f"{path}/_keys"))
    assert sum(n.startswith("p=") for n in index) == 12
    batch = rows_of([(7, 2, 8), (9000, 2, 8), (20, 2, 8)])  # moves from 7 to 8, is new, stays in 8
    away = tempfile.mkdtemp()
    for p in range(12):
        if p not in (7, 8):
            # A file of the name is there, but no reader could open it.
            for name in glob.glob(f"{path}/p={p}/*.parquet"):
                shutil.copy(name, f"{away}/{p}-{os.path.basename(name)}")
                with open(name, "wb") as fh:
                    fh.write(b"nothing")
                crc = os.path.join(os.path.dirname(name), "." + os.path.basename(name) + ".crc")
                if os.path.exists(crc):
                    os.remove(crc)
    assert set(write_incremental(spark, batch, path, ["k"], ["p"])) == {(7,), (8,)}
    for name in os.listdir(away):
        p, file = name.split("-", 1)
        shutil.copy(f"{away}/{name}", f"{path}/p={p}/{file}")
    got = {r.k: (r.v, r.p) for r in spark.read.parquet(path).collect()}
    assert len(got) == 6001 and got[7] == (2, 8) and got[20] == (2, 8) and got[9000] == (2, 8) and got[5] == (1, 5)
    # The index follows: 7 is found in its new place.
    assert set(write_incremental(spark, rows_of([(7, 3, 1)]), path, ["k"], ["p"])) == {(1,), (8,)}


def test_the_key_index_names_every_place_and_few_others(spark):
    from contrail.operators.key_index import index_rows, partitions_of
    rows = spark.range(200_000).selectExpr("CAST(id AS STRING) AS k", "CASE WHEN id % 50 < 49 THEN id % 50 END AS p", "id % 3 AS q")
    index = index_rows(rows, ["k"], ["p", "q"])
    asked = spark.createDataFrame([("17",), ("49",), ("100000",)], "k string")
    found = {tuple(r) for r in partitions_of(index, asked, ["k"], ["p", "q"]).collect()}
    own = {(17, 17 % 3), (None, 49 % 3), (0, 100000 % 3)}
    assert own <= found and len(found) <= len(own) + 3
    none = spark.createDataFrame([("x",), (None,)], "k string")
    assert partitions_of(index, none, ["k"], ["p", "q"]).count() <= 3
    pairs = index_rows(rows, ["k", "q"], ["p"])
    two = spark.createDataFrame([("17", 2), ("18", 1)], "k string, q bigint")
    assert {17} <= {r.p for r in partitions_of(pairs, two, ["k", "q"], ["p"]).collect()} <= {17, 18, None} | set(range(50))


def test_the_key_index_makes_no_row_for_each_bit(spark):
    from contrail.operators.key_index import PROBES, SLOT_BITS, index_rows
    rows = spark.range(20_000).selectExpr("id AS k", "CASE WHEN id % 3 > 0 THEN id % 3 END AS p")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        index = index_rows(rows, ["k"], ["p"])
        found = index.collect()
        plan = index._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)

    def generated(node):
        own = node.metrics().apply("numOutputRows").value() if node.nodeName() == "Generate" else 0
        return own + sum(generated(node.children().apply(i)) for i in range(node.children().size()))

    # A row for each slot and probe, of which there are few, and never for each key and probe.
    assert len(found) == 3 * 8 and generated(plan) <= PROBES * len(found)
    assert {(r.p, r.slots, r.lo, r.hi) for r in found} == {(None, 8, 0, 19_998), (1, 8, 1, 19_999), (2, 8, 2, 19_997)}
    # The bits are those that the keys set, one by one.
    own = {(r.p, r.slot): bytearray(SLOT_BITS // 8) for r in found}
    for r in rows.selectExpr("p", "pmod(xxhash64(k), 8) AS slot",
                             f"transform(sequence(0, {PROBES - 1}), i -> pmod(xxhash64(xxhash64(k), i), {SLOT_BITS})) AS bits").collect():
        for bit in r.bits:
            own[r.p, r.slot][bit // 8] |= 1 << bit % 8
    assert {(r.p, r.slot): bytes(r.bits) for r in found} == {at: bytes(bits) for at, bits in own.items()}


def test_closed_versions_are_written_once(spark):
    import os
    from contrail.operators.history import read_snapshots, write_snapshot
    path = tempfile.mkdtemp(prefix="contrail-snap-") + "/s"
    take = lambda names, at: write_snapshot(spark, path, spark.createDataFrame(names, SNAP), "ident", ["name"], at)
    files = lambda: {f"{d}/{n}" for d, _, names in os.walk(f"{path}/closed") for n in names if n.endswith(".parquet")}
    take([("A", "a", "X"), ("B", "b", "X")], T1)
    assert not files()
    take([("A", "a2", "X"), ("B", "b", "X")], T2)
    first = files()
    assert first
    again = take([("A", "a2", "X"), ("B", "b", "X")], T2)  # nothing changes
    assert files() == first
    expected = None
    for names, at in (([("A", "a", "X"), ("B", "b", "X")], T1), ([("A", "a2", "X"), ("B", "b", "X")], T2), ([("A", "a3", "X")], T3)):
        expected = scd2_snapshot(spark.createDataFrame(names, SNAP), expected, "ident", ["name"], at)
    third = take([("A", "a3", "X")], T3)
    assert first < files() and again is not third
    assert sorted(map(str, read_snapshots(spark, path).collect())) == sorted(map(str, expected.select(*third.columns).collect()))
    # Everything deleted: no open version is left, and the history stays.
    gone = write_snapshot(spark, path, spark.createDataFrame([], SNAP), "ident", ["name"], dt.datetime(2024, 4, 1))
    assert gone.where("valid_to is null").count() == 0 and gone.count() == 4
    back = take([("A", "a3", "X")], dt.datetime(2024, 5, 1))
    assert back.count() == 5 and back.where("valid_to is null").count() == 1
