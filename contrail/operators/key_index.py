"""Where keys live: a Bloom filter and a key range for each partition of a table.

A merge has to find the partitions in which a batch's keys are stored.  Instead
of reading the key column of all history, it asks the index, which is stored
beside the table with the same partitions and is rewritten only with them:

* the keys of a partition are dealt into slots of 32,768 bits by their hash, as
  many slots (a power of two) as ``BITS_PER_KEY`` asks for; in its slot a key sets
  ``PROBES`` bits, which Spark's bitmap aggregates collect, one for each probe, and join;
* a lookup deals the batch in the same way, once for each number of slots in
  use, and joins slot with slot: as many rows as the index has, never one for
  each pair of key and partition.

A key range that doesn't meet the batch's leaves a partition out at once.  What the
filter names may be wrong for a few keys in 100,000, never what it leaves out: the caller
confirms by reading the keys of the named partitions alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT_BITS = 32_768
BITS_PER_KEY = 32
PROBES = 6
MAX_SLOTS = 1 << 20
ASKED_KEYS = 4096


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _slot(h: Column, slots: Column) -> Column:
    return F.pmod(h, slots)


def _probes(h: Column) -> list[Column]:
    """The bits that a key sets in its slot, from its hash."""
    return [F.pmod(F.xxhash64(h, F.lit(i)), F.lit(SLOT_BITS)) for i in range(PROBES)]


def index_rows(rows: DataFrame, keys: Sequence[str], partition_cols: Sequence[str]) -> DataFrame:
    """The index of ``rows``: partition columns, slots, slot, lo, hi (the least and
    largest key of the partition, as far as the first key column goes), bits."""
    by = list(partition_cols)
    first = F.col(keys[0]).cast("string") if len(keys) > 1 else F.col(keys[0])
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min(first).alias("lo"), F.max(first).alias("hi"))
    doubled = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("_n") * (BITS_PER_KEY / SLOT_BITS), F.lit(1.0)))))
    sizes = sizes.withColumn("slots", F.least(doubled, F.lit(float(MAX_SLOTS))).cast("int")).drop("_n")
    sizes = F.broadcast(sizes.select(*[F.col(c).alias(f"_p_{c}") for c in by], "slots", "lo", "hi"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    # One narrow row for each key is dealt before anything is sorted: bitmap aggregates sort
    # their input, which would be all rows of a file with a row for each bit.
    keyed = rows.select(*by, _hash(keys).alias("h")).join(sizes, on=same, how="inner")
    keyed = keyed.select(*by, _slot(F.col("h"), F.col("slots")).cast("int").alias("slot"), "h").repartition(*by, "slot")
    probes, each = _probes(F.col("h")), [f"_bits_{i}" for i in range(PROBES)]
    maps = keyed.groupBy(*by, "slot").agg(*[F.bitmap_construct_agg(probes[i]).alias(n) for i, n in enumerate(each)])
    maps = maps.select(*by, "slot", F.explode(F.array(*each)).alias("bits")).groupBy(*by, "slot").agg(F.bitmap_or_agg("bits").alias("bits"))
    return maps.join(sizes, on=same, how="inner").select(*by, "slots", "slot", "lo", "hi", "bits")


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.ascii(F.decode(F.substring(bits, (bit / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    return F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def partitions_of(index: DataFrame, batch: DataFrame, keys: Sequence[str], partition_cols: Sequence[str]) -> DataFrame:
    """The partitions (distinct) of ``index`` that may hold a key of ``batch``."""
    first = F.col(keys[0]).cast("string") if len(keys) > 1 else F.col(keys[0])
    known = [r["slots"] for r in index.select("slots").distinct().collect()]  # at most 21 powers of two
    if not known:
        return index.select(*partition_cols)
    asked = batch.select(_hash(keys).alias("h"), first.alias("key")).where("key is not null")
    # Lists of about ASKED_KEYS, however large the batch is beside the partitions.
    lists = F.greatest(F.ceil(F.lit(batch.count() / ASKED_KEYS) / F.col("_slots")), F.lit(1))
    asked = asked.select("h", "key", F.explode(F.array(*[F.lit(s) for s in known])).alias("_slots"))
    asked = asked.select("_slots", _slot(F.col("h"), F.col("_slots")).cast("int").alias("_slot"), F.pmod(F.xxhash64("h"), lists).alias("_list"),
                         "key", F.array(*_probes(F.col("h"))).alias("probes"))
    asked = asked.groupBy("_slots", "_slot", "_list").agg(F.collect_list(F.struct("key", "probes")).alias("asked"))
    both = index.join(asked, on=(F.col("slots") == F.col("_slots")) & (F.col("slot") == F.col("_slot")))
    # Lists are opened where they meet a slot, and what they hold is dropped in the same
    # compiled loop: the first bit that isn't set ends a key.
    each = both.select(*partition_cols, "lo", "hi", "bits", F.explode("asked").alias("a"))
    hit = (F.col("a.key") >= F.col("lo")) & (F.col("a.key") <= F.col("hi"))
    for i in range(PROBES):
        hit = hit & _is_set(F.col("bits"), F.col("a.probes")[i])
    return each.where(hit).select(*partition_cols).distinct()
