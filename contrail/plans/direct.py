"""The generic operators and column functions applied straight to the
generated star schema (no flight mapping).  They exercise the same code
paths on the largest table, ``lineitem`` (whose (order, line) pairs repeat — a
real dedup input), and the column functions on customers, orders, events
and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions import (band, clean, count_where, flag_gt, hhmm_to_minute, minute_to_hour,
                                null_if_above, rate_pct, round_half_up, surrogate_key)
from contrail.operators.dedup import dedup_first
from contrail.operators.joins import join_best
from contrail.operators.reshape import banded_summary, usage_totals
from contrail.sources.feed import read_driver

# Band edges for the line-item stacked summary.
QUANTITY_BANDS = (("<", 10, "quantity under 10"), ("<", 25, "quantity 10 to 25"), ("<", 40, "quantity 25 to 40"))
DISCOUNT_BANDS = (("==", 0, "no discount"), ("<", 0.05, "small discount"), ("<", 0.08, "medium discount"))
TAX_BANDS = (("==", 0, "no tax"), ("<", 0.04, "low tax"), ("<", 0.07, "medium tax"))


def first_shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line item per (order, line number): the earliest shipment, ties
    broken by every other column."""
    li = read_driver(spark, sf_dir, "lineitem")
    return dedup_first(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").asc_nulls_last()])


def lineitem_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity, discount and tax bands of every line item stacked into
    (condition, band) rows with counts, a rate and rounded measures."""
    li = read_driver(spark, sf_dir, "lineitem")
    conditions = {
        "quantity": band("l_quantity", QUANTITY_BANDS, "quantity 40 or more", "unknown"),
        "discount": band("l_discount", DISCOUNT_BANDS, "large discount", "unknown"),
        "tax": band("l_tax", TAX_BANDS, "high tax", "unknown"),
    }
    summary = banded_summary(
        li.select("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_extendedprice"), conditions,
        [F.count(F.lit(1)).cast("bigint").alias("line_count"),
         count_where(F.col("l_returnflag") == "R").alias("returned_count"),
         F.avg("l_quantity").alias("_avg_qty"),
         F.median("l_quantity").alias("_median_qty"),
         F.percentile("l_quantity", 0.9).alias("_p90_qty")])
    return summary.select(
        "condition_type", "condition_band", "line_count", "returned_count",
        rate_pct("returned_count", "line_count").alias("returned_rate_pct"),
        round_half_up("_avg_qty", 2).alias("avg_quantity"),
        round_half_up("_median_qty", 2).alias("median_quantity"),
        round_half_up("_p90_qty", 2).alias("p90_quantity"),
    )


def best_part_per_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item joined to the best-ranked part of its part's brand
    (lowest name, then lowest key) — the rank-1 reference join at line-item
    scale."""
    li = read_driver(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = read_driver(spark, sf_dir, "part")
    brands = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    ref = part.select(F.col("p_brand").alias("ref_brand"), F.col("p_name").alias("best_name"),
                      F.col("p_partkey").alias("best_partkey"))
    # The few brands are resolved among the parts; line items are joined once, on the part key.
    best = join_best(brands, ref, "brand", "ref_brand",
                     [F.col("best_name").asc_nulls_last(), F.col("best_partkey").asc_nulls_last()])
    out = li.join(best.select("l_partkey", "brand", "best_name", "best_partkey"), "l_partkey", "left")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "brand", "best_name", "best_partkey")


def key_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each key value appears as a part key or a supplier key of a
    line item (counts per role summed), two-level aggregate in one scan."""
    li = read_driver(spark, sf_dir, "lineitem")
    return usage_totals(li, ["l_partkey", "l_suppkey"], "key_value", "usage_count")


# Part size classes (upper bound exclusive).
SIZE_BANDS = (("<", 10, "small"), ("<", 30, "medium"))


def customer_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank-to-NULL cleaning and a coalesced display name.  Every seventh
    customer's name arrives blank (spaces only); the others padded."""
    c = read_driver(spark, sf_dir, "customer")
    raw_name = F.when(F.col("c_custkey") % 7 == 0, F.lit("   ")) \
        .otherwise(F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")))
    return c.select(
        F.col("c_custkey").alias("customer_key"),
        clean(raw_name).alias("customer_name"),
        clean("c_mktsegment").alias("segment"),
        F.coalesce(clean(raw_name), clean("c_mktsegment")).alias("display_name"),
    )


def order_clock_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An integer clock per order (``o_orderkey % 2401``, so 2400 and
    out-of-range minutes occur) decoded to minutes past midnight and hour."""
    o = read_driver(spark, sf_dir, "orders")
    hhmm = (F.col("o_orderkey") % 2401).alias("clock_hhmm")
    minute = hhmm_to_minute(hhmm)
    return o.select(F.col("o_orderkey"), hhmm, minute.alias("minute_of_day"),
                    minute_to_hour(minute).alias("hour_of_day"))


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-field surrogate keys, one field NULL on every fifth order."""
    o = read_driver(spark, sf_dir, "orders")
    priority = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority"))
    return o.select(
        F.col("o_orderkey"),
        surrogate_key("o_orderkey").alias("order_key"),
        surrogate_key(F.col("o_orderkey"), F.col("o_orderdate").cast("date"), priority).alias("order_version_key"),
    )


def clamped_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event readings above 200 nulled as implausible; a three-valued flag
    defaulted to false."""
    e = read_driver(spark, sf_dir, "events")
    clamped = null_if_above("value", 200)
    return e.select("event_id", clamped.alias("reading"), flag_gt(clamped, 100).alias("is_high"))


def part_size_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered threshold bands with a NULL class (every eleventh size unknown)."""
    p = read_driver(spark, sf_dir, "part")
    size = F.when(F.col("p_partkey") % 11 != 0, F.col("p_size"))
    return p.select("p_partkey", size.alias("size"), band(size, SIZE_BANDS, "large", "unknown").alias("size_class"))
