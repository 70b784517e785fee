"""Benchmark decontamination with a hash set of normalised n-grams.

The windows of all benchmark items (10 consecutive words, or a whole item that
is shorter) form a set of hashes.  Each training text is turned into its window
hashes on the spot, which probe the set; a hit is verified by a second,
independent 64-bit hash of its words (reading the words again would take the texts
through a shuffle), and spans or documents are removed.

The set is broadcast while it has at most ``MAX_BROADCAST_WINDOWS`` windows,
counted first; a larger one is joined by shuffling.  Texts are read once; only
hits and counts are shuffled, and texts only where documents have to be changed.
DataFrame expressions only.

Defined cases: a null text has no words; very long texts are scanned whole; a word
inside windows of several items is one hit word and each of the items is named (ties);
an item without words has no windows;
repeated items count once; repeated document rows each get their row, on their
own words; an empty benchmark hits nothing, an empty table gives an empty
result; other columns are kept by :func:`remove_documents` and
:func:`remove_spans`, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import cut, text_or_empty

WINDOW = 10
#: Fixed value: what lies between words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MAX_BROADCAST_WINDOWS = 500_000


def normalised_words(text: Column) -> Column:
    """Words with A to Z lowered; other capitals stay."""
    lowered = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def with_window_hashes(df: DataFrame, words: str, sizes: list[int]) -> DataFrame:
    """``df`` with columns h<size>: two independent hashes (a, b) of all windows of
    that many words, in order.  Hashes of 1, 2, 4 and 8 words are joined by the
    bits of the size."""
    for k, seed in enumerate("ab"):
        df = df.withColumn(f"{seed}_1", F.transform(F.col(words), (lambda x: F.xxhash64(x)) if not k else (lambda x: F.xxhash64(F.lit(seed), x))))
        powers = {1: f"{seed}_1"}
        for p in (2, 4, 8):
            if max(sizes) >= p:
                half = powers[p // 2]
                df = df.withColumn(f"{seed}_{p}", _joined(half, half, p // 2))
                powers[p] = f"{seed}_{p}"
        for size in sizes:
            parts = [p for p in (8, 4, 2, 1) if size & p]
            df = df.withColumn(f"{seed}{size}", F.col(powers[parts[0]]))
            done = parts[0]
            for p in parts[1:]:
                df = df.withColumn(f"{seed}{size}", _joined(f"{seed}{size}", powers[p], done))
                done += p
        df = df.drop(*powers.values())
    for size in sizes:
        whole = F.arrays_zip(F.col(f"a{size}").alias("a"), F.col(f"b{size}").alias("b"))
        df = df.withColumn(f"h{size}", F.slice(whole, F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(0)))).drop(f"a{size}", f"b{size}")
    return df


def _joined(left: str, right: str, shift: int) -> Column:
    return F.zip_with(F.col(left), F.slice(F.col(right), F.lit(shift + 1), F.size(left)), lambda a, b: F.xxhash64(a, b))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """size, hash, gram (its words) and items of every distinct window."""
    said = benchmark.select(F.col("item_id").cast("string").alias("item_id"), normalised_words(text_or_empty()).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    grams = said.select("item_id", "w", size.alias("size"), F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("at"))
    grams = grams.select("item_id", "size", F.slice("w", F.col("at"), F.col("size")).alias("gram"))
    return grams.groupBy("size", "gram").agg(F.collect_set("item_id").alias("items"))


def _hashed(grams: DataFrame, sizes: list[int]) -> DataFrame:
    hashed = with_window_hashes(grams, "gram", sizes)
    own = F.coalesce(*[F.when(F.col("size") == s, F.element_at(f"h{s}", 1)) for s in sizes])
    return hashed.select(F.col("size").alias("its_size"), own["a"].alias("its_a"), own["b"].alias("its_b"), "items")


_HITS = "array<struct<at:int,size:int,items:array<string>>>"


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """id, copy (hash of the text), n_words, n_rows (how many rows have that id
    and text) and verified ``hits``: (at, size, items), at from 0."""
    t = text_or_empty()
    said = docs.select(F.col("doc_id").alias("id"), F.xxhash64(t).alias("copy"), normalised_words(t).alias("words"))
    none = F.array().cast(_HITS)
    grams = cut(benchmark_windows(benchmark, window))
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect())  # at most `window` numbers
    if not sizes:
        return said.groupBy("id", "copy").agg(F.max(F.size("words")).cast("long").alias("n_words"), F.count("*").alias("n_rows")).withColumn("hits", none)
    table = _hashed(grams, sizes)
    if grams.count() <= MAX_BROADCAST_WINDOWS:
        table = F.broadcast(table)
    hashed = with_window_hashes(said, "words", sizes)
    found = None
    for s in sizes:
        # The outer form: a text without windows keeps a row, and the optimiser doesn't filter by the
        # size of the array first, for which it would compute it many times.
        probe = hashed.select("id", "copy", F.size("words").alias("n"), F.posexplode_outer(f"h{s}").alias("at", "hash")).withColumns(
            {"size": F.lit(s), "first": (F.lit(s == sizes[0]) & (F.coalesce("at", F.lit(0)) == 0)).cast("int")})
        found = probe if found is None else found.unionByName(probe)
    # Probed by one hash, verified by the other.
    same = (F.col("size") == F.col("its_size")) & (F.col("hash.a") == F.col("its_a"))
    met = found.join(table, same, "left").withColumn("hit", F.coalesce(F.col("hash.b") == F.col("its_b"), F.lit(False)))
    return met.filter("hit or first = 1").groupBy("id", "copy").agg(
        F.max("n").cast("long").alias("n_words"), F.sum("first").alias("n_rows"),
        F.collect_set(F.when(F.col("hit"), F.struct("at", "size", "items"))).alias("hits"))


def covered(hits: Column) -> Column:
    """The places of words that lie in a hit."""
    return F.array_distinct(F.flatten(F.transform(hits, lambda x: F.sequence(x["at"], x["at"] + x["size"] - 1))))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each row."""
    found = find_hits(docs, benchmark, window)
    items = F.sort_array(F.array_distinct(F.flatten(F.transform("hits", lambda x: x["items"]))))
    told = found.select(F.col("id").alias("doc_id"), "n_words", F.size(covered(F.col("hits"))).cast("long").alias("n_hit"), items.alias("items"), "n_rows")
    told = told.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
                       F.explode(F.sequence(F.lit(1).cast("long"), "n_rows")).alias("row"))
    return told.drop("row")


def _with_hits(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """``docs`` as one struct ``row``, with ``hits`` (null where there are none)."""
    hits = cut(find_hits(docs, benchmark, window).select("id", "copy", "hits")).filter(F.size("hits") > 0)
    given = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64(text_or_empty()).alias("own_copy"))
    return given.join(hits, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_copy") == F.col("copy")), "left").select("row", "hits")


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit; same columns."""
    return _with_hits(docs, benchmark, window).filter("hits is null").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All documents, the hit words and what follows each of them cut out of
    their texts; same columns."""
    found = _with_hits(docs, benchmark, window)
    between, word = BETWEEN[:-1], "[^" + BETWEEN[1:-2] + "]+"
    text = F.col("row")["text"]
    lead = F.regexp_extract(text, f"^{between}*", 0)
    tokens = F.regexp_extract_all(text, F.lit(f"{word}{between}*"), F.lit(0))
    left = F.filter(F.col("tokens"), lambda _, i: ~F.array_contains(F.col("places"), i))
    cleaned = F.when(F.col("hits").isNull(), text).otherwise(F.concat(lead, F.array_join(left, "")))
    out = found.withColumn("tokens", F.when(F.col("hits").isNotNull(), tokens)).withColumn("places", covered(F.col("hits"))).withColumn("cleaned", cleaned)
    return out.select(*[(F.col("cleaned") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])
