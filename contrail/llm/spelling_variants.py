"""Spelling variants over a bit-sliced position index.

The vocabulary comes from all texts: maximal runs of letters, A to Z lowered,
some with one letter lost (a fixed rule of document and run), counted by Spark.
Two words are near if one inserted, deleted or replaced letter parts them.

1. Nodes.  A word of ``L`` letters is cut after ``L // 2`` of them; whatever single
   error there is lies in one of the halves, so the other one is found unchanged
   at the same end of a near word.  Every word goes, as a query, to the nodes
   (length, half, its letters) of all lengths that a near word can have, and as an
   entry to those of its own length: six rows a word, however many share a node.
2. A node of more than ``NODE_ROWS`` rows is cut again in the same way, over the
   half that isn't shared, until it is small enough or one letter is left
   (then it holds no more words than there are letters).  So a very common
   beginning or ending never lands in one task, and none is dropped.
3. Bit-sliced index.  In a node, one bitset over its entries for each (place,
   letter).  A query runs through its letters once and keeps two sets, the
   entries met so far without and with one error; each letter takes a few
   word-parallel operations on whole bitsets, with the places shifted by one
   after an inserted or deleted letter.
4. A pair that several nodes hold is counted in the first one only (found by
   cutting both words again, which also undoes hash collisions of nodes).
   Only each query's count and best entry leave a node, never the pairs.

A word's form is the near word of largest count (ties: smallest), if that has at
least ``RATIO`` times the word's own; forms are followed by joins until none moves,
which takes few rounds as counts grow by the ratio at each step.

Defined cases: null and empty texts and texts without letters have no words;
runs of any length count, very long ones too; rows without a doc_id lose no
letter; repeated rows are counted each; of equally frequent near words the
smallest in code-point order is the form; an empty table gives an empty
result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import cut, map_batches

#: Fixed values of the contract.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOSES_ONE_IN = 31
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
NODE_ROWS = 20_000
MAX_BROADCAST_ROWS = 100_000


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n of every word of ``docs`` (doc_id, text)."""
    # A shorter run can't become a word by losing a letter.
    runs = F.filter(F.split(F.translate("text", UPPER, LOWER), f"[^{LETTERS}]+"), lambda r: F.length(r) >= min_length)
    said = docs.select(F.col("doc_id").cast("string").alias("doc"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(h % LOSES_ONE_IN == 0, shorter).otherwise(F.col("run"))
    return (said.select(word.alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count))


def _left(x: Column, n: Column) -> Column:
    return F.substring(x, F.lit(1), n)


def _cut_nodes(rows: DataFrame) -> DataFrame:
    """The two nodes below the one of each row: its beginning is shared, or its end."""
    half = F.floor(F.col("length") / 2).cast("int")
    tail = F.col("length") - half
    size = F.length("rest")

    def below(path: str, shared: Column, length: Column, rest: Column) -> Column:
        return F.struct(
            F.xxhash64("node", F.lit(path), "length", shared).alias("node"), F.concat("path", F.lit(path)).alias("path"),
            length.cast("int").alias("length"), rest.alias("rest"))

    beginning = below("b", _left(F.col("rest"), half), tail, F.substring("rest", half + 1, size))
    end = below("e", F.substring("rest", size - tail + 1, tail), half, _left(F.col("rest"), size - tail))
    each = rows.select("asked", "entry", "word", "n", F.explode(F.array(beginning, end)).alias("b"))
    return each.select("b.*", "asked", "entry", "word", "n")


def _roots(words: DataFrame, min_length: int) -> DataFrame:
    """Each word as a query for entries of its length and of those beside it."""
    size = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(size - 1, size, size + 1)).alias("asked")).filter(F.col("asked") >= min_length)
    return rows.select(F.lit(0).cast("long").alias("node"), F.lit("").alias("path"), F.col("asked").alias("length"),
                       F.col("word").alias("rest"), "asked", (F.col("asked") == size).alias("entry"), "word", "n")


def nodes(words: DataFrame, min_length: int = MIN_LENGTH, node_rows: int = NODE_ROWS) -> DataFrame:
    """Rows of all nodes: at most ``node_rows`` of each, unless one letter is left."""
    level, done = _cut_nodes(_roots(words, min_length)), []
    while True:
        counts = level.filter("length > 1").groupBy("node").agg(F.count("*").alias("rows"), F.max(F.col("entry").cast("int")).alias("any"))
        large = cut(counts.filter((F.col("rows") > node_rows) & (F.col("any") == 1)).select("node"))
        n = large.count()
        if not n:
            done.append(level)
            break
        side = F.broadcast(large) if n <= MAX_BROADCAST_ROWS else large
        done.append(level.join(side, "node", "left_anti"))
        level = _cut_nodes(level.join(side, "node", "left_semi"))
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every


def position_index(entries: list[str]) -> dict[tuple[int, str], int]:
    """A bitset over the entries for each (place, letter)."""
    index: dict[tuple[int, str], bytearray] = {}
    size = len(entries) + 7 >> 3
    for j, word in enumerate(entries):
        byte, bit = j >> 3, 1 << (j & 7)
        for key in enumerate(word):
            bits = index.get(key)
            if bits is None:
                bits = index[key] = bytearray(size)
            bits[byte] |= bit
    return {key: int.from_bytes(bits, "little") for key, bits in index.items()}


def one_error(query: str, length: int, index: dict[tuple[int, str], int], every: int) -> int:
    """The entries, all of ``length`` letters, that one error parts from ``query``.

    ``exact``: entries equal so far; ``off``: those with one error so far."""
    has = index.get
    exact, off = every, 0
    if len(query) == length:
        for key in enumerate(query):
            same = has(key, 0)
            off = off & same | exact & ~same
            exact &= same
            if not exact and not off:
                return 0
    elif len(query) < length:  # the entry has a letter more: places move up behind it
        for i, letter in enumerate(query):
            off = (off | exact) & has((i + 1, letter), 0)
            exact &= has((i, letter), 0)
            if not exact and not off:
                return 0
        off |= exact
    else:  # the query has a letter more: places move down behind it
        for i, letter in enumerate(query):
            off = off & has((i - 1, letter), 0) | exact
            exact &= has((i, letter), 0)
            if not exact and not off:
                return 0
    return off


def belongs(query: str, entry: str, path: str) -> bool:
    """Whether the pair is counted at ``path``: a shared beginning goes before a
    shared end at every cut."""
    for step in path:
        half = len(entry) // 2
        if query[:half] == entry[:half]:
            if step != "b":
                return False
            query, entry = query[half:], entry[half:]
        else:
            tail = len(entry) - half
            if step != "e" or len(query) < tail or query[len(query) - tail:] != entry[half:]:
                return False
            query, entry = query[:len(query) - tail], entry[:half]
    return True


def _rest(word: str, length: int, path: str) -> str:
    """What is left of ``word``, a query for entries of ``length`` letters, at ``path``."""
    for step in path:
        half = length // 2
        if step == "b":
            word, length = word[half:], length - half
        else:
            word, length = word[:len(word) - (length - half)], half
    return word


def search(path: str, asked: int, rows: list[tuple[bool, str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """word, number of near entries, count of the best one and the best one, of the
    queries of one node that have any.  ``rows``: is an entry (too), word, n."""
    entries = [(word, n) for entry, word, n in rows if entry]
    if not entries or len(rows) < 2:
        return
    rests = [_rest(word, asked, path) for word, _ in entries]
    index, every, length = position_index(rests), (1 << len(entries)) - 1, len(rests[0])
    for _, word, _ in rows:
        found = one_error(_rest(word, asked, path), length, index, every)
        near, best = 0, None
        while found:
            low = found & -found
            other, n = entries[low.bit_length() - 1]
            found ^= low
            if belongs(word, other, path):
                near += 1
                if best is None or (-n, other) < best:
                    best = (-n, other)
        if best:
            yield word, near, -best[0], best[1]


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, node_rows: int = NODE_ROWS) -> DataFrame:
    """word, n_near, best_n and best of the words that have a near one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found, strict=True) if found else ([],) * 4
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        node, rows = None, []
        for batch in batches:
            found: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for own, path, asked, entry, word, n in zip(*columns, strict=True):
                if (own, path, asked) != node:
                    if rows:
                        found += search(node[1], node[2], rows)
                    node, rows = (own, path, asked), []
                rows.append((entry, word, n))
            yield batch_of(found)
        if rows:
            yield batch_of(list(search(node[1], node[2], rows)))

    rows = nodes(words, min_length, node_rows).select("node", "path", "asked", "entry", "word", "n")
    found = map_batches(rows.repartition("node").sortWithinPartitions("node", "path", "asked"), run, "word string, n_near long, best_n long, best string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b"))
    return best.select("word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best")


def follow(forms: DataFrame) -> DataFrame:
    """word and root of the words in ``forms`` (word, form)."""
    roots = forms.select("word", F.col("form").alias("root"))
    step = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    while True:
        # Counts grow by the ratio at each step, so this ends after few rounds.
        moved = cut(roots.join(step, "root", "left"))
        roots = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.filter("next is not null").isEmpty():
            return roots


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
             node_rows: int = NODE_ROWS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    words = cut(vocabulary(docs.select("doc_id", "text"), min_length, min_count))
    near = near_words(words, min_length, node_rows)
    is_form = F.col("best_n") >= ratio * F.col("n")
    known = cut(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n")))
    roots = follow(known.filter("form is not null").select("word", "form"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
