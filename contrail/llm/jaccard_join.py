"""N-gram Jaccard self-join by chosen paths.

Documents are sets of five-word shingles (a shorter text is one shingle of all
its words; words are runs of anything but ASCII white space, A to Z lowered).

1. Equal sets are one class representative with a count of its copies.
2. Each representative gets ``COORDINATES`` min-hashes, the embedded set whose
   share of equal coordinates is the Jaccard similarity.
3. Chosen paths: at every node of a recursion, one or two coordinates are drawn
   by the node's own hash (1 / threshold of them on average), and sets with the
   same token there go on together.  A bucket of at most ``BUCKET`` sets is brute
   forced with 128-bit sketches.  In a larger one, sets near one of a few pivots
   drawn from it are linked to it, and what the pivots connect takes one tag.
   The sets outside the bucket's largest tag are the ones left to compare:

   - none: every set is connected already (the other links come from step 4);
   - at most ``BUCKET``: each of them is compared with every set of the bucket, block
     by block, so that no link of theirs is missed, and the bucket is done;
   - more: the bucket goes down, with all its sets.

   So a group of near copies, with the sets at its edge, leaves the recursion where
   it is met, whatever its size; no bucket is ever gathered in one task.
   The whole recursion is repeated until the target recall is met for pairs that
   part from the crowd at the deepest level reached (:func:`runs_for`): a deeper
   recursion is repeated more often.
4. Candidate links are joined into groups.  Inside a group every pair of sets is
   compared exactly (shingle by shingle, in blocks of ``BLOCK`` sets, one task for
   each pair of blocks), so links that the recursion missed inside a group are
   found too; pairs are counted where they are compared and never emitted.
5. Groups are rebuilt from the exact links.

Result: one row per document with ``class_id`` (the lowest doc_id among the
documents it is connected to by links), ``n_links`` (how many other documents
have a similarity at or above the threshold with it, copies included) and
``n_shingles``.

Defined cases: a null or empty text has no shingles, no links, and is its own
class; very long texts are read whole, segment by segment; rows without a doc_id
are kept with class_id null and n_links 0; repeated rows are copies of each other;
rows that share a doc_id but not the text are different documents; doc_ids may be
of any type that can be ordered; a similarity of exactly the threshold is a link;
an empty table gives an empty result; other columns are
ignored by :func:`link` and kept by :func:`drop_near_copies`.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import Scratch, map_batches

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
COORDINATES = 128
BUCKET = 4096
PIVOTS = 8
BLOCK = 512
#: A sketch passes when it agrees as often as one of a pair four deviations
#: below the threshold would.
DEVIATIONS = 4.0
#: Rows of a side that may be broadcast (a few hundred bytes each at most).
MAX_BROADCAST_ROWS = 30_000
#: Parts of a hot node where its side is too large for that.
SALTS = 64
SEGMENT = 1 << 20
WIDTH = 8192

U64 = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BYTE[65:91] = _BYTE[97:123]
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_PLACE = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * U64(2) + U64(1)
_COORDINATE = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * U64(2) + U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, dtype=U64), np.full(n, _UNBASE, dtype=U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every word in ``data``; ``starts``: where texts begin."""
    n = len(data)
    up, down = _powers(1 << max(SEGMENT, n).bit_length())
    word = _IS_WORD[data]
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[starts] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | fresh[1:n]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | fresh[1:n]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    total = np.cumsum(_BYTE[data] * up[:n])
    before = np.where(first > 0, total[first - 1], U64(0))
    return mix((total[last] - before) * down[first] + (last - first).astype(U64)), first


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(texts):
        # As many whole texts as fit a segment; a longer one alone, in pieces.
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SEGMENT, side="right")) - 1)
        j = min(j, len(texts))
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= SEGMENT:
            own = offsets[i:j] - lo
            hashes, first = _word_hashes(data[lo:hi], own[own < hi - lo]) if hi > lo else (np.zeros(0, U64), np.zeros(0, np.int64))
            cuts = np.searchsorted(first, np.append(own, hi - lo))
            for k in range(j - i):
                yield _shingles(hashes[cuts[k]:cuts[k + 1]])
        else:
            parts, at = [], lo
            while at < hi:
                end = min(at + SEGMENT, hi)
                while end < hi and _IS_WORD[data[end]]:  # to the end of a word
                    step = np.flatnonzero(~_IS_WORD[data[end:min(end + SEGMENT, hi)]])
                    end = end + int(step[0]) if len(step) else min(end + SEGMENT, hi)
                parts.append(_word_hashes(data[at:end], np.zeros(1, dtype=np.int64))[0])
                at = end
            yield _shingles(np.concatenate(parts))
        i = j


def _shingles(words: np.ndarray) -> np.ndarray:
    if len(words) < SHINGLE:
        return mix((words * _PLACE[:len(words)]).sum(keepdims=True, dtype=U64)) if len(words) else words
    n = len(words) - SHINGLE + 1
    return np.unique(mix(sum((words[k:k + n] * _PLACE[k] for k in range(1, SHINGLE)), words[:n] * _PLACE[0])))


def embed(shingles: np.ndarray) -> np.ndarray:
    """The min-hash of each coordinate."""
    out = np.full(COORDINATES, np.iinfo(U64).max, dtype=U64)
    for at in range(0, len(shingles), 1024):
        np.minimum(out, (shingles[at:at + 1024, None] * _COORDINATE).min(axis=0), out=out)
    return (out >> U64(32)).astype(np.uint32)


def runs_for(recall: float = RECALL, threshold: float = THRESHOLD, depth: int = 1) -> int:
    """Repetitions after which a pair at the threshold has shared a bucket of
    level ``depth`` with the given probability.  A node draws one coordinate, and a second one with
    probability 1 / threshold - 1; the pair goes on together through each with
    probability ``threshold``."""
    lost = 0.0
    for _ in range(depth):
        once = 1 - threshold * (1 - lost)
        lost = once * ((2 - 1 / threshold) + (1 / threshold - 1) * once)
    return math.ceil(math.log(1 - recall) / math.log(lost))


def _children(nodes: np.ndarray, embedded: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Next nodes of each row (its index, the node)."""
    drawn = mix(nodes)
    first = (drawn % U64(COORDINATES)).astype(np.int64)
    again = mix(drawn ^ U64(_BASE))
    second = (first + 1 + (again % U64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
    two = np.flatnonzero((again >> U64(11)).astype(np.float64) / float(1 << 53) < 1 / threshold - 1)
    row = np.concatenate([np.arange(len(nodes)), two])
    at = np.concatenate([first, second[two]])
    token = embedded[row, at].astype(U64)
    return row, mix(mix(nodes[row] + at.astype(U64) * U64(_UNBASE)) ^ token)


def _embedded(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(len(column), COORDINATES)


def _sketches(embedded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = np.packbits((embedded & 1).astype(np.uint8), axis=1).view(np.int64)
    return bits[:, 0].copy(), bits[:, 1].copy()


_NODES = "node long, rep long, s0 long, s1 long, tag long"


def _node_batch(nodes: np.ndarray, rep: pa.Array, row: np.ndarray, embedded: np.ndarray, tags: pa.Array) -> pa.RecordBatch:
    s0, s1 = _sketches(embedded)
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes.view(np.int64)), rep.take(pa.array(row)), pa.array(s0[row]), pa.array(s1[row]), tags], ["node", "rep", "s0", "s1", "tag"])


def _roots(reps: DataFrame, runs: range, threshold: float) -> DataFrame:
    """The first nodes of every set, in each of the ``runs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix(np.arange(runs.start + 1, runs.stop + 1, dtype=U64) * U64(_BASE))
        for batch in batches:
            if batch.num_rows:
                embedded = _embedded(batch.column("embedded"))
                for seed in seeds:
                    row, nodes = _children(np.full(batch.num_rows, seed, dtype=U64), embedded, threshold)
                    yield _node_batch(nodes, batch.column("rep"), row, embedded, batch.column("rep").take(pa.array(row)))

    return map_batches(reps.select("rep", "embedded"), run, _NODES)


def _below(large: DataFrame, reps: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """The nodes below those of ``large`` (rep, node, tag)."""
    wanted = scratch.store(large.groupBy("rep").agg(F.collect_list(F.struct("node", "tag")).alias("nodes")))
    n = wanted.agg(F.sum(F.size("nodes"))).first()[0] or 0
    side = F.broadcast(wanted) if n <= MAX_BROADCAST_ROWS else wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                embedded, nodes = _embedded(batch.column("embedded")), batch.column("nodes")
                own = np.repeat(np.arange(batch.num_rows), pc.list_value_length(nodes).to_numpy())
                node, tag = (nodes.flatten().field(i) for i in range(2))
                row, below = _children(node.to_numpy().view(U64), embedded[own], threshold)
                yield _node_batch(below, batch.column("rep"), own[row], embedded, tag.take(pa.array(row)))

    return scratch.store(map_batches(reps.select("rep", "embedded").join(side, "rep"), run, _NODES), [wanted])


def least_agreement(threshold: float) -> int:
    same = (1 + threshold) / 2
    return math.floor(COORDINATES * same - DEVIATIONS * math.sqrt(COORDINATES * same * (1 - same)))


_TOP = np.iinfo(np.int64).max
#: Rows of a matrix of comparisons held at once.
ROWS = 256


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Which sketches (n, 2) of ``a`` and ``b`` differ in at most ``most`` bits."""
    out = np.empty((len(a), len(b)), dtype=bool)
    for lo in range(0, len(a), ROWS):
        some = a[lo:lo + ROWS]
        apart = np.bitwise_count(some[:, None, 0] ^ b[None, :, 0])
        apart += np.bitwise_count(some[:, None, 1] ^ b[None, :, 1])
        out[lo:lo + ROWS] = apart <= most
    return out


def _lowest(near: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The lowest of ``of`` among each row's near ones."""
    out = np.empty(len(near), dtype=np.int64)
    for lo in range(0, len(near), ROWS):
        out[lo:lo + ROWS] = np.where(near[lo:lo + ROWS], of[None, :], _TOP).min(axis=1, initial=_TOP)
    return out


def _connected(rep: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The lowest of ``rep`` that each one is connected to by ``near``, a set's
    likeness to itself included."""
    root = rep
    while True:  # the lowest root among the neighbours, until none moves
        low = _lowest(near, root)
        if (low == root).all():
            return root
        root = low


def _lists(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """rep and sketches of each list of (rep, s0, s1)."""
    flat = column.flatten()
    rep, s0, s1 = (flat.field(i).to_numpy() for i in range(3))
    cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy())])
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        # Unsigned, as numpy counts the bits of a negative number's absolute value.
        yield rep[lo:hi], np.column_stack([s0[lo:hi], s1[lo:hi]]).view(U64)


_LINKS = "a long, b long"


def _link_batch(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (left, right)], ["a", "b"])


def _brute_force(small: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) from each set of a bucket to the lowest one that it is
    connected to by sketches that agree: as many as sets, not as pairs."""
    most = COORDINATES - least_agreement(threshold)
    buckets = small.groupBy("node").agg(F.collect_list(F.struct("rep", "s0", "s1")).alias("sets"), F.min("tag").alias("lo"), F.max("tag").alias("hi"))
    buckets = buckets.filter("lo != hi").select("sets")  # one tag: connected already

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for rep, sketch in _lists(batch.column(0)):
                root = _connected(rep, _near(sketch, sketch, most))
                moved = rep != root
                left.append(root[moved])
                right.append(rep[moved])
            yield _link_batch(left, right)

    return map_batches(buckets, run, _LINKS)


def _beside(rows: DataFrame, side: DataFrame, n: int) -> DataFrame:
    """``rows`` joined with ``side``, ``n`` rows with one of each node; a hot node
    is in one task only of a broadcast side."""
    if n <= MAX_BROADCAST_ROWS:
        return rows.join(F.broadcast(side), "node")
    salted = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")).join(salted, ["node", "salt"]).drop("salt")


def _group_tags(links: np.ndarray, tags: list[int | None]) -> list[int | None]:
    """The lowest tag of the pivots connected to each one; bit ``PIVOTS * i + j``
    of ``links``: a set is near both pivots i and j."""
    out, moving = list(tags), True
    while moving:
        moving = False
        for i in range(PIVOTS):
            for j in range(PIVOTS):
                if links >> (PIVOTS * i + j) & 1 and out[j] is not None and (out[i] is None or out[j] < out[i]):
                    out[i], moving = out[j], True
    return out


def _by_pivots(large: DataFrame, n: int, threshold: float, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Links of the sets of large nodes (with ``size``) to the pivots that they are near, and
    the sets with the tag of what these connect."""
    most = COORDINATES - least_agreement(threshold)

    def agree(p: Column) -> Column:
        return (F.bit_count(p["s0"].bitwiseXOR(F.col("s0"))) + F.bit_count(p["s1"].bitwiseXOR(F.col("s1")))) <= most

    # The share of hash values that gives PIVOTS on average; the lowest set is always one.
    drawn = F.pmod(F.xxhash64("rep", "node"), F.lit(1 << 31)) < F.lit(float(PIVOTS << 31)) / F.col("size")
    one = F.struct("rep", "s0", "s1")
    pivots = large.groupBy("node").agg(F.collect_set(F.when(drawn, one)).alias("some"), F.min(one).alias("lowest"))
    pivots = scratch.store(pivots.select("node", F.slice(F.array_union(F.array("lowest"), "some"), 1, PIVOTS).alias("pivots")))
    numbers = F.sequence(F.lit(0), F.size("pivots") - 1)
    met = F.filter(numbers, lambda i: agree(F.get("pivots", i)))
    met = _beside(large, pivots, n).withColumn("met", met)
    met = scratch.store(met.select("node", "rep", "s0", "s1", "tag", "met", F.transform("met", lambda i: F.get("pivots", i)["rep"]).alias("near")), [pivots])
    links = scratch.store(met.select("rep", F.explode("near").alias("p")).filter("rep != p").select(
        F.least("rep", "p").alias("a"), F.greatest("rep", "p").alias("b")))

    def bits(numbers: Column, place: Column | int = 0) -> Column:
        return F.aggregate(numbers, F.lit(0).cast("long"), lambda all_, i: all_.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i + place)))

    pairs = F.aggregate("met", F.lit(0).cast("long"), lambda all_, i: all_.bitwiseOR(bits(F.col("met"), i * PIVOTS)))
    lows = [F.min(F.when(F.array_contains("met", i), F.col("tag"))) for i in range(PIVOTS)]
    told = met.withColumn("pairs", pairs).groupBy("node").agg(F.bit_or("pairs").alias("pairs"), F.array(*lows).alias("tags"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags = [_group_tags(p % (1 << 64), t) for p, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tags, pa.list_(pa.int64()))], ["node", "tags"])

    told = scratch.store(map_batches(told, run, "node long, tags array<long>"))
    tag = F.when(F.size("met") > 0, F.get("tags", F.get("met", F.lit(0)))).otherwise(F.col("tag"))
    return links, scratch.store(_beside(met, told, n).select("node", "rep", "s0", "s1", tag.alias("tag")), [met, told])


def _with_all(rows: DataFrame, done: DataFrame, n: int, threshold: float) -> DataFrame:
    """Links between the sets outside the largest tag of each node in ``done`` (node,
    tag, size) and all sets of it; in each block from what is connected to the lowest one."""
    most = COORDINATES - least_agreement(threshold)
    rows = _beside(rows, done.withColumnRenamed("tag", "largest"), n)
    one = F.struct("rep", "s0", "s1")
    others = rows.filter("tag != largest").groupBy("node").agg(F.collect_list(one).alias("others"))
    block = F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / BUCKET)).alias("block")
    blocks = rows.groupBy("node", block).agg(F.collect_list(one).alias("sets"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for (rep, sketch), (other, outer) in zip(_lists(batch.column(0)), _lists(batch.column(1)), strict=True):
                near = _near(sketch, outer, most)
                mine, others = rep, other
                while True:
                    before = mine, others
                    others = np.minimum(others, _lowest(near.T, mine))
                    mine = np.minimum(mine, _lowest(near, others))
                    if (mine == before[0]).all() and (others == before[1]).all():
                        break
                for own, low in ((rep, mine), (other, others)):
                    left.append(low[own != low])
                    right.append(own[own != low])
            yield _link_batch(left, right)

    return map_batches(blocks.join(others, "node").select("sets", "others"), run, _LINKS)


def _search(reps: DataFrame, runs: range, threshold: float, scratch: Scratch) -> tuple[list[DataFrame], int]:
    """Links found by ``runs`` of the recursion, and the levels it took."""
    found, level = [], 1
    rows = scratch.store(_roots(reps, runs, threshold))
    while True:
        counts = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("tag").alias("lo"), F.max("tag").alias("hi"))
        large = scratch.store(counts.filter(F.col("size") > BUCKET))
        n = large.count()
        side = F.broadcast(large.select("node")) if n <= MAX_BROADCAST_ROWS else large.select("node")
        small = rows.join(side, "node", "left_anti") if n else rows
        found.append(scratch.store(_brute_force(small, threshold)))
        open_ = large.filter("lo != hi")
        n = open_.count() if n else 0
        if not n:
            scratch.remove(rows, large)
            return found, level
        links, tagged = _by_pivots(_beside(rows, open_.select("node", "size"), n), n, threshold, scratch)
        found.append(links)
        by_tag = tagged.groupBy("node", "tag").agg(F.count("*").alias("size"))
        state = by_tag.groupBy("node").agg(F.max(F.struct("size", "tag")).alias("top"), F.sum("size").alias("size"))
        state = scratch.store(state.select("node", F.col("top.tag").alias("tag"), "size", (F.col("size") - F.col("top.size")).alias("others")), [rows, large])
        done = state.filter(f"others > 0 and others <= {BUCKET}").select("node", "tag", "size")
        found.append(scratch.store(_with_all(tagged, done, n, threshold)))
        down = state.filter(f"others > {BUCKET}").select("node")
        n = down.count()
        if not n:
            scratch.remove(tagged, state)
            return found, level
        rows = _below(_beside(tagged, down, n), reps, threshold, scratch)
        scratch.remove(tagged, state)
        level += 1


def candidate_links(reps: DataFrame, scratch: Scratch, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Links (a, b) between ``reps`` (rep, embedded) whose sketches agree, found by chosen paths."""
    found, done, depth = [], 0, 1
    while done < (runs := runs_for(recall, threshold, depth)):
        links, reached = _search(reps, range(done, runs), threshold, scratch)
        found += links
        done, depth = runs, max(depth, reached)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return scratch.store(every.distinct(), found)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b), root the lowest connected
    one; alternating large and small stars until nothing moves."""
    edges = scratch.store(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    while True:
        # Stars: every node points to one root, and no root points anywhere.
        out = edges.groupBy("u").agg(F.count("*").alias("n"))
        moving = out.filter("n > 1").select("u").union(edges.select("v").distinct().join(out.select(F.col("u").alias("v")), "v").select("v"))
        if moving.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low)
        edges = scratch.store(small.filter("u != v").distinct(), [edges])
    told = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    return scratch.store(told, [edges])


def _linked(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which sets of ``a`` and ``b`` (None: of ``a`` itself) are similar."""
    every = a + (b or [])
    sizes = np.array([len(s) for s in every], dtype=np.float64)
    tokens, owner = np.concatenate(every), np.repeat(np.arange(len(every)), sizes.astype(np.int64))
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    shared = ~(new & np.append(new[1:], True))  # a token of one set only joins nothing
    token = np.cumsum(new)[shared]
    token, owner = np.unique(token, return_inverse=True)[1], owner[shared]
    m = len(a)
    common = np.zeros((m, len(b) if b is not None else m), dtype=np.float64)
    for lo in range(0, int(token[-1]) + 1 if len(token) else 0, WIDTH):
        at = slice(*np.searchsorted(token, [lo, lo + WIDTH]))
        has = np.zeros((len(every), min(WIDTH, int(token[-1]) + 1 - lo)), dtype=np.float32)
        has[owner[at], token[at] - lo] = 1
        common += has[:m] @ (has[m:] if b is not None else has).T
    mine, other = sizes[:m, None], (sizes[m:] if b is not None else sizes)[None, :]
    return common * (1 + threshold) >= threshold * (mine + other) - 1e-6


def _exact(members: DataFrame, threshold: float) -> DataFrame:
    """(rep, links, root) from each pair of blocks of each group: the documents
    linked there, and the lowest set connected there.  ``members``: rep, key, copies, text
    and the group's root, the member's block and the number of blocks."""

    def solve(rows: list[tuple], two: bool) -> tuple[list, list, list]:
        # A doc_id may have several texts: the one whose set is the member's.
        sets, chosen = {}, {}
        for (rep, key, block, copies, _), own in zip(rows, shingle_sets(pa.array([r[-1] for r in rows], pa.large_string())), strict=True):
            if rep not in chosen and key == set_key(own):
                chosen[rep], sets[rep] = (block, copies), own
        reps = sorted(chosen)
        blocks = sorted({chosen[r][0] for r in reps})
        if len(blocks) != 1 + two:
            return [], [], []
        copies = np.array([chosen[r][1] for r in reps])
        side = [[i for i, r in enumerate(reps) if chosen[r][0] == x] for x in blocks]
        root = np.arange(len(reps))
        links = np.zeros(len(reps), dtype=np.int64)
        x, y = (side[0], side[1]) if two else (side[0], None)
        hit = _linked([sets[reps[i]] for i in x], [sets[reps[i]] for i in y] if two else None, threshold)
        if y is None:
            np.fill_diagonal(hit, False)
            links[x] = hit @ copies[x]
        else:
            links[x], links[y] = hit @ copies[y], hit.T @ copies[x]
        cols = np.array(y if y is not None else x)
        moving = True
        while moving:
            before = root.copy()
            for i, row in zip(x, hit, strict=True):
                near = cols[row]
                if len(near):
                    low = min(root[i], root[near].min())
                    root[i] = low
                    root[near] = low
            moving = bool((before != root).any())
        return reps, links.tolist(), [reps[i] for i in root]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
        key, rows = None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(8)]
            out = ([], [], [])
            for group, lo, hi, *row in zip(*columns, strict=True):
                if (group, lo, hi) != key:
                    if rows:
                        for o, v in zip(out, solve(rows, key[1] != key[2]), strict=True):
                            o += v
                    key, rows = (group, lo, hi), []
                rows.append(tuple(row))
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], schema=schema)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in solve(rows, key[1] != key[2])], schema=schema)

    # The set goes to every pair of blocks that its own block is in.
    spread = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "rep", "key", "block", "copies", "text")
    return map_batches(spread.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi"), run, "rep long, links long, root long")


def set_key(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh128(shingles.tobytes()).digest() if len(shingles) else None


def link_sets(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, key of the set, n_shingles) and what is known of each
    set: key, doc (its lowest doc_id), class_id, class_key (the lowest key of
    that doc_id in the class) and n_links."""
    scratch = Scratch(docs.sparkSession)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, embedded = [], [], []
            for s in shingle_sets(batch.column(1)):
                keys.append(set_key(s))
                sizes.append(len(s))
                embedded.append(embed(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(embedded, pa.binary())],
                ["doc_id", "key", "n_shingles", "embedded"])

    given = docs.select("doc_id", F.col("text").cast("string"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    whole = scratch.store(map_batches(given, described, f"doc_id {kind}, key binary, n_shingles long, embedded binary"))
    known = whole.filter("key is not null and doc_id is not null")
    reps = known.groupBy("key").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies"), F.first("embedded").alias("embedded"))
    reps = scratch.store(reps.withColumn("rep", F.monotonically_increasing_id()))
    rows = scratch.store(whole.select("doc_id", "key", "n_shingles"), [whole])
    groups = components(candidate_links(reps, scratch, threshold, recall), scratch)
    sets = scratch.store(reps.drop("embedded"))
    scratch.keep_only(rows, sets, groups)
    sizes = groups.groupBy("root").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = groups.join(sizes, "root").select(F.col("node").alias("rep"), "root", blocks.alias("blocks"))
    members = members.join(sets, "rep").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    members = scratch.store(members, [groups])
    side = F.broadcast(members) if members.count() <= MAX_BROADCAST_ROWS else members
    texts = given.filter("text is not null").join(side, given["doc_id"] == side["doc"]).drop("doc_id", "doc")
    exact = scratch.store(_exact(texts, threshold), [members])
    links = exact.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(exact.filter("rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch)
    linked = roots.join(sets.select(F.col("rep").alias("node"), "doc", "key"), "node")
    lowest = linked.groupBy("root").agg(F.min(F.struct("doc", "key")).alias("low"))
    classes = linked.join(lowest, "root").select(F.col("node").alias("rep"), F.col("low.doc").alias("class_id"), F.col("low.key").alias("class_key"))
    told = sets.join(links, "rep", "left").join(classes, "rep", "left").select(
        "key", "doc", F.coalesce("class_id", "doc").alias("class_id"), F.coalesce("class_key", "key").alias("class_key"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    told = scratch.store(told)
    scratch.keep_only(rows, told)
    return rows, told


def link(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links and n_shingles of each row."""
    rows, told = link_sets(docs, threshold, recall)
    # One row for each key; the side of the documents may be skewed and is split then.
    known = told.select(F.col("key").alias("set_key"), "class_id", "n_links")
    return rows.join(known, F.col("key") == F.col("set_key"), "left").select(
        "doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), "n_shingles")


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One document of each class, the one with the lowest doc_id (and key of its
    set); same columns.  Rows without a doc_id or without shingles stay."""
    rows, told = link_sets(docs, threshold, recall)
    known = told.select(F.col("key").alias("set_key"), "doc", ((F.col("class_id") == F.col("doc")) & (F.col("class_key") == F.col("key"))).alias("first"))
    marks = rows.filter("doc_id is not null").join(known, F.col("key") == F.col("set_key"), "left").select(
        "doc_id", "key", F.coalesce(F.col("first") & (F.col("doc") == F.col("doc_id")), F.col("key").isNull()).alias("stays"))
    # Most ids have one row, which stays or goes; the others are told apart by their keys.
    by_id = marks.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("stays").alias("stays"))
    by_id = by_id.filter("not stays or n > 1").select(F.col("doc_id").alias("marked"), F.when(F.col("stays"), "some").otherwise("none").alias("left"))
    by_id = Scratch(docs.sparkSession).store(by_id)
    side = F.broadcast(by_id) if by_id.count() <= 10 * MAX_BROADCAST_ROWS else by_id
    given = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("own_id"), F.col("text").cast("string").alias("own_text"))
    given = given.join(side, F.col("own_id") == F.col("marked"), "left")
    alone = given.filter("left is null").select("row")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("own_key", pa.array([set_key(s) for s in shingle_sets(batch.column("own_text"))], pa.binary()))

    shared = given.filter("left = 'some'").select("row", "own_id", "own_text")
    shared = map_batches(shared, keyed, T.StructType([*shared.schema.fields, T.StructField("own_key", T.BinaryType())])).drop("own_text")
    ids = by_id.filter("left = 'some'").select(F.col("marked").alias("doc_id"))
    first = marks.filter("stays and key is not null").join(ids, "doc_id", "left_semi").distinct()
    kept = shared.join(first, (F.col("own_id") == F.col("doc_id")) & (F.col("own_key") == F.col("key")))
    # Repeated rows are one document.
    kept = kept.groupBy("own_id", "own_key").agg(F.min("row").alias("row")).select("row")
    left = alone.unionByName(kept).unionByName(shared.filter("own_key is null").select("row"))
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])
