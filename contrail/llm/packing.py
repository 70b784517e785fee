"""Best-fit packing of token sequences by bin completion.

Documents become token ids, an end mark follows each, and only documents longer
than the capacity are cut.  What has to be planned is then a histogram: how many
pieces there are of each length from 1 to the capacity.  It is planned on the
driver, which sees at most ``capacity`` (length, count) pairs however many
documents there are:

* best-fit decreasing gives the first incumbent;
* bin completion always fills a sequence around the longest piece left: it
  enumerates the undominated fillings of the room beside it (none is kept where a piece
  that is left would fit beside it, or in place of one or two of its shorter
  pieces) until one leaves no waste or ``FILLINGS`` are seen, and takes the best as
  often as the histogram allows, so that the number of steps follows the number of lengths;
* branch and bound: other branches take another filling at any of the steps, those
  with the fewest such choices first; a branch is cut as soon as its waste exceeds
  what the incumbent allows.  The search ends at the lower bound, when all branches
  are done, or after ``NODES`` steps (so a plan may stay above the optimum, never
  above best-fit decreasing; the README gives distances from the bound).

Pieces are then numbered within their length, and piece number i of a length
goes to slot i of that length.  A length is numbered in as many parts as its count
asks for (``ROWS_A_TASK`` rows each), so one that a third of all documents share
is spread over many tasks; the token ids themselves are never shuffled.

Defined cases: a null or empty text is a piece of one token (the end mark);
very long texts are encoded whole and cut into pieces of the capacity, the last one shorter;
repeated rows are pieces of their own; an empty table gives an empty result;
other columns are ignored; equal lengths are told apart by doc_id, piece and
ids_crc32, so the result doesn't depend on the order of rows.
"""

from __future__ import annotations

import functools
import os
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from contrail.llm.common import cut, map_batches
from contrail.llm.token_counts import merger

CAPACITY = 4096
END_ID = 1
#: Rows that are numbered in one task.
ROWS_A_TASK = 1_000_000
KEEP_WORDS = 400_000
KEEP_CHARS = 40
#: Fillings looked at at each step, multiplicities of a length and shorter pieces
#: in the tests for dominance; steps of the whole search.
FILLINGS = 400
MULTIPLICITIES = 8
PAIRS = 12
NODES = 10_000
#: Up to so many pieces, so many fillings of each step are branched on.
FEW_PIECES = 200
KEEP_FEW = 16

Plan = list[tuple[tuple[int, ...], int]]


# --- pieces -----------------------------------------------------------------

class Encoder:
    """Token ids as little-endian unsigned 32-bit numbers.

    Words (as the vocabulary splits them) are encoded by the tokenizers
    library, once for each distinct word that is still kept.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._split = merger(path).split
        self._known: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        """Encode words in one call; the library tells which word a token is of."""
        told = self._library.encode(" ".join(new), add_special_tokens=False)
        tokens: list[list[int]] = [[] for _ in new]
        if told.word_ids and told.word_ids[-1] == len(new) - 1:
            for n, i in zip(told.word_ids, told.ids, strict=True):
                tokens[n].append(i)
        if not all(tokens):  # some word is split further when it stands alone
            tokens = [e.ids for e in self._library.encode_batch(new, add_special_tokens=False)]
        for w, t in zip(new, tokens, strict=True):
            self._known[w] = struct.pack(f"<{len(t)}I", *t)

    def ids(self, text: str) -> bytes:
        out = []
        for special, words in self._split.parts(text):
            new = list(set(words).difference(self._known))
            if len(self._known) + len(new) > KEEP_WORDS:
                self._known.clear()
                new = list(set(words))
            if new:
                self._learn(new)
            out += map(self._known.__getitem__, words)
            for w in new:
                if len(w) > KEEP_CHARS:
                    del self._known[w]
            if special:
                out.append(struct.pack("<I", self._split.specials[special]))
        return b"".join(out)


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(vocabulary).ids
        for batch in batches:
            rows, columns = [], ([], [], [], [])
            for i, text in enumerate(batch.column(1)):
                data = ids(text.as_py() or "") + struct.pack("<I", END_ID)
                for piece, at in enumerate(range(0, len(data) // 4, capacity)):
                    own = data[4 * at:4 * (at + capacity)]
                    rows.append(i)
                    for c, v in zip(columns, (piece, at, len(own) // 4, zlib.crc32(own)), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in columns[1:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", F.col("text").cast("string")), cut_up, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


# --- plan -------------------------------------------------------------------

def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """Longest pieces first, each into the fullest sequence that has room;
    equal sequences are handled together."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    levels: list[int] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(levels, length)
            if at == len(levels):
                fit = capacity // length
                full, rest = divmod(left, fit)
                new = [((length,) * fit, full)] if full else []
                new += [((length,) * rest, 1)] if rest else []
                left = 0
            else:
                level = levels[at]
                filling, times = room[level].pop()
                if not room[level]:
                    del room[level], levels[at]
                take = min(left, times)
                new = [(filling + (length,), take)] + ([(filling, times - take)] if times > take else [])
                left -= take
            for filling, times in new:
                level = capacity - sum(filling)
                if not room[level]:
                    levels.insert(bisect_left(levels, level), level)
                room[level].append((filling, times))
    return [x for some in room.values() for x in some]


class Stock:
    """Lengths still to be placed, in ascending order, with their counts."""

    def __init__(self, counts: dict[int, int]):
        self.lengths = sorted(k for k, n in counts.items() if n > 0)
        self.counts = {k: counts[k] for k in self.lengths}

    def take(self, filling: tuple[int, ...], times: int) -> None:
        for length in set(filling):
            self.counts[length] -= times * filling.count(length)
            if not self.counts[length]:
                del self.counts[length], self.lengths[bisect_left(self.lengths, length)]

    def times(self, filling: tuple[int, ...]) -> int:
        return min(self.counts[x] // filling.count(x) for x in set(filling))


def _dominated(stock: Stock, filling: tuple[int, ...], room: int) -> bool:
    """Whether a piece that is left would fit beside the filling, or in place of one
    or two of its shorter pieces (never of the longest, around which it is built)."""
    left = {x: stock.counts[x] - filling.count(x) for x in set(filling)}

    def fits(low: int, high: int) -> bool:
        at = bisect_left(stock.lengths, low)
        while at < len(stock.lengths) and stock.lengths[at] <= high:
            if left.get(stock.lengths[at], 1) > 0:
                return True
            at += 1
        return False

    if fits(1, room):
        return True
    if not room:
        return False
    others = sorted(set(filling[1:]))
    if any(fits(x + 1, x + room) for x in others):
        return True
    pairs = {x + y for i, x in enumerate(others[:PAIRS]) for y in others[i:PAIRS] if x != y or filling[1:].count(x) > 1}
    return any(fits(x, x + room) for x in pairs)


def completions(stock: Stock, capacity: int, budget: int = FILLINGS, keep: int = 2) -> list[tuple[int, tuple[int, ...]]]:
    """Undominated fillings around the longest piece as (waste, filling), best
    first: at most ``keep``.  Lengths are chosen from the longest on, each with all
    its multiplicities, the largest first; the enumeration ends at a filling without
    waste or after ``budget`` of them."""
    first = stock.lengths[-1]
    best: list[tuple[int, int, tuple[int, ...]]] = []
    seen = 0
    # (room, index of the next length to choose, pieces chosen)
    open_: list[tuple[int, int, tuple[int, ...]]] = [(capacity - first, len(stock.lengths) - 1, (first,))]
    while open_ and seen < budget and not (best and best[0][0] == 0 and keep <= 2):
        room, at, chosen = open_.pop()
        at = min(at, bisect_right(stock.lengths, room) - 1)
        if at < 0:
            seen += 1
            if not _dominated(stock, chosen, room):
                best.append((room, len(chosen), chosen))
                best.sort()
                del best[keep:]
            continue
        length = stock.lengths[at]
        most = min(room // length, stock.counts[length] - (length == first))
        # Later ones are looked at first: the largest multiplicity.  A small one that only
        # leaves room for the same length again is dominated and shows as such.
        few = range(most + 1) if most <= MULTIPLICITIES else (0, *range(most - MULTIPLICITIES + 1, most + 1))
        for m in few:
            open_.append((room - m * length, at - 1, chosen + (length,) * m))
    return [(room, chosen) for room, _, chosen in best]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Total length, and pieces over half the capacity, which never share."""
    total = -(-sum(k * n for k, n in counts.items()) // capacity)
    return max(total, sum(n for k, n in counts.items() if 2 * k > capacity))


Choices = tuple[tuple[int, int], ...]  # (step, which alternative) beside the first ones


def dive(counts: dict[int, int], capacity: int, bound: int, choices: Choices = (), keep: int = 2,
         budget: int = NODES) -> tuple[Plan | None, list[tuple[int, int]], int]:
    """One branch: its plan (None as soon as its waste shows that it can't use fewer
    than ``bound`` sequences), the other branches met after the last choice, as
    (step, alternative), and the number of steps."""
    stock, plan = Stock(counts), []
    spare = (bound - 1) * capacity - sum(k * n for k, n in counts.items())
    wanted, wide, step = dict(choices), [], 0
    last_choice = choices[-1][0] if choices else -1
    while stock.lengths:
        if step >= budget:
            return None, wide, step
        found = completions(stock, capacity, keep=keep)
        # Each filling as often as it can be, then the repeated ones once.
        options = [(waste, filling, stock.times(filling)) for waste, filling in found]
        options += [(waste, filling, 1) for waste, filling, times in options if times > 1 and keep > 2]
        if step > last_choice:
            wide += [(step, k) for k in range(1, len(options))]
        waste, filling, times = options[min(wanted.get(step, 0), len(options) - 1)]
        last = sum(stock.counts.values()) == times * len(filling)
        if waste * (times - last) > spare:
            return None, wide, step + 1
        spare -= waste * times
        stock.take(filling, times)
        plan.append((filling, times))
        step += 1
    return plan, wide, step


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> Plan:
    """(lengths of the pieces of a sequence, number of such sequences).

    Branches are tried in the order of how many choices part them from the first
    dive, until the lower bound is met, all are done, or ``nodes`` steps are spent."""
    incumbent = best_fit_decreasing(counts, capacity)
    size = sum(times for _, times in incumbent)
    least = lower_bound(counts, capacity)
    # Small instances are searched through; of large ones, two fillings at each step.
    keep = KEEP_FEW if sum(counts.values()) <= FEW_PIECES else 2
    open_: deque[Choices] = deque([()])
    while size > least and open_ and nodes > 0:
        choices = open_.popleft()
        found, wide, steps = dive(counts, capacity, size, choices, keep, nodes)
        nodes -= steps
        if found is not None and (n := sum(times for _, times in found)) < size:
            incumbent, size = found, n
        if len(open_) < nodes:
            open_.extend((*choices, w) for w in wide)
    return incumbent


# --- places -----------------------------------------------------------------

def slots(plan: Plan) -> dict[str, np.ndarray]:
    """Runs of slots, ordered by length: ``begin`` numbers the slots of all
    lengths through; run i holds slots begin[i] to begin[i + 1], in sequences
    sequence[i], sequence[i] + 1, ..., always at the same offset."""
    length, times, sequence, offset = [], [], [], []
    first = 0
    for filling, n in plan:
        at = 0
        for x in filling:
            length.append(x)
            times.append(n)
            sequence.append(first)
            offset.append(at)
            at += x
        first += n
    order = np.argsort(np.array(length, dtype=np.int64), kind="stable")
    n = np.array(times, dtype=np.int64)[order]
    return {"begin": np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n,
            "sequence": np.array(sequence, dtype=np.int64)[order], "offset": np.array(offset, dtype=np.int64)[order]}


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    spark = pieces.sparkSession
    found = pieces.groupBy("length").count().toPandas()  # at most ``capacity`` rows
    counts = {int(k): int(n) for k, n in zip(found["length"], found["count"], strict=True)}
    runs = slots(plan_sequences(counts, capacity))
    # As many parts of a length as its count asks for, each numbered by itself.
    salts = {k: -(-n // ROWS_A_TASK) for k, n in counts.items()}
    parts = spark.createDataFrame(list(salts.items()), "salted_length long, salts long")
    salted = pieces.join(F.broadcast(parts), F.col("length") == F.col("salted_length")).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts"))).drop("salted_length", "salts")
    first = np.zeros(capacity + 2, dtype=np.int64)
    first[[k + 1 for k in salts]] = list(salts.values())
    first = np.cumsum(first)  # parts before each length
    sizes = np.zeros(int(first[-1]), dtype=np.int64)
    # One row for each part: as many as lengths, and one more for each ROWS_A_TASK pieces.
    for length, salt, n in salted.groupBy("length", "salt").count().collect():
        sizes[first[length] + salt] = n
    base = spark.sparkContext.broadcast((first, np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes))
    shared = spark.sparkContext.broadcast(runs)
    numbered = salted.withColumn("number", F.row_number().over(
        W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")).cast("long") - 1)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, (first, begin) = shared.value, base.value
        for batch in batches:
            at = {n: batch.column(n).to_numpy() for n in ("length", "salt", "number")}
            slot = begin[first[at["length"]] + at["salt"]] + at["number"]
            run = np.searchsorted(runs["begin"], slot, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(runs["sequence"][run] + slot - runs["begin"][run]), pa.array(runs["offset"][run])],
                [*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kind = pieces.schema["doc_id"].dataType.simpleString()
    return map_batches(numbered, placed, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents and their places."""
    return place(cut(pieces_of(docs, vocabulary, capacity)), capacity)
