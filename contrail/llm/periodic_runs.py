"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period ``q`` that is at least
``REPEATS`` periods and ``MIN_LENGTH`` words long and that no neighbouring word
extends.  At every dyadic scale ``B`` the words are cut into blocks of ``B``; a
run with ``B <= q < 2B`` holds a whole block whose copy starts ``q`` words later.

1. Blocks that can't recur in reach are left out: each of their words must come
   again within ``2B`` words, and they must not lie in a run of smaller period.
2. The sum of squared differences between a block and every place of the window
   behind it is, but for two sums of squares, one convolution.  Number-theoretic
   transforms compute it in whole numbers modulo a prime for many blocks at once;
   places where it is zero are the block's occurrences (compared word by word
   once more, as a sum can be a multiple of the prime).  Blocks beyond ``PIECE``
   words are looked for by their first ``PIECE``, in pieces of the window.
3. An occurrence's distance is a period and its place a seed.  Seeds of
   consecutive blocks at one distance are one chain; a chain is extended over the
   blocks next to it, where the mismatch that ends the run must be.  A seed inside
   a run of smaller period is that run again and is left out.

So a text of one word repeated costs no more than any other.  Many texts are
searched together, parted by symbols that occur once.  Rows are independent: no
shuffle; memory is one batch of about ``CHUNK_WORDS`` words, or one longer text.

Defined cases: a null or empty text has no words and no runs; very long texts
are searched whole; a row without a doc_id is searched as it is (the planted
rewriting goes by doc_id); of equally strong runs the first counts, then the one
of smaller period; repeated rows are searched one by one; an empty table gives
an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import map_batches

#: Fixed values of the contract.
REPEATS = 4
MIN_LENGTH = 6
CHUNK_WORDS = 1 << 18
PIECE = 1 << 15
#: Words held at once by the matrices of blocks and windows.
MATRIX = 1 << 20
#: 119 * 2**23 + 1, with a primitive root: transforms of up to 2**23 numbers.
PRIME, ROOT = 998244353, 3

P64 = np.uint64(PRIME)


@functools.lru_cache(maxsize=64)
def _twiddles(half: int, inverse: bool) -> np.ndarray:
    root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    out = np.ones(half, dtype=np.uint64)
    done = 1
    while done < half:  # the powers so far, times the next one
        more = min(done, half - done)
        out[done:done + more] = out[:more] * np.uint64(pow(root, done, PRIME)) % P64
        done += more
    return out


def transform(rows: np.ndarray) -> np.ndarray:
    """The number-theoretic transform of each row, in bit-reversed order."""
    k, size = rows.shape
    half = size // 2
    while half:
        x = rows.reshape(k, -1, 2, half)
        a, b = x[:, :, 0], x[:, :, 1]
        rows = np.stack([(a + b) % P64, (a + P64 - b) * _twiddles(half, False) % P64], axis=2)
        half //= 2
    return rows.reshape(k, size)


def restore(rows: np.ndarray) -> np.ndarray:
    """The inverse of :func:`transform`."""
    k, size = rows.shape
    half = 1
    while half < size:
        x = rows.reshape(k, -1, 2, half)
        a, b = x[:, :, 0], x[:, :, 1] * _twiddles(half, True) % P64
        rows = np.stack([(a + b) % P64, (a + P64 - b) % P64], axis=2)
        half *= 2
    return rows.reshape(k, size) * np.uint64(pow(size, -1, PRIME)) % P64


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The sum of squared differences, modulo the prime, of each block (k, n) and its
    window (k, 2n - 1) at each of the n places."""
    k, n = blocks.shape
    b, t = blocks.astype(np.uint64) % P64, windows.astype(np.uint64) % P64
    back, front = np.zeros((2, k, 2 * n), dtype=np.uint64)
    back[:, :n], front[:, :2 * n - 1] = b[:, ::-1], t
    product = restore(transform(back) * transform(front) % P64)[:, n - 1:2 * n - 1]
    total = np.zeros((k, 2 * n), dtype=np.uint64)
    np.cumsum(t * t % P64, axis=1, out=total[:, 1:])
    squares = (b * b % P64).sum(axis=1, keepdims=True) + total[:, n:] - total[:, :n]
    return (squares % P64 + (P64 - product) * np.uint64(2)) % P64


def _in_pieces(rows: int, width: int) -> Iterator[slice]:
    step = max(1, MATRIX // max(1, width))
    for lo in range(0, rows, step):
        yield slice(lo, min(lo + step, rows))


def _occurrences(symbols: np.ndarray, begins: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of the occurrences of the blocks at ``begins``, at distances
    from ``block`` to twice that, less one."""
    n = min(block, PIECE)
    shifts = np.arange(block, 2 * block, n)
    padded = np.append(symbols, symbols.max() + 1)
    places, distances = [], []
    at, shift = np.repeat(begins, len(shifts)), np.tile(shifts, len(begins))
    for own in _in_pieces(len(at), 2 * n):
        pattern = symbols[at[own, None] + np.arange(n)]
        window = padded[np.minimum(at[own, None] + shift[own, None] + np.arange(2 * n - 1), len(symbols))]
        row, place = np.nonzero(squared_differences(pattern, window) == 0)
        places.append(at[own][row])
        distances.append(shift[own][row] + place)
    place, distance = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (places, distances))
    inside = place + distance + block <= len(symbols)
    place, distance = place[inside], distance[inside]
    equal = np.zeros(len(place), dtype=bool)
    for own in _in_pieces(len(place), block):
        first = place[own, None] + np.arange(block)
        equal[own] = (symbols[first] == symbols[first + distance[own, None]]).all(axis=1)
    return place[equal], distance[equal]


def _to_mismatch(symbols: np.ndarray, begins: np.ndarray, step: int, distances: np.ndarray, block: int) -> np.ndarray:
    """How many words from ``begins`` on, in direction ``step``, equal the one at the
    distance; fewer than ``block``."""
    out = np.zeros(len(begins), dtype=np.int64)
    for own in _in_pieces(len(begins), block):
        first = begins[own, None] + step * np.arange(block)
        second = first + distances[own, None]
        last = len(symbols) - 1
        differ = (second > last) | (symbols[np.minimum(first, last)] != symbols[np.minimum(second, last)])
        out[own] = differ.argmax(axis=1)
    return out


class _Cover:
    """Whether a stretch lies inside one of the runs."""

    def __init__(self, runs: np.ndarray):
        runs = runs[np.argsort(runs[:, 0], kind="stable")]
        self._starts = runs[:, 0]
        self._ends = np.maximum.accumulate(runs[:, 1])

    def holds(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self._starts, start, side="right") - 1
        reach = self._ends[at] if len(self._ends) else np.zeros(len(start))
        return (at >= 0) & (reach >= end)


def find_runs(symbols: np.ndarray, longest: int, repeats: int = REPEATS, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, end, smallest period) of all runs, by start and period.

    ``symbols`` begins and ends with one that occurs once, and has others like it
    between its texts, none longer than ``longest``."""
    total = len(symbols)
    order = np.argsort(symbols, kind="stable")
    again = np.flatnonzero(symbols[order[1:]] == symbols[order[:-1]])
    wait = np.full(total, total, dtype=np.int64)  # words until the same one comes again
    wait[order[again]] = order[again + 1] - order[again]
    runs = np.zeros((0, 3), dtype=np.int64)
    block = 1
    while repeats * block <= longest:
        begins = np.flatnonzero(wait < 2 * block) * block
        if len(begins):
            cover = _Cover(runs)
            begins = begins[~cover.holds(begins, begins + 3 * block - 1)]
            place, distance = _occurrences(symbols, begins, block)
            fresh = ~cover.holds(place, place + distance + block)
            place, distance = place[fresh], distance[fresh]
            by = np.lexsort((place, distance))
            place, distance = place[by], distance[by]
            new = np.ones(len(place), dtype=bool)
            new[1:] = (distance[1:] != distance[:-1]) | (place[1:] != place[:-1] + block)
            head = np.flatnonzero(new)
            last = np.append(head[1:], len(place))[:len(head)] - 1
            period = distance[head]
            start = place[head] - _to_mismatch(symbols, place[head] - 1, -1, period, block)
            end = place[last] + block + _to_mismatch(symbols, place[last] + block, 1, period, block) + period
            strong = end - start >= np.maximum(min_length, repeats * period)
            runs = np.concatenate([runs, np.column_stack([start, end, period])[strong]])
        pairs = len(wait) // 2
        wait = np.maximum(wait[:2 * pairs:2], wait[1:2 * pairs:2])
        block *= 2
    # A multiple of the smallest period gives the same stretch.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.ones(len(runs), dtype=bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def planted(words: list[bytes], doc_id: object) -> list[bytes]:
    """The words after the contract's rewriting, which goes by the id alone."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * -(-(n - a) // p))[:n - a]


def _figures(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """Columns of one text from its runs (start, end, period)."""
    if not runs:
        return 0, None, None, None, None, hashlib.sha256().hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()
    best = runs[0]
    keep = np.ones(len(words), dtype=bool)
    for start, end, period in runs:
        if (end - start) * best[2] > (best[1] - best[0]) * period:
            best = start, end, period
        keep[start + period:end] = False
    length = best[1] - best[0]
    told = "".join(f"{start},{end - start},{period}\n" for start, end, period in runs)
    kept = b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])
    return (len(runs), best[0], length, best[2], 1000 * length // best[2],
            hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def describe(texts: list[list[bytes]]) -> Iterator[tuple]:
    """The columns of each text (its words), searched together."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    parts = [np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)) for words in texts]
    stops = len(numbers) + np.arange(len(texts) + 1)
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    ends = np.cumsum(sizes + 1)  # the symbol behind each text
    symbols = np.empty(int(ends[-1]) + 1 if len(ends) else 1, dtype=np.int64)
    symbols[np.append(0, ends)] = stops
    for part, end in zip(parts, ends.tolist(), strict=True):
        symbols[end - len(part):end] = part
    runs = find_runs(symbols, int(sizes.max(initial=0)))
    cuts = np.searchsorted(runs[:, 0], ends)
    lo = 0
    for words, end, hi in zip(texts, ends.tolist(), cuts.tolist(), strict=True):
        begin = end - len(words)
        yield _figures(words, [(s - begin, e - begin, q) for s, e, q in runs[lo:hi].tolist()])
        lo = hi


_COLUMNS = [("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
            ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]


def detect(docs: DataFrame, rewrite: bool = True) -> DataFrame:
    """doc_id, n_runs, the strongest run (start, length, period, exponent_milli) and
    the digests of all runs and of the words that are left without repetitions.
    ``rewrite``: whether documents are first rewritten as the contract plants runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            columns = zip(*describe(texts), strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), *(pa.array(c, t) for c, (_, t) in zip(columns, _COLUMNS, strict=True))],
                ["doc_id", *(name for name, _ in _COLUMNS)])

        for batch in batches:
            id_type = batch.column(0).type
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                # Bytes are split at exactly the six ASCII white space characters.
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                ids.append(doc_id)
                texts.append(planted(words, doc_id) if rewrite else words)
                held += len(words)
                if held >= CHUNK_WORDS:
                    yield found(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield found(ids, texts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        docs.select("doc_id", F.col("text").cast("string")), run,
        f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
