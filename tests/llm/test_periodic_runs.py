"""Periodic runs against a plain search, and the transforms against sums."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from contrail.llm import periodic_runs as pr

from .helpers import ODD, documents, none_of, odd_documents


def plain_runs(w: list) -> list[tuple[int, int, int]]:
    """(start, length, period) by extending every equal pair of words."""
    found: dict[tuple[int, int], int] = {}
    n = len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text) -> tuple:
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("n", [1, 2, 8, 64])
def test_squared_differences_are_exact(n):
    rng = np.random.default_rng(n)
    b, t = rng.integers(0, 5, (6, n)), rng.integers(0, 5, (6, 2 * n - 1))
    t[0, n - 1:] = b[0]
    got = pr.squared_differences(b, t)
    assert (got == [[((b[r] - t[r, o:o + n]) ** 2).sum() for o in range(n)] for r in range(6)]).all()
    assert got[0, n - 1] == 0


def test_runs_equal_a_plain_search(monkeypatch):
    rng = random.Random(11)
    for piece in (pr.PIECE, 4):  # whole blocks, and blocks found by their first words
        monkeypatch.setattr(pr, "PIECE", piece)
        for _ in range(300):
            texts = []
            for _ in range(rng.randint(1, 4)):
                w = []
                while len(w) < rng.randint(0, 120):
                    part = [rng.choice("ab") for _ in range(rng.randint(1, 12))]
                    w += (part * rng.randint(1, 7))[:rng.randint(1, 60)]
                texts.append([x.encode() for x in w])
            for words, row in zip(texts, pr.describe(texts), strict=True):
                runs = plain_runs(words)
                told = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
                assert (row[0], row[5]) == (len(runs), hashlib.sha256(told.encode()).hexdigest())


def test_whole_table_equals_a_plain_search(spark):
    docs = documents(spark)
    rows = [plain_row(r.doc_id, r.text) for r in docs.collect()]
    got = pr.detect(docs)
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    assert sum(r[1] for r in rows) > 10


def test_odd_documents(spark):
    key = lambda r: str(r)
    docs = odd_documents(spark)
    short = [r for r in ODD if r[0] != 9]
    expected = [plain_row(*r) for r in short] + [
        (9, 1, 0, 20000, 1, 20000000, hashlib.sha256(b"0,20000,1\n").hexdigest(), hashlib.sha256(b"word").hexdigest())]
    assert sorted(map(tuple, pr.detect(docs).collect()), key=key) == sorted(expected, key=key)
    assert pr.detect(none_of(docs)).count() == 0


def test_long_periods_of_a_long_text():
    rng = np.random.default_rng(3)
    period = [b"%d" % x for x in rng.integers(0, 1 << 40, 70_001)]
    (row,) = pr.describe([[b"before", *(period * 5)[:4 * 70_001 + 17], b"behind"]])
    assert row[:5] == (1, 1, 4 * 70_001 + 17, 70_001, 1000 * (4 * 70_001 + 17) // 70_001)
