"""Spelling variants against plain edit distance."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from contrail.llm import spelling_variants as sv

from .helpers import ODD, none_of, odd_documents


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_force(docs: list[tuple]) -> list[tuple]:
    counts: Counter = Counter()
    low = str.maketrans(sv.UPPER, sv.LOWER)
    for doc, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 7
    n = {w: k for w, k in counts.items() if k >= 2}
    form, near = {}, {}
    for w in n:
        others = sorted((x for x in n if one_edit(w, x)), key=lambda x: (-n[x], x))
        near[w] = len(others)
        if others and n[others[0]] >= 10 * n[w]:
            form[w] = others[0]
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], near[w], n[form[w]] if w in form else None))
    return sorted(out)


def test_one_error_is_one_edit():
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(3, 5))) for _ in range(200)}
    for length in (3, 4, 5):
        entries = sorted(w for w in words if len(w) == length)
        index, every = sv.position_index(entries), (1 << len(entries)) - 1
        for query in words:
            if abs(len(query) - length) <= 1:
                bits = sv.one_error(query, length, index, every)
                assert [e for j, e in enumerate(entries) if bits >> j & 1] == [e for e in entries if one_edit(query, e)]


def test_every_pair_belongs_to_one_path():
    rng = random.Random(6)
    paths = [a + b for a in "be" for b in "be"]
    for _ in range(2000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(7, 9)))
        b = list(a)
        i = rng.randrange(len(b))
        kind = rng.randrange(3)
        b[i:i + 1] = [[], ["c"], [b[i], b[i]]][kind]
        assert sum(sv.belongs(a, "".join(b), p) for p in paths) == 1


def test_variants_equal_brute_force(spark):
    rng = random.Random(7)
    stems = ["".join(rng.choice("abcdéÿ×") for _ in range(rng.randint(6, 12))) for _ in range(60)]

    def say() -> str:
        w = list(stems[min(int(rng.expovariate(0.15)), 59)])
        if rng.random() < 0.3:
            w.insert(rng.randrange(len(w)), rng.choice("abA"))
        if rng.random() < 0.1:
            del w[rng.randrange(len(w))]
        return "".join(w)

    docs = [(i % 190, " ".join(say() for _ in range(60)) + " ÉCOLES écoles, Àbcdefg") for i in range(200)]
    # A chain of forms: 2, 20, 200 occurrences.
    docs.append((None, "chainsaab " * 2 + "chainsaa " * 20 + "chainsa " * 200 + "tiedword\ntiedworda-tiedwordb " * 30 + "tiedwordc " * 2))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    expected = brute_force(docs)
    assert {r[1] for r in expected if r[0] == "chainsaab"} == {"chainsaa"} and {r[2] for r in expected if r[0] == "chainsaab"} == {"chainsa"}
    assert {r[1] for r in expected if r[0] == "tiedwordc"} == {"tiedword"}
    for node_rows in (sv.NODE_ROWS, 8):  # whole nodes, and nodes that are cut to the last letter
        got = sv.variants(df, node_rows=node_rows)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert sorted(map(tuple, got.collect())) == expected


def test_odd_documents(spark):
    docs = odd_documents(spark)
    assert sorted(map(tuple, sv.variants(docs).collect())) == brute_force(ODD)
    long = spark.createDataFrame([(i, "y" * 5000 + " " + "y" * 4999) for i in range(3)], "doc_id long, text string")
    assert sorted(map(tuple, sv.variants(long).collect())) == brute_force([(i, "y" * 5000 + " " + "y" * 4999) for i in range(3)])
    assert sv.variants(none_of(docs)).count() == 0
