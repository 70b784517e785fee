"""Operators that compare documents with each other or with a second table."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from contrail.llm import decontaminate, jaccard_join, line_dedup, pii

from .helpers import ODD, SF, documents, none_of, odd_documents, same_rows

SF1 = "/root/testdata/sf0.01"


def with_odd(spark, df):
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    return df.select("doc_id", "text").unionByName(odd.withColumn("doc_id", odd.doc_id + 10**9))


# --- decontamination ---------------------------------------------------------

def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def said(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def brute_hits(docs, items):
    grams = defaultdict(set)
    for item, text in items:
        w = said(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1) if w else ():
            grams[tuple(w[i:i + n])].add(str(item))
    sizes = {len(g) for g in grams}
    for doc_id, text in docs:
        w, hit, met = said(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if own := grams.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    met |= own
        yield doc_id, len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)


def test_decontamination_matches_brute_force(spark):
    docs = with_odd(spark, documents(spark, SF1))
    bench = spark.read.parquet(f"{SF1}/benchmark.parquet")
    extra = spark.createDataFrame([(900, "One two"), (901, "ertion the"), (902, None), (903, "..."), (900, "One two"), (904, "same text here now ok same text here")],
                                  "item_id long, text string")
    bench = bench.unionByName(extra)
    expected = list(brute_hits([tuple(r) for r in docs.collect()], [tuple(r) for r in bench.collect()]))
    assert any(r[-1] for r in expected) and not all(r[-1] for r in expected)
    same_rows(decontaminate.report(docs, bench), expected)


def test_decontamination_by_shuffle_gives_the_same(spark, monkeypatch):
    docs, bench = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = [tuple(r) for r in decontaminate.report(docs, bench).collect()]
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WINDOWS", 0)
    same_rows(decontaminate.report(docs, bench), expected)


def test_decontamination_removes_spans_or_documents(spark):
    bench = spark.createDataFrame([(1, "the quick brown fox"), (2, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "- A fox. The QUICK, brown fox! ran the quick", 7), (2, "the quick brown dog", 8), (3, None, 9)],
                                 "doc_id long, text string, hits int")
    same_rows(decontaminate.remove_spans(docs, bench), [(1, "- A fox. ran the quick", 7), (2, "the quick brown dog", 8), (3, None, 9)])
    same_rows(decontaminate.remove_documents(docs, bench), [(2, "the quick brown dog", 8), (3, None, 9)])
    assert decontaminate.remove_spans(docs, none_of(bench)).count() == 3
    assert decontaminate.remove_documents(none_of(odd_documents(spark)), bench).count() == 0
    assert decontaminate.remove_documents(odd_documents(spark), bench).columns == odd_documents(spark).columns


# --- line dedup --------------------------------------------------------------

def brute_lines(docs):
    order = sorted({(i is not None, i or 0, t or "") for i, t in docs})
    first = {}
    clean = lambda t: [re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ") for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    for key in order:
        w = clean(key[2])
        for i in range(len(w) - 2):
            first.setdefault(tuple(w[i:i + 3]), (*key, i))
    # Ties on doc_id are broken by a hash that this sketch doesn't know.
    for doc_id, text in docs:
        w, gone = clean(text), set()
        for i in range(len(w) - 2):
            if first[tuple(w[i:i + 3])] != (doc_id is not None, doc_id or 0, text or "", i):
                gone |= {i, i + 1, i + 2}
        left, n = [], -1
        for x in (text or "").split("\n"):
            has = bool(re.search(r"[^\x20\x09-\x0D]", x))
            n += has
            if not has or n not in gone:
                left.append((has, x))
        cleaned = text if not gone else "\n".join(x for _, x in left) if any(h for h, _ in left) else ""
        yield doc_id, len(w), len(gone), ",".join(map(str, sorted(gone))), cleaned


def test_line_dedup_matches_brute_force(spark):
    lines = [(1, "a\nb\nc\nd"), (2, "x\na\nb\n\n c \ny"), (2, "x\na\nb\n\n c \ny"), (3, "a\nb\nc\na\nb\nc"), (None, "q\nr\ns\nt"), (5, "q\nr\ns\n\n"), (6, "a\nb")]
    small = spark.createDataFrame(lines, "doc_id long, text string")
    same_rows(line_dedup.report(small), list(brute_lines(lines)))
    docs = with_odd(spark, documents(spark, SF1))
    same_rows(line_dedup.report(docs), list(brute_lines([tuple(r) for r in docs.collect()])))


def test_line_dedup_documents(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc", 5, "z"), (2, "a\nb\nc", 5, "y"), (3, "a\nb\nc\nd", 7, "x"), (4, None, None, "w")],
                                 "doc_id long, text string, n_chars int, removed string")
    same_rows(line_dedup.dedup_documents(docs), [(1, "a\nb\nc", 5, "z"), (3, "d", 1, "x"), (4, None, None, "w")])
    assert line_dedup.dedup_documents(none_of(docs)).count() == 0
    assert line_dedup.dedup_documents(odd_documents(spark)).columns == odd_documents(spark).columns


# --- personal data -----------------------------------------------------------

def passes_luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_pii(text):
    text, spans = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and passes_luhn(d):
            spans.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            spans.append((m.start(), 3, m.end()))
    told = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
    return *[sum(k == i for _, k, _ in spans) for i in range(4)], hashlib.sha256(told.encode()).hexdigest(), told


PERSONAL = [
    "a@b.c_d@e.f x@y@z.com a@b.c..d@e.f @ a@b", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 " + "1 " * 200,
    "+1 (911) 555-1477 +12 +1+49 30 123456 +1.2.3.4.5.6.7.8.9", "é\U0001f600 mail me@x.org then 4111111111111111é", "9" * 20000 + "." + "1" * 30,
    "a" * 5000 + "@", "+" + "1 " * 5000, "é 1.2.3.4 a@b.c" * 1500,
]


def test_pii_base_spans_match_brute_force(spark):
    docs = with_odd(spark, documents(spark, SF1)).unionByName(
        spark.createDataFrame([(2 * 10**9 + i, t) for i, t in enumerate(PERSONAL)], "doc_id long, text string"))
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    for r in docs.collect():
        g, (*counts, digest, told) = got[r.doc_id], brute_pii(r.text)
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone, g.base_sha256] == [*counts, digest], r.text[:200]
        assert set(filter(None, told.split(","))) <= set(g.spans.split(","))
    assert len(got) == len({r.doc_id for r in docs.collect()})


def test_pii_adds_supervised_spans(spark):
    texts = [(i, f"contact me at user{i}@mail{i}.com or call +1 (212) 555-01{i:02d}, ip address {i}.20.30.40") for i in range(60)]
    texts += [(100, "My social security number is 219-09-9999."), (101, "IBAN GB82 WEST 1234 5698 7654 32 please"), (102, "order 000-12-3456, serial 900-00-0000")]
    got = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[100] == "ssn:29:40"
    assert got[101] == "iban:5:32"
    assert got[102] == ""


def test_pii_without_candidates(spark):
    docs = spark.createDataFrame([(1, "nothing"), (2, None)], "doc_id long, text string")
    assert [r.spans for r in pii.report(docs).collect()] == ["", ""]
    assert pii.report(none_of(odd_documents(spark))).count() == 0


# --- chosen-path join --------------------------------------------------------

def shingles(text):
    w = [x.lower() if x.isascii() else lowered(x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_links(docs, threshold=0.8):
    sets = [(i, shingles(t)) for i, t in docs]
    at = defaultdict(list)
    for n, (i, s) in enumerate(sets):
        if i is not None:
            for x in s:
                at[x].append(n)
    links = defaultdict(set)
    for n, (i, s) in enumerate(sets):
        if i is None:
            continue
        common = defaultdict(int)
        for x in s:
            for m in at[x]:
                common[m] += 1
        for m, c in common.items():
            if m != n and c >= threshold * (len(s) + len(sets[m][1]) - c) - 1e-9:
                links[n].add(m)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, ms in links.items():
        for m in ms:
            a, b = find(n), find(m)
            if a != b:
                root[max(a, b)] = min(a, b)
    lowest = {}
    for n, (i, _) in enumerate(sets):
        if i is not None:
            r = find(n)
            lowest[r] = min(lowest.get(r, i), i)
    return [(i, None if i is None else lowest[find(n)], len(links[n]), len(s)) for n, (i, s) in enumerate(sets)]


def test_join_matches_brute_force(spark):
    docs = with_odd(spark, documents(spark, SF1))
    expected = brute_links([tuple(r) for r in docs.collect()])
    assert sum(n > 0 for _, _, n, _ in expected) > 50
    same_rows(jaccard_join.link(docs), expected)


@pytest.mark.parametrize("block", [256, 40])
def test_join_of_a_large_group_of_near_copies(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    base = [f"w{i}" for i in range(200)]
    texts = [(i, " ".join(base[:50 + i % 120] + [f"new{i}"] + base[50 + i % 120:])) for i in range(130)]
    texts += [(1000 + i, " ".join(f"{i}x{k}" for k in range(30))) for i in range(20)]
    same_rows(jaccard_join.link(spark.createDataFrame(texts, "doc_id long, text string")), brute_links(texts))


@pytest.mark.parametrize("bucket", [4096, 64])
def test_join_of_pairs_at_the_edge_of_a_large_group(spark, bucket, monkeypatch):
    # Of each pair, one is near the group (0.76, no link) and its partner is not (0.61).
    monkeypatch.setattr(jaccard_join, "BUCKET", bucket)
    base = [f"w{i}" for i in range(300)]
    group = [(i, " ".join(base[:40 + i % 200] + [f"new{i}"] + base[41 + i % 200:])) for i in range(600)]
    pairs = []
    for i in range(500):
        near = base[:264] + [f"n{i}x{k}" for k in range(36)]
        pairs += [(1000 + 2 * i, " ".join(near)), (1001 + 2 * i, " ".join([f"f{i}x{k}" for k in range(31)] + near[31:]))]
    similar = lambda a, b: len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    assert similar(pairs[0][1], pairs[1][1]) >= 0.8 > max(similar(pairs[0][1], t) for _, t in group + pairs[2:4])
    rows = jaccard_join.link(spark.createDataFrame(group + pairs, "doc_id long, text string")).collect()
    got = {r.doc_id: (r.class_id, r.n_links) for r in rows}
    assert [i for i, _ in pairs if got[i] != (i - i % 2, 1)] == []


def table_links(texts, threshold=0.8):
    """doc_id: (class_id, n_links) from one matrix of all sets."""
    import numpy as np
    sets = [shingles(t) for _, t in texts]
    number: dict = {}
    has = np.zeros((len(sets), len({x for s in sets for x in s})), dtype=np.float32)
    for n, own in enumerate(sets):
        has[n, [number.setdefault(x, len(number)) for x in own]] = 1
    common, size = has @ has.T, has.sum(axis=1)
    hit = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-3
    np.fill_diagonal(hit, False)
    root = np.arange(len(sets))
    while True:
        low = np.minimum(root, np.where(hit, root[None, :], len(sets)).min(axis=1))
        if (low == root).all():
            break
        root = low
    return {i: (texts[r][0], int(k)) for (i, _), r, k in zip(texts, root.tolist(), hit.sum(axis=1).tolist(), strict=True)}


def test_join_of_a_group_of_thousands(spark):
    # Near copies in a chain: neighbours are close, the ends are not, so much of the group is ring.
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(5000):
        own = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            own[rng.randrange(60)] = f"v{rng.randrange(40)}"
        texts.append((i, " ".join(own)))
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.link(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == table_links(texts)


def test_join_of_families_that_share_half_of_their_text(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET", 32)
    shared = [f"s{i}" for i in range(60)]
    texts = []
    for f in range(6):
        for i in range(60):
            own = shared + [f"f{f}x{k}" for k in range(60)]
            own[61 + i % 50] = f"new{i}"
            texts.append((100 * f + i, " ".join(own)))
    texts += [(1000 + i, " ".join(shared + [f"alone{i}x{k}" for k in range(60)])) for i in range(200)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.link(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == table_links(texts)


def test_large_buckets_lose_no_link(spark):
    # Bits of the sketch: a group of 150, 30 sets 20 bits away from it and 12 more bits away from those 30 others.
    from contrail.llm.common import Scratch
    near, far = (1 << 20) - 1, (1 << 32) - 1
    sets = {i: 0 for i in range(150)} | {200 + i: near for i in range(30)} | {300 + i: far for i in range(30)} | {400 + i: -1 for i in range(5)}
    scratch = Scratch(spark)
    rows = scratch.store(spark.createDataFrame([(7, r, s, s if s == -1 else 0, r, len(sets)) for r, s in sets.items()],
                                               "node long, rep long, s0 long, s1 long, tag long, size long"))
    links, tagged = jaccard_join._by_pivots(rows, 1, 0.8, scratch)
    tags = {r.rep: r.tag for r in tagged.collect()}
    done = spark.createDataFrame([(7, tags[0], len(sets))], "node long, tag long, size long")
    root = {r: r for r in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links.unionByName(jaccard_join._with_all(tagged, done, 1, 0.8)).collect():
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert {find(r) for r in sets if r < 400} == {0} and {find(r) for r in sets if r >= 400} == {400}
    # A tag only ever names what links connect.
    assert all(find(r) == find(t) for r, t in tags.items())


def test_rows_that_share_a_doc_id_and_string_ids(spark):
    words = [f"w{i}" for i in range(100)]
    a, b = " ".join(words), " ".join(words[:97] + ["x", "y", "z"])
    c = "quite another text of one two three four words"
    docs = spark.createDataFrame([("d1", a, 1), ("d1", c, 2), ("d2", b, 3), ("d1", c, 4), ("d0", "", 5), ("d0", "", 6)], "doc_id string, text string, n int")
    same_rows(jaccard_join.link(docs).select("doc_id", "class_id", "n_links"),
              [("d1", "d1", 1), ("d1", "d1", 1), ("d2", "d1", 1), ("d1", "d1", 1), ("d0", "d0", 0), ("d0", "d0", 0)])
    # Both texts of d1 stay once; the near copy d2 goes; rows without words stay.
    same_rows(jaccard_join.drop_near_copies(docs), [("d1", a, 1), ("d1", c, 2), ("d0", "", 5), ("d0", "", 6)])


def test_join_edge_cases(spark):
    assert jaccard_join.link(none_of(odd_documents(spark))).count() == 0
    kept = jaccard_join.drop_near_copies(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, 2, 3, 4, 5, None, 7, 8, 9, 10], key=str)
    long = spark.createDataFrame([(1, "long text of words " * 80000), (2, "Long text of  words " * 80000)], "doc_id long, text string")
    same_rows(jaccard_join.link(long), [(1, 1, 1, 4), (2, 1, 1, 4)])


def test_sets_are_the_same_however_texts_are_batched():
    import numpy as np
    import pyarrow as pa
    texts = ["a b c d e f", "", None, "A  B\tc d e f", "x" * 10, "long word " * 300000, "q r"]
    alone = [next(iter(jaccard_join.shingle_sets(pa.array([t], pa.string())))) for t in texts]
    together = list(jaccard_join.shingle_sets(pa.array(texts)))
    assert all(np.array_equal(a, b) for a, b in zip(alone, together, strict=True))
    assert np.array_equal(alone[0], alone[3]) and len(alone[1]) == len(alone[2]) == 0
    assert len(alone[5]) == 2
    sliced = list(jaccard_join.shingle_sets(pa.array(texts).slice(3, 3)))
    assert all(np.array_equal(a, b) for a, b in zip(alone[3:6], sliced, strict=True))


def test_runs_follow_the_recall():
    assert jaccard_join.runs_for(0.9) < jaccard_join.runs_for(0.999) < 20
    assert jaccard_join.runs_for(0.999, 0.8, 1) < jaccard_join.runs_for(0.999, 0.8, 4) < jaccard_join.runs_for(0.999, 0.8, 12)
