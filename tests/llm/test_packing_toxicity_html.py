"""Packing (exact round trip), toxicity (held-out accuracy), html extraction."""

from __future__ import annotations

import random
import struct
import zlib
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

from contrail.llm import html_extract, packing, queries, toxicity

from .helpers import ODD, documents, none_of, odd_documents, same_rows

PATH = queries.vocabulary_path()
SF1 = "/root/testdata/sf0.01"


def check_packing(docs, packed, capacity=4096):
    library = Tokenizer.from_file(PATH)
    expected = []
    for i, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at:at + capacity]
            expected.append((i, n, at, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))))
    rows = packed.collect()
    same = lambda x: sorted(x, key=str)
    assert same(tuple(r)[:5] for r in rows) == same(expected)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r.length for r in rows)


def test_packing_round_trip(spark):
    odd = spark.createDataFrame(ODD + [(50, "a <|endoftext|>b<|startoftext|>"), (51, "İ Σ ﬁ")], "doc_id long, text string")
    docs = documents(spark, SF1).select("doc_id", "text").unionByName(odd)
    n, total = check_packing([tuple(r) for r in docs.collect()], packing.pack(docs, PATH))
    assert n <= -(-total // 4096) + 1
    assert packing.pack(none_of(odd_documents(spark)), PATH).count() == 0


def test_bin_completion_beats_best_fit():
    # Best-fit decreasing opens three sequences here; two are enough.
    counts = {5: 1, 4: 2, 3: 1, 2: 2}
    assert sum(t for _, t in packing.best_fit_decreasing(counts, 10)) == 3
    plan = packing.plan_sequences(counts, 10)
    assert sum(t for _, t in plan) == 2
    used = defaultdict(int)
    for filling, times in plan:
        assert sum(filling) <= 10
        for x in filling:
            used[x] += times
    assert dict(used) == counts


@pytest.mark.parametrize("counts", [{}, {1: 10**9}, {4096: 5, 1: 3}, {2049: 1000, 2047: 999, 1: 7}, {n: n % 7 + 1 for n in range(1, 4097)}])
def test_plans_are_complete_and_near_the_bound(counts):
    plan = packing.plan_sequences(counts, 4096)
    used = defaultdict(int)
    for filling, times in plan:
        assert sum(filling) <= 4096 and times > 0
        for x in filling:
            used[x] += times
    assert dict(used) == counts
    least = packing.lower_bound(counts, 4096) if counts else 0
    assert sum(t for _, t in plan) <= least + 1 + least // 500


def fewest(items, capacity):
    """The optimum, by trying every place of every piece."""
    items, best = sorted(items, reverse=True), [len(items)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for at in {b: k for k, b in enumerate(bins) if b + items[i] <= capacity}.values():
            bins[at] += items[i]
            put(i + 1, bins)
            bins[at] -= items[i]
        put(i + 1, [*bins, items[i]])

    put(0, [])
    return best[0]


def test_small_instances_reach_the_optimum():
    rng, missed = random.Random(1), 0
    for _ in range(300):
        items = [rng.randint(10, 60) for _ in range(rng.randint(3, 12))]
        counts = {x: items.count(x) for x in items}
        plan = packing.plan_sequences(counts, 100)
        used = defaultdict(int)
        for filling, times in plan:
            assert sum(filling) <= 100
            for x in filling:
                used[x] += times
        assert dict(used) == counts and sum(t for _, t in plan) == fewest(items, 100)
        missed += sum(t for _, t in packing.best_fit_decreasing(counts, 100)) > fewest(items, 100)
    assert missed > 5  # best-fit decreasing alone doesn't


@pytest.mark.parametrize(("counts", "n"), [({3: 13_650_000}, 10_000), ({3: 2_000_000, 9: 5}, 1466), ({1: 10**9, 2: 10**9}, 732_422)])
def test_tables_of_many_short_texts(counts, n):
    assert sum(t for _, t in packing.plan_sequences(counts)) == n


def test_fillings_that_a_replacement_improves_are_dominated():
    stock = packing.Stock({60: 1, 25: 1, 20: 2, 12: 1, 11: 1})
    found = packing.completions(stock, 100, keep=50)
    assert (0, (60, 20, 20)) in found
    # 12 and 11 leave 17, where 20 could stand for 12 and 25 for both.
    assert not any(filling == (60, 12, 11) for _, filling in found)


def test_a_length_is_numbered_in_as_many_parts_as_it_needs(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_A_TASK", 7)
    docs = spark.createDataFrame([(i, "one two") for i in range(60)] + [(100 + i, "x " * i) for i in range(20)], "doc_id long, text string")
    check_packing([tuple(r) for r in docs.collect()], packing.pack(docs, PATH))


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.queries()["op2_toxicity"](spark, sf).join(labels, "doc_id").filter("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    toxic, clean = [r for r in got if r.toxic == 1], [r for r in got if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)


def test_toxicity_scores_are_reproducible(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    first = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    turned = docs.repartition(7).withColumn("lang", docs.source)
    assert first == {r.doc_id: r.score for r in toxicity.score(turned, toxicity.train(turned, labels.repartition(3))).collect()}


def test_toxicity_edge_cases(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none)
    assert model is None
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(ODD) and {r.score for r in rows} == {0.0}
    labels = spark.createDataFrame([(i, None, (i or 0) % 2) for i in (1, 4, 5, 6, 7, 8, 9, 10, None)] + [(4, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(none_of(docs), model).count() == 0


def test_toxicity_threshold_does_not_move_with_the_sample(spark):
    # The word is in three of five toxic texts and in few others; one label in ten is toxic.
    draw = random.Random(7)
    words = [f"w{n:03d}" for n in range(300)]
    texts, marks = [], []
    for i in range(3000):
        toxic = int(i % 10 == 0)
        said = draw.choices(words, k=30)
        if draw.random() < (0.6 if toxic else 0.06):
            said[draw.randrange(30)] = "vilest"
        texts.append((i, " ".join(said)))
        marks.append((i, toxic))
    docs, labels = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    marked = {}
    for sample in (4000, 200):
        rows = toxicity.score(docs, toxicity.train(docs, labels, sample)).collect()
        assert abs(sum(r.score for r in rows) / len(rows) - 0.1) < 0.04
        marked[sample] = sum(r.predicted for r in rows)
    assert abs(marked[200] - marked[4000]) <= 0.02 * len(texts)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body class="home page">
<header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies &amp; more here.</div>
<main><article class="post with-sidebar"><h1>A   title</h1><p>First &lt;para&gt; of the text, long enough to count as a sentence of prose.
<p>Short.<br>Next</p><div class="ad">Buy this now, it is really very cheap today.</div>
<form><p>Your mail please, we will send you many letters.</p><input name=x></form><ul><li>One &eacute;</li><li>Two</li></ul></article>
<section class="comments"><article><p>I say that this is a very nice article to read indeed.</p></article></section></main>
<aside><p>Other stories that you may want to read today, all of them.</p></aside><footer>&copy; me</footer></body></html>"""
TEXT = "A title\nFirst <para> of the text, long enough to count as a sentence of prose.\nShort. Next\nOne é\nTwo"


@pytest.mark.parametrize(("html", "text"), [
    (PAGE, TEXT), ("", ""), ("just text &amp; more &am", "just text & more &am"), ("<p>cut off <b>here <a hr", "cut off here"),
    ("<div><p>Plain division with a sentence that is long enough.</p><p>Re.</p></div><div class='menu'><a>x</a></div>",
     "Plain division with a sentence that is long enough.\nRe."),
    ("<p>a</p>" * 3, "a\na\na"), ("<nav>only a menu</nav>", ""), ("<p>1 < 2 and 3 > 2 &#x41;&#66;</p>", "1 < 2 and 3 > 2 AB"),
])
def test_html_pages(html, text):
    assert html_extract.extract(html) == text


PROSE = "<p>A plain sentence of the article that is long enough to count.</p><p>Short.</p>"
SAID = "A plain sentence of the article that is long enough to count.\nShort."
MENU = "<ul><li><a href=/>Home</a></li><li><a href=/a>About</a></li></ul>"


@pytest.mark.parametrize(("html", "text"), [
    (f'<div class="content has-sidebar"><article>{PROSE}</article></div>', SAID),
    (f'<div class="site no-sidebar">{PROSE}</div>', SAID),
    (f'<div class="main-content with-menu">{PROSE}</div>', SAID),
    (f'<body class="search-results"><section class="search">{PROSE}</section></body>', SAID),
    (f'<div class="comment-free post">{PROSE}</div>', SAID),
    (f'<article class="post related-posts">{PROSE}</article>', SAID),
    (f'<nav>{MENU}<article>{PROSE}</article>', SAID),
    (f'<body><nav>{MENU}<div>{PROSE}</div></body>', SAID),
    (f'<body><header><nav>{MENU}</nav><h2>Site</h2><main>{PROSE}</main></body>', SAID),
    (f'<article><header><h1>Title</h1><p>By me</p></header>{PROSE}<footer>f</footer></article>', "Title\n" + SAID),
    (f'<form id="page"><div>{PROSE}</div><div class="sidebar"><p>Other things.</p></div></form>', SAID),
    (f'<div class="menu">{MENU}</div><article>{PROSE}</article><div class="comments"><article>{PROSE * 3}</article></div>', SAID),
    (f'<aside><article>{PROSE}</article></aside><article>{PROSE}</article>', SAID),
    (f'<nav>{MENU}</nav>', ""), (f'<article>{PROSE}<button>Press{PROSE}</article>', SAID + "\n" + SAID),
])
def test_an_article_is_not_lost(html, text):
    assert html_extract.extract(html) == text


def test_regions_follow_the_ratios_by_brute_force():
    rng = random.Random(8)
    for _ in range(200):
        regions = [[(rng.randint(1, 60), rng.choice([0, 0, 0, 3, 8])) for _ in range(rng.randint(1, 5))] for _ in range(rng.randint(1, 6))]
        texts = [[f"{'w' * n}{a}x{b}" + "y" * links for b, (n, links) in enumerate(lines)] for a, lines in enumerate(regions)]
        html = "".join("<div>" + "".join(f"<p>{t[:len(t) - links]}{'<a href=#>y</a>' * links}</p>" for t, (_, links) in zip(own, lines, strict=True)) + "</div>"
                       for own, lines in zip(texts, regions, strict=True))
        # A line's tags: its own and two for each link.
        ratios = [len(t) / (1 + 2 * links) for own, lines in zip(texts, regions, strict=True) for t, (_, links) in zip(own, lines, strict=True)]
        n = len(ratios)
        even = []
        for i in range(n):
            near = [(ratios[k], 2.718281828459045 ** (-(k - i) ** 2 / 2)) for k in range(max(0, i - 3), min(n, i + 4))]
            even.append(sum(r * w for r, w in near) / sum(w for _, w in near))
        mean = sum(even) / n
        cut = min(20.0, mean - (sum((r - mean) ** 2 for r in even) / n) ** 0.5 / 2)
        kept, at = [], 0
        for own in texts:
            if any(r >= cut - 1e-9 for r in even[at:at + len(own)]):
                kept += own
            at += len(own)
        assert html_extract.extract(html) == "\n".join(kept)


def test_very_long_and_deep_pages():
    assert html_extract.extract('<div class="a">' * 50_000 + PROSE) == SAID
    assert html_extract.extract("<div>" * 20_000 + "</p>" * 20_000 + PROSE).endswith("Short.")
    assert html_extract.extract("<nav>" * 20_000 + PROSE) == SAID
    assert len(html_extract.extract(f"<article>{PROSE * 20_000}</article>")) == 20_000 * (len(SAID) + 1) - 1


def test_pages_of_the_table_word_by_word(spark):
    import html as entities
    import re
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        own = re.search(r"<article[^>]*>(.*?)</article>", r.html, re.S).group(1)
        assert html_extract.extract(r.html).split() == entities.unescape(re.sub(r"<[^>]*>", " ", own)).split()


def test_html_query_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 0), (1, "u", PAGE, 0), (2, None, None, 1), (None, "v", "<p>x</p>", 2)],
                                  "page_id long, url string, html string, text int")
    same_rows(html_extract.extract_text(pages), [(1, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT)), (2, None, "", 0), (None, "v", "x", 1)])
    assert html_extract.extract_text(none_of(pages)).count() == 0
    got = queries.queries()["op10_html_extraction"](spark, SF1).collect()
    assert len(got) == 250
    for r in got:
        assert r.n_chars == len(r.text) and "©" not in r.text.split("\n")[-1] and "track(" not in r.text
