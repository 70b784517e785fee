"""Attention over passages: gradients, held-out accuracy, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from contrail.llm import passage_quality as pq

from .helpers import documents, none_of, odd_documents

SF1 = "/root/testdata/sf0.1"


def labels(spark, sf=SF1):
    return spark.read.parquet(f"{sf}/labels.parquet")


def test_passages_cover_the_whole_text():
    text = "".join(f"w{i}{' ' if i % 7 else chr(10)}" for i in range(1000)).encode()
    bag = pq.encode(text)
    assert bag.shape == (-(-1000 // pq.PASSAGE), pq.WIDTH)
    assert np.allclose((bag[:, :-4] ** 2).sum(axis=1), 1)
    old = pq.BLOCK
    try:
        pq.BLOCK = 3
        assert np.array_equal(bag, pq.encode(text))
    finally:
        pq.BLOCK = old
    # The last passage alone says more than five hundred before it.
    assert not np.array_equal(pq.encode(text)[-1], pq.encode(text + b" ###")[-1])
    assert pq.encode(b" \n ").shape == (1, pq.WIDTH)


def test_repeated_words():
    words = b"a b c d e x a b c d e y a b c d".split()
    assert pq._repeated(words).tolist() == [True] * 5 + [False] + [True] * 5 + [False] * 5
    assert pq._repeated([b"a"] * 7).all() and not pq._repeated([b"a"] * 5).any()


def test_gradients_are_slopes():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(k, pq.WIDTH)) for k in (1, 3, 2)]
    y = np.array([1.0, 0.0, 1.0])
    model = pq.fit(bags, y, epochs=1)
    x, starts = model.scaled(np.concatenate(bags)), np.array([0, 1, 4])

    def loss() -> float:
        p = model._forward(x, starts)["score"]
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    slopes = model.gradients(x, starts, y)
    for name, w in model.weights.items():
        for at in [tuple(rng.integers(0, s) for s in w.shape) for _ in range(5)]:
            old = w[at]
            w[at] = old + 1e-5
            up = loss()
            w[at] = old - 1e-5
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-5 - slopes[name][at]) < 1e-6
    assert abs(model.attention(bags[1]).sum() - 1) < 1e-9


def test_held_out_accuracy_and_reproducible(spark):
    docs, told = documents(spark, SF1), labels(spark)
    first = pq.score(docs, pq.train(docs, told)).join(told, "doc_id").filter("held_out").collect()
    clean = [r for r in first if r.quality == 1]
    junk = [r for r in first if r.quality == 0]
    assert sum(r.predicted for r in clean) >= 0.99 * len(clean) and sum(r.predicted == 0 for r in junk) >= 0.95 * len(junk)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in first)
    # Another order of rows, other labels of held-out rows and other columns change nothing.
    turned = told.withColumn("quality", F.when(pq.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = pq.score(docs.repartition(5), pq.train(docs.repartition(3).withColumn("source", F.lit("z")), turned.repartition(4)))
    assert {r.doc_id: r.score for r in first} == {r.doc_id: r.score for r in again.join(told.select("doc_id"), "doc_id").filter("held_out").collect()}


def test_odd_rows(spark):
    odd = odd_documents(spark)
    told = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 11)] + [(3, 0, 0), (99, 1, 1), (None, 1, 0), (4, None, 0)],
                                 "doc_id long, quality int, toxic int")
    rows = pq.score(odd, pq.train(odd, told)).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1  # null, empty, blank
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    for some, expected in ((told.filter("quality = 1 and doc_id < 99"), 1.0), (none_of(told), 0.5)):
        assert {(r.score, r.predicted) for r in pq.score(odd, pq.train(odd, some)).collect()} == {(expected, 1)}
    assert pq.score(none_of(odd), pq.train(none_of(odd), told)).count() == 0
