"""The corpus pipeline, stage by stage, against the brute force of each stage."""

from __future__ import annotations

import importlib

import corpus_pipeline
import __spark_entry__ as entry

from contrail.llm import packing

from .helpers import documents, none_of, odd_documents
from .test_corpus_operators import SF1, brute_hits, brute_lines, brute_links
from .test_packing_toxicity_html import check_packing
from .test_row_operators import brute_quality


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "near copies", "benchmark decontamination", "best-fit packing"]
    registered = entry.queries()
    assert {n.split("_")[0] for n in registered if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert registered["pipeline"] is corpus_pipeline.run
    assert importlib.import_module("contrail.llm.queries").oracle_sql().keys() <= registered.keys()


def test_each_stage_does_its_work_on_what_the_last_one_kept(spark, tmp_path):
    docs = documents(spark, SF1)
    names = docs.columns
    bench = [tuple(r) for r in spark.read.parquet(f"{SF1}/benchmark.parquet").collect()]
    stage = dict(corpus_pipeline.STAGES)

    def step(name, given):
        stage[name](spark, given, SF1).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    def texts(df):
        return [(r.doc_id, r.text) for r in df.collect()]

    one = step("quality rules", docs)
    assert one.columns == names
    assert {i for i, _ in texts(one)} <= {i for i, t in texts(docs) if not brute_quality(t)[-1]}
    two = step("line dedup", one)
    assert two.columns == names
    assert sorted(texts(two)) == sorted((i, t) for i, _, n, _, t in brute_lines(texts(one)) if t or not n)
    three = step("near copies", two)
    assert three.columns == names
    assert sorted(i for i, _ in texts(three)) == sorted(i for i, c, _, _ in brute_links(texts(two)) if i == c)
    four = step("benchmark decontamination", three)
    assert four.columns == names
    assert sorted(i for i, _ in texts(four)) == sorted(r[0] for r in brute_hits(texts(three), bench) if not r[-1])
    five = step("best-fit packing", four)
    check_packing(texts(four), five)


def test_run_and_odd_cases(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "sequence_id" in out.columns
    for docs in (odd_documents(spark), none_of(odd_documents(spark))):
        for _, f in corpus_pipeline.STAGES[:-1]:
            docs = f(spark, docs, "/root/testdata/sf0.001")
            assert docs.columns == odd_documents(spark).columns
        assert packing.pack(docs, corpus_pipeline.vocabulary_path()).count() >= docs.count()
