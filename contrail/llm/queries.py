"""The registered queries of this subpackage: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import (
    decontaminate, html_extract, jaccard_join, line_dedup, packing, passage_quality, periodic_runs, pii, quality,
    secret_scan, spelling_variants, token_counts, toxicity,
)
from contrail.llm.common import table

#: The vocabulary that the contracts of token counts and packing name.
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_documents(spark, sf_dir)).drop("text", "cleaned")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), vocabulary_path())


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_documents(spark, sf_dir))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), vocabulary_path())


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(_documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_documents(spark, sf_dir))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_documents(spark, sf_dir))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.detect(_documents(spark, sf_dir))


def op12_passage_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return passage_quality.score(docs, passage_quality.train(docs, table(spark, sf_dir, "labels")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(_documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    from contrail.llm.oracles import ORACLES

    return ORACLES
