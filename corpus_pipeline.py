"""Training-corpus pipeline over ``documents``: quality rules, line
deduplication, one document of each near-copy group, benchmark decontamination,
packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame; :func:`run` writes each result as Parquet in the shared
checkpoint folder and reads it again for the next stage, so that a lost
executor never costs more than the stage at hand; an earlier stage's files go
when the next one's are complete.

Defined cases, for every stage: null texts count as empty (the quality rules
reject them); very long texts are worked on whole; repeated rows and ties are treated as the
stage's operator says; an empty table passes through as an empty table; columns beyond
those of documents, whatever their names, are kept up to the packing stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from contrail.llm.common import remove_folder, shared_folder, table
from contrail.llm.queries import vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their failing lines."""
    return quality.clean_documents(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of three-line windows."""
    return line_dedup.dedup_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.drop_near_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, vocabulary_path())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("near copies", near_copies),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Packing needs the vocabulary's token ids, which SQL has no function for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for n, (_, stage) in enumerate(STAGES, 1):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
        if n > 1:
            remove_folder(spark, f"{folder}/{n - 1}")  # nothing reads it any more
    return docs
