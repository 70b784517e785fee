"""Documents with every odd case, and small helpers."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
#: nulls, empty and blank texts, ties, repeated rows, one very long line.
ODD = [
    (1, None), (2, ""), (3, " \n\t\n "), (4, "one"), (5, "same text here now ok " * 4), (5, "same text here now ok " * 4),
    (6, "same text here now ok " * 4), (None, "a row without an id but with some words."), (7, "x" * 30000),
    (8, "é ß Σ 漢字 \U0001f600 end."), (9, "word " * 20000), (10, "a\x0bb\x0cc\r\nd\x1ce"),
]


def odd_documents(spark: SparkSession) -> DataFrame:
    """ODD with extra columns whose names clash with names used inside."""
    rows = [(i, t, f"row {n}", n, 1.5) for n, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, words string, hits int, row double")


def none_of(df: DataFrame) -> DataFrame:
    return df.limit(0)


def documents(spark: SparkSession, sf: str = SF) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def same_rows(got: DataFrame, expected: list[tuple]) -> None:
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, expected), key=key)


__all__ = ["ODD", "SF", "documents", "none_of", "odd_documents", "pytest", "same_rows"]
