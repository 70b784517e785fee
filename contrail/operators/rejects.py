"""Rows that don't fit their declared types: taken out, counted, stored.

A source read with ``on_bad="keep"`` marks such rows instead of failing.  The job that
loads the good rows counts both kinds on its way (an ``Observation``), so a file is parsed
once.  More bad rows than the limit end the load before anything is
published; fewer are stored, one row for each bad field, which takes a second look
at the file only where there are any.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from contrail.sources.readers import BAD, FILE, RECORD, REJECT_COLUMNS

SCHEMA = "source string, file string, column string, value string, record string"


class TooManyRejects(ValueError):
    """A source holds more bad rows than the load allows."""


@dataclass
class Intake:
    """One load of a marked source."""

    source: str
    rows: DataFrame
    limit: int
    _seen: Observation = field(default_factory=Observation)

    def good(self) -> DataFrame:
        """The rows to load; counts them all when they are written."""
        seen = self.rows.observe(self._seen, F.expr("count(1) AS rows"), F.expr(f"count_if(size({BAD}) > 0) AS bad"))
        return seen.where(F.size(BAD) == 0).drop(*REJECT_COLUMNS)

    def check(self) -> None:
        """After the write: fails beyond the limit."""
        if self.bad > self.limit:
            raise TooManyRejects(f"{self.source}: {self.bad} rows don't fit their declared types, {self.limit} are allowed")

    @property
    def bad(self) -> int:
        try:
            return int(self._seen.get["bad"])
        except Py4JJavaError:  # the job had nothing to do and counted nothing
            return self.rows.where(F.size(BAD) > 0).count()

    def rejects(self) -> DataFrame:
        """One row for each bad field."""
        return self.rows.where(F.size(BAD) > 0).select(
            F.lit(self.source).alias("source"), F.col(FILE).alias("file"), F.explode(BAD).alias("b"), F.col(RECORD).alias("record")).select(
            "source", "file", F.col("b.column").alias("column"), F.col("b.value").alias("value"), "record")


def is_marked(df: DataFrame) -> bool:
    return set(REJECT_COLUMNS) <= set(df.columns)
