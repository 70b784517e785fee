"""Write, check, publish.

A job writes its tables, or the partitions of one, into staging folders that no
reader sees (their names begin with an underscore).  What it wrote can be read
and checked there.  Publishing is one list of folder moves: the list is stored
first, in one file, which decides the matter; then the moves are made, then the
file goes.  A driver that dies before the file is there has changed nothing; one
that dies later is finished by the next publication or :func:`recover`.  So the
tables of a release, or the partitions of a merge, change together, and nothing
is written twice.

The moves are renames: one metadata operation each, whatever the data's size.
"""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from contrail.session import child_names, move_path, path_exists, read_text, remove_path, write_text

STAGED = "_staged-"
JOURNAL = "_publish"


class Publication:
    """Changes under ``root`` that become visible together."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.id = uuid.uuid4().hex[:12]
        self.moves: list[tuple[str | None, str]] = []
        self._staged: list[str] = []
        self._numbers = itertools.count()

    def stage(self, table: str) -> str:
        """A staging folder inside the table's folder."""
        path = f"{table.rstrip('/')}/{STAGED}{self.id}-{next(self._numbers)}"
        self._staged.append(path)
        return path

    def put(self, source: str, target: str) -> None:
        """``source`` takes the place of ``target``."""
        self.moves.append((source, target))

    def drop(self, target: str) -> None:
        self.moves.append((None, target))

    def commit(self) -> None:
        if self.moves:
            journal = f"{self.root}/{JOURNAL}/{self.id}.json"
            write_text(self.spark, journal, json.dumps(self.moves))
            # Decided: what is staged belongs to the journal now, also if this driver fails here.
            moves, staged = self.moves, self._staged
            self.moves, self._staged = [], []
            _apply(self.spark, moves)
            remove_path(self.spark, journal)
            self._staged = staged
        self.abandon()

    def abandon(self) -> None:
        """Remove what was staged and not published."""
        for path in self._staged:
            remove_path(self.spark, path)
        self.moves, self._staged = [], []

    def __enter__(self) -> "Publication":
        return self

    def __exit__(self, kind, *_) -> None:
        self.abandon()


def _apply(spark: SparkSession, moves: Sequence[Sequence[str | None]]) -> None:
    """Make the moves that aren't made yet."""
    for source, target in moves:
        if source is None:
            remove_path(spark, target)
        elif path_exists(spark, source):
            if path_exists(spark, target):
                remove_path(spark, target)
            move_path(spark, source, target)


def recover(spark: SparkSession, root: str) -> int:
    """Finish publications whose driver died after it had decided; returns
    their number.  Not while another driver publishes under ``root``."""
    folder = f"{root.rstrip('/')}/{JOURNAL}"
    found = [n for n in child_names(spark, folder) if n.endswith(".json") and not n.startswith(".")]
    for name in found:
        _apply(spark, json.loads(read_text(spark, f"{folder}/{name}")))
        remove_path(spark, f"{folder}/{name}")
    return len(found)


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The partition folders below ``path``, as ``a=1/b=2``."""
    found = [""]
    for _ in range(depth):
        found = [f"{at}/{n}".lstrip("/") for at in found for n in child_names(spark, f"{path}/{at}".rstrip("/")) if "=" in n and n[0] not in "._"]
    return found
