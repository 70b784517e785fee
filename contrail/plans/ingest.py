"""Ingest: load every raw source into its raw table and record the load.

Monthly sources are replaced month by month (``load_monthly``), the others
replaced whole (``load_full``).  The sources are independent, so their jobs
are submitted from several driver threads and share the executors; the audit
rows of the whole run are appended in one write at the end (concurrent
appends into one folder would race on the committer's temporary directory).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from contrail.operators import rejects, sinks
from contrail.sources.readers import SOURCES, Source


def ingest(spark: SparkSession, raw: Mapping[str, DataFrame], root: str,
           months: Iterable[str] | None = None, sources: Sequence[Source] = SOURCES,
           loaded_at: dt.datetime | None = None, threads: int = 6, reject_limit: int = 0) -> dict[str, dict]:
    """Load ``raw[name]`` for each source into ``{root}/{name}``.

    ``months`` selects the months of the monthly sources (default: every
    month present in each file).  Returns ``{name: {month or None: rows}}``;
    the same counts are appended to ``{root}/load_audit``.  Sources read with
    ``on_bad="keep"`` may hold up to ``reject_limit`` bad rows each, which go to
    ``{root}/rejects`` (replaced by each ingest); a source with more keeps its old table.
    """
    root = root.rstrip("/")
    selected = list(months) if months is not None else None
    clock = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def load(src: Source) -> tuple[str, dict]:
        df, check = raw[src.name], None
        if rejects.is_marked(df):
            intakes[src.name] = intake = rejects.Intake(src.name, df, reject_limit)
            df, check = intake.good(), intake.check
        if src.monthly:
            return src.name, sinks.load_monthly(spark, df, f"{root}/{src.name}", selected, check)
        return src.name, {None: sinks.load_full(spark, df, f"{root}/{src.name}", check)}

    intakes: dict[str, rejects.Intake] = {}
    todo = [s for s in sources if s.name in raw]
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        results = dict(pool.map(load, todo))
    audit = None
    for i, src in enumerate(todo):
        rows = sinks.audit_rows(spark, src.name, results[src.name], src.file, clock + dt.timedelta(seconds=i))
        audit = rows if audit is None else audit.unionByName(rows)
    if audit is not None:
        sinks.append_audit(audit.coalesce(1), f"{root}/load_audit")
    if intakes:
        found = spark.createDataFrame([], rejects.SCHEMA)
        for intake in intakes.values():
            if intake.bad:
                found = found.unionByName(intake.rejects())
        sinks.replace_table(spark, found, f"{root}/rejects")
    return results
