"""Data-quality checks.  Each check is a query returning the violating rows
(pass = empty); ``run_checks`` evaluates a whole catalogue in one job.

At scale the catalogue must not become one scan per check:

* row-level checks (not null, accepted values, non-negative, range) of a table that
  is being written are counted by the job that writes it (:class:`Observed`); those
  of a view share one scan;
* uniqueness goes in two phases: all checks of a table count 64-bit hashes in one
  shuffle of eight bytes a row and check; whole values are compared only where a
  hash repeats;
* all foreign keys of a table share one anti join of distinct keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROW_LEVEL = ("not_null", "accepted_values", "non_negative", "within_range")


@dataclass(frozen=True)
class Check:
    """A declared check on ``table``.

    ``column`` is a column name or a Spark SQL expression (for uniqueness of a
    combination); ``where`` is an optional SQL predicate restricting the rows.
    """

    table: str
    kind: str
    column: str
    values: tuple = ()
    lo: float | None = None
    hi: float | None = None
    parent: str | None = None
    parent_field: str | None = None
    where: str | None = None
    label: str | None = field(default=None, compare=False)

    @property
    def name(self) -> str:
        if self.label:
            return self.label
        col = "".join(ch if ch.isalnum() or ch == "_" else "_" for ch in self.column).strip("_")
        return f"{self.kind}__{self.table}__{col}"


def _value(c: Check) -> Column:
    return F.expr(c.column)


def _scoped(df: DataFrame, c: Check) -> DataFrame:
    return df.where(F.expr(c.where)) if c.where else df


def _literal(v) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else repr(v)


def violation_sql(c: Check) -> str:
    """A row-level check as SQL text that is true on a violating row.  One parse
    for each check: a catalogue of Column objects takes thousands of calls to the JVM."""
    v = f"({c.column})"
    if c.kind == "not_null":
        return f"{v} IS NULL"
    if c.kind == "accepted_values":
        return f"{v} IS NOT NULL AND {v} NOT IN ({', '.join(map(_literal, c.values))})"
    if c.kind == "non_negative":
        return f"{v} < 0"
    if c.kind == "within_range":
        return f"({v} < {_literal(c.lo)} OR {v} > {_literal(c.hi)})"
    raise ValueError(f"not a row-level check: {c.kind}")


def violation_predicate(c: Check) -> Column:
    return F.expr(violation_sql(c))


def _count_sql(c: Check) -> str:
    scope = f" AND ({c.where})" if c.where else ""
    return f"CAST(count_if({violation_sql(c)}{scope}) AS BIGINT)"


class Observed:
    """Row-level checks of a table, counted by the job that computes it.

    A task that runs again after a loss may count its violations again, so a
    count can be too high, but never 0 where there is a violation, nor
    more than 0 where there is none."""

    def __init__(self, group: Sequence[Check]):
        self.checks = [c for c in group if c.kind in ROW_LEVEL]
        self._observation = Observation() if self.checks else None

    def watch(self, df: DataFrame) -> DataFrame:
        if not self.checks:
            return df
        return df.observe(self._observation, *[F.expr(f"{_count_sql(c)} AS _c{i}") for i, c in enumerate(self.checks)])

    def rows(self, table: DataFrame) -> list[tuple[str, str, int]]:
        """(check, table, violations), once the job has run.  Where a job turned out to have
        nothing to do, Spark may leave out the step that counts; then ``table`` is scanned."""
        if not self.checks:
            return []
        try:
            found = self._observation.get
        except Py4JJavaError:
            found = table.selectExpr(*[f"{_count_sql(c)} AS _c{i}" for i, c in enumerate(self.checks)]).first()
        return [(c.name, c.table, int(found[f"_c{i}"])) for i, c in enumerate(self.checks)]


def not_null(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    return violations(Check("t", "not_null", column, where=where), {"t": df})


def unique(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    return violations(Check("t", "unique", column, where=where), {"t": df})


def accepted_values(df: DataFrame, column: str, values: Sequence, where: str | None = None) -> DataFrame:
    return violations(Check("t", "accepted_values", column, values=tuple(values), where=where), {"t": df})


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_field: str,
                  where: str | None = None) -> DataFrame:
    return violations(Check("c", "relationships", column, parent="p", parent_field=parent_field, where=where),
                      {"c": child, "p": parent})


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return violations(Check("t", "non_negative", column), {"t": df})


def within_range(df: DataFrame, column: str, lo: float, hi: float, where: str | None = None) -> DataFrame:
    return violations(Check("t", "within_range", column, lo=lo, hi=hi, where=where), {"t": df})


def violations(c: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows a check reports (the same rows its SQL test would return)."""
    df = _scoped(tables[c.table], c)
    v = _value(c)
    if c.kind in ROW_LEVEL:
        return df.where(violation_predicate(c))
    if c.kind == "unique":
        return (df.where(v.isNotNull()).groupBy(v.alias("unique_field"))
                  .agg(F.count(F.lit(1)).cast("bigint").alias("n_records"))
                  .where(F.col("n_records") > 1))
    if c.kind == "relationships":
        # Distinct keys meet the parent; only the few orphans meet the whole rows again.
        parent = tables[c.parent].select(F.col(c.parent_field).alias("_parent_key"))
        keys = df.select(v.alias("_child_key")).where(F.col("_child_key").isNotNull()).distinct()
        orphans = keys.join(parent, on=F.col("_child_key") == F.col("_parent_key"), how="left_anti")
        return df.join(orphans, on=v == F.col("_child_key"), how="left_semi")
    raise ValueError(f"unknown check kind: {c.kind}")


def _stack_counts(counts: DataFrame, names: Sequence[str], table: str) -> DataFrame:
    """One-row frame of ``_c{i}`` counts -> rows ``(check_name, table_name, violations)``."""
    stacked = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"_c{i}").alias("violations"))
                        for i, n in enumerate(names)])
    return (counts.select(F.explode(stacked).alias("r"))
                  .select("r.check_name", F.lit(table).alias("table_name"), "r.violations"))


def _tagged(c: Check, i: int, value: str) -> str:
    """SQL for ``struct(i, v)`` of rows in the check's scope, else NULL."""
    entry = f"named_struct('i', {i}, 'v', {value})"
    return f"CASE WHEN {c.where} THEN {entry} END" if c.where else entry


def _pairs(df: DataFrame, group: Sequence[Check], value: str) -> DataFrame:
    """(i, v): each check's value on each row, where there is one; ``value`` is SQL
    in which {v} is the check's column."""
    told = ", ".join(_tagged(c, i, value.format(v=f"({c.column})")) for i, c in enumerate(group))
    return df.selectExpr(f"explode(filter(array({told}), p -> p IS NOT NULL AND p.v IS NOT NULL)) AS p").select("p.i", "p.v")


def _row_level_part(df: DataFrame, table: str, group: Sequence[Check]) -> DataFrame:
    counts = df.selectExpr(*[f"{_count_sql(c)} AS _c{i}" for i, c in enumerate(group)])
    return _stack_counts(counts, [c.name for c in group], table)


# The string form of a value is exact for its type.
_TEXT, _HASH = "CAST({v} AS STRING)", "CASE WHEN {v} IS NOT NULL THEN xxhash64(CAST({v} AS STRING)) END"


def _repeated_hashes(df: DataFrame, group: Sequence[Check]) -> DataFrame:
    """(i, h) of hashes that occur more than once: all uniqueness checks of a
    table in one shuffle of hashes."""
    return _pairs(df, group, _HASH).withColumnRenamed("v", "h").groupBy("i", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("i", "h")


def _repeated_values(df: DataFrame, group: Sequence[Check], hashes: DataFrame) -> DataFrame:
    """(i, v) of values that occur more than once; only those with one of ``hashes`` are looked at."""
    pairs = _pairs(df, group, _TEXT).withColumn("h", F.xxhash64("v"))
    some = pairs.join(hashes, ["i", "h"], "left_semi")
    return some.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("i", "v")


def _unique_part(df: DataFrame, table: str, group: Sequence[Check]) -> DataFrame:
    found = _repeated_values(df, group, _repeated_hashes(df, group))
    counts = found.selectExpr(*[f"CAST(count_if(i = {i}) AS BIGINT) AS _c{i}" for i in range(len(group))])
    return _stack_counts(counts, [c.name for c in group], table)


def count_duplicates(df: DataFrame, group: Sequence[Check], watched: DataFrame | None = None) -> list[tuple[str, str, int]]:
    """(check, table, violations) of uniqueness checks on one table.  Whole
    values are read only for the checks that have a repeated hash.  ``watched``: ``df``
    with row-level checks that the same job is to count."""
    hit = {r["i"] for r in _repeated_hashes(df if watched is None else watched, group).groupBy("i").count().collect()}
    some = [c for i, c in enumerate(group) if i in hit]
    found = {}
    if some:
        found = {r["i"]: r["count"] for r in _repeated_values(df, some, _repeated_hashes(df, some)).groupBy("i").count().collect()}
    return [(c.name, c.table, int(found.get(some.index(c), 0)) if c in some else 0) for c in group]


def _relationship_part(df: DataFrame, table: str, group: Sequence[Check],
                       tables: Mapping[str, DataFrame]) -> DataFrame:
    """All foreign-key checks of a child table in one anti join.  The child's
    keys are first reduced to (check, key, rows) — partial aggregation, so the
    join shuffles distinct keys, not fact rows, however hot a key is."""
    child = _pairs(df, group, _TEXT).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    parents = None
    for i, c in enumerate(group):
        keys = tables[c.parent].select(F.lit(i).alias("i"), F.col(c.parent_field).cast("string").alias("v"))
        parents = keys if parents is None else parents.unionByName(keys)
    orphans = child.join(parents.distinct(), on=["i", "v"], how="left_anti")
    counts = orphans.selectExpr(*[f"CAST(coalesce(sum(CASE WHEN i = {i} THEN n END), 0) AS BIGINT) AS _c{i}" for i in range(len(group))])
    return _stack_counts(counts, [c.name for c in group], table)


def _by_table(checks: Sequence[Check]) -> dict[str, dict[str, list[Check]]]:
    grouped: dict[str, dict[str, list[Check]]] = {}
    for c in checks:
        kind = "row" if c.kind in ROW_LEVEL else c.kind
        if kind not in ("row", "unique", "relationships"):
            raise ValueError(f"unknown check kind: {c.kind}")
        grouped.setdefault(c.table, {}).setdefault(kind, []).append(c)
    return grouped


REPORT = "check_name string, table_name string, violations bigint"


def report_of(spark: SparkSession, rows: Sequence[tuple[str, str, int]]) -> DataFrame:
    """Counted checks as a report."""
    report = spark.createDataFrame(list(rows), REPORT)
    return report.withColumn("passed", F.col("violations") == 0)


def run_checks_concurrently(checks: Sequence[Check], tables: Mapping[str, DataFrame],
                            threads: int = 8) -> DataFrame:
    """Same report as ``run_checks``, from :func:`count_checks`."""
    return report_of(next(iter(tables.values())).sparkSession, count_checks(checks, tables, threads))


def count_checks(checks: Sequence[Check], tables: Mapping[str, DataFrame], threads: int = 8) -> list[tuple[str, str, int]]:
    """(check, table, violations): each table's kinds of checks are jobs of
    their own, submitted from ``threads`` driver threads so small jobs overlap.  Only
    the per-check counts come back to the driver (one row per check)."""
    from concurrent.futures import ThreadPoolExecutor

    def counted(part: DataFrame) -> list[tuple[str, str, int]]:
        return [(r.check_name, r.table_name, int(r.violations)) for r in part.collect()]

    def unique_and_rows(df: DataFrame, group: Sequence[Check], rows: Sequence[Check]) -> list[tuple[str, str, int]]:
        seen = Observed(rows)
        return count_duplicates(df, group, seen.watch(df)) + seen.rows(df)

    jobs = []
    for table, kinds in _by_table(checks).items():
        df = tables[table]
        if "unique" in kinds:
            jobs.append(lambda df=df, group=kinds["unique"], rows=kinds.get("row", ()): unique_and_rows(df, group, rows))
        elif "row" in kinds:
            jobs.append(lambda df=df, t=table, group=kinds["row"]: counted(_row_level_part(df, t, group)))
        if "relationships" in kinds:
            jobs.append(lambda df=df, t=table, group=kinds["relationships"]: counted(_relationship_part(df, t, group, tables)))
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        return [row for found in pool.map(lambda job: job(), jobs) for row in found]


def run_checks(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: ``check_name, table_name, violations, passed``.

    Per table, at most three parts: uniqueness, row-level checks, foreign keys.
    The report is a single DataFrame, so one action evaluates the whole catalogue.
    """
    parts: list[DataFrame] = []
    for table, kinds in _by_table(checks).items():
        df = tables[table]
        if "unique" in kinds:
            parts.append(_unique_part(df, table, kinds["unique"]))
        if "row" in kinds:
            parts.append(_row_level_part(df, table, kinds["row"]))
        if "relationships" in kinds:
            parts.append(_relationship_part(df, table, kinds["relationships"], tables))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report.withColumn("passed", F.col("violations") == 0)


def gate(report: DataFrame) -> None:
    """Raise when any check failed (stops downstream models)."""
    failed = report.where(~F.col("passed")).select("check_name", "violations").collect()
    if failed:
        raise AssertionError("data checks failed: " + ", ".join(f"{r[0]}={r[1]}" for r in failed))


# Singular checks ---------------------------------------------------------

def assert_implies_null(df: DataFrame, flag: str, cols: Sequence[str], key: str) -> DataFrame:
    """Rows where ``flag`` holds but one of ``cols`` is not NULL."""
    any_set = F.lit(False)
    for c in cols:
        any_set = any_set | F.col(c).isNotNull()
    return df.where(F.col(flag) & any_set).select(key, *cols)


def reconcile_counts(a: DataFrame, b: DataFrame, a_name: str = "source_rows",
                     b_name: str = "fact_rows") -> DataFrame:
    """One row ``(a_rows, b_rows)`` when the two row counts differ, else none.
    Both counts come from one union + one global aggregate — no join."""
    tagged = (a.select(F.lit(1).alias("_a"), F.lit(0).alias("_b"))
               .unionByName(b.select(F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    totals = tagged.agg(F.coalesce(F.sum("_a"), F.lit(0)).cast("bigint").alias(a_name),
                        F.coalesce(F.sum("_b"), F.lit(0)).cast("bigint").alias(b_name))
    return totals.where(F.col(a_name) != F.col(b_name))


def assert_coverage(df: DataFrame, matched_col: str, min_pct: float,
                    total_name: str = "total_flights", matched_name: str = "matched_flights") -> DataFrame:
    """One row ``(total, matched, coverage_pct)`` when fewer than ``min_pct``
    percent of rows have ``matched_col`` set."""
    from contrail.functions import rate_pct
    agg = df.agg(F.count(F.lit(1)).cast("bigint").alias(total_name),
                 F.count_if(F.col(matched_col).isNotNull()).cast("bigint").alias(matched_name))
    ratio = F.try_divide(F.lit(100.0) * F.col(matched_name).cast("double"), F.col(total_name).cast("double"))
    return (agg.select(total_name, matched_name, rate_pct(matched_name, total_name).alias("coverage_pct"),
                       ratio.alias("_ratio"))
               .where(F.col("_ratio") < F.lit(float(min_pct))).drop("_ratio"))
