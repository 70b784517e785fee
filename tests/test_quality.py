"""Each check kind seen failing on a seeded violation and passing otherwise;
the batched report agrees with the one-check-at-a-time queries."""

import pytest

from conftest import HUBS

from contrail.operators import quality as Q
from contrail.operators.quality import Check
from contrail.plans import checks as C


@pytest.fixture(scope="module")
def t(spark):
    return spark.createDataFrame(
        [(1, "a", 5, "x"), (2, "b", -1, "y"), (2, None, 300, "z"), (4, "d", None, None)],
        "id bigint, code string, n bigint, p string")


def test_single_checks(spark, t):
    parent = spark.createDataFrame([("a",), ("b",)], "code string")
    assert Q.not_null(t, "code").count() == 1
    assert Q.unique(t, "id").count() == 1
    assert Q.accepted_values(t, "p", ["x", "y"]).count() == 1          # z; NULL passes
    assert Q.relationships(t, "code", parent, "code").count() == 1    # d; NULL passes
    assert Q.non_negative(t, "n").count() == 1
    assert Q.within_range(t, "n", 0, 100).count() == 2
    assert Q.within_range(t, "n", 0, 100, where="id = 1").count() == 0


def test_report_matches_single_checks(spark, t):
    parent = spark.createDataFrame([("a",), ("b",)], "code string")
    cat = [Check("t", "not_null", "code"), Check("t", "unique", "id"),
           Check("t", "unique", "concat(code, p)", label="combo"),
           Check("t", "accepted_values", "p", values=("x", "y")),
           Check("t", "relationships", "code", parent="parent", parent_field="code"),
           Check("t", "non_negative", "n"), Check("t", "within_range", "n", lo=0, hi=100),
           Check("t", "within_range", "n", lo=0, hi=100, where="id = 1", label="range_scoped")]
    tables = {"t": t, "parent": parent}
    report = {r.check_name: (r.violations, r.passed) for r in Q.run_checks(cat, tables).collect()}
    for c in cat:
        assert report[c.name][0] == Q.violations(c, tables).count(), c.name
    assert report["combo"] == (0, True)
    with pytest.raises(AssertionError):
        Q.gate(Q.run_checks(cat, tables))


def test_singular_checks(spark):
    f = spark.createDataFrame([(1, True, None, None), (2, True, 5, None), (3, False, 1, 2)],
                              "k bigint, c boolean, a bigint, b bigint")
    assert [r.k for r in Q.assert_implies_null(f, "c", ["a", "b"], "k").collect()] == [2]
    assert Q.reconcile_counts(f, f).count() == 0
    r = Q.reconcile_counts(f, f.limit(2)).first()
    assert (r.source_rows, r.fact_rows) == (3, 2)
    cov = Q.assert_coverage(f, "a", 99.0).first()
    assert (cov.total_flights, cov.matched_flights, cov.coverage_pct) == (3, 2, 66.67)
    assert Q.assert_coverage(f, "a", 50.0).count() == 0


def test_catalogue_on_fixture_reports_seeded_destination_gap(models):
    cat = C.declared_checks(HUBS)
    assert len(cat) == 103
    report = {r.check_name: r.violations for r in C.quality_report(models).collect()}
    assert len(report) == 103
    assert report["relationships__fct_flight__destination_airport_key"] == 1   # nobody knows ZZX
    failing = {k for k, v in report.items() if v}
    assert failing == {"relationships__fct_flight__destination_airport_key"}
    singular = {name: df.collect() for name, df in C.singular_checks(models).items()}
    assert [len(x) for x in singular.values()] == [0, 0, 1]
    assert singular["weather_covers_the_flights"][0].coverage_pct == 50.0


def test_row_level_checks_are_counted_by_the_job_that_writes(spark, t, tmp_path):
    cat = [Check("t", "not_null", "code"), Check("t", "accepted_values", "p", values=("x", "y'z")),
           Check("t", "non_negative", "n"), Check("t", "within_range", "n", lo=0, hi=100, where="id < 4"), Check("t", "unique", "id")]
    seen = Q.Observed(cat)
    seen.watch(t).write.parquet(str(tmp_path / "t"))
    assert {name: n for name, _, n in seen.rows(t)} == {c.name: Q.violations(c, {"t": t}).count() for c in cat if c.kind != "unique"}
    assert Q.Observed(cat[-1:]).rows(t) == []


def test_uniqueness_shuffles_hashes_and_compares_values_only_where_they_repeat(spark):
    wide = spark.range(1000).selectExpr("concat(repeat('x', 500), id) AS a", "CASE WHEN id % 100 = 0 THEN 'same' ELSE concat('y', id) END AS b",
                                        "CASE WHEN id > 5 THEN id END AS c")
    cat = [Check("w", "unique", "a"), Check("w", "unique", "b"), Check("w", "unique", "c"), Check("w", "unique", "b", where="c < 90", label="scoped")]
    assert [n for _, _, n in Q.count_duplicates(wide, cat)] == [0, 1, 0, 0] == [Q.violations(c, {"w": wide}).count() for c in cat]
    plan = Q._repeated_hashes(wide, cat)._jdf.queryExecution().executedPlan().toString()
    exchange = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchange and all("h#" in line and "a#" not in line for line in exchange)
