"""Every registered query against its independent SQL oracle (DuckDB) on the
smallest generated tables: same columns, same types, same multiset of rows."""

import collections
import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_TINY
from contrail.plans import catalog

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_TINY}/{t}.parquet')")
    return c


def _bag(values, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: float(v) if isinstance(v, decimal.Decimal) else v
    return collections.Counter(tuple(norm(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_TINY)
    s_rows = df.collect()
    sql = E.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    rel = con.sql(sql)
    d_cols, d_types, d_rows = rel.columns, [str(t) for t in rel.types], rel.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    assert s_types == dict(zip(d_cols, d_types))
    assert _bag(s_rows, df.columns) == _bag(d_rows, d_cols)


def test_entry_runs(spark):
    out = E.entry(spark).collect()
    assert len(out) > 0


def test_utc_conversion_ignores_session_zone(spark, raw):
    from contrail.plans.staging import stg_flight
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        hours = sorted(r[0] for r in stg_flight(raw["flights"]).select("scheduled_departure_hour_utc").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert hours[0] == dt.datetime(2013, 7, 3, 13)
