"""Every registered query with SQL against DuckDB on the small tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tabprep.sources.tables import TABLES

from conftest import SMALL

SQL = E.oracle_sql()
# the learners are covered by invariants in test_models; here only SQL ones
NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def test_every_sql_query_has_a_spark_query():
    assert set(SQL) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "id" and df.count() >= 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    sdf = E.queries()[name](spark, SMALL)
    rel = con.sql(SQL[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in sdf.columns]
    srows = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=_key)
    drows = sorted((tuple(_norm(r[i]) for i in order) for r in rel.fetchall()), key=_key)
    assert srows == drows
