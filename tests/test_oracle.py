"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from bidbox.plans.registry import TABLES

from .conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(t[i]) for i in order) for t in tuples), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(sdf.columns, srows) == _rows(dcols, drows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "luck_delta" in df.columns
