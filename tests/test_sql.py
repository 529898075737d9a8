"""Every registered query with a SQL counterpart against DuckDB on the smallest tables; the others must run."""

import datetime as dt
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck(data_dir):
    con = duckdb.connect()
    for path in Path(data_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", [n for n in contract.oracle_sql() if not re.match(r"p\d", n)])
def test_query_equals_sql(spark, duck, data_dir, name):
    got = contract.queries()[name](spark, data_dir)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(repr(plain(tuple(r))) for r in got.select(*columns).collect()) == sorted(repr(plain(r)) for r in result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
