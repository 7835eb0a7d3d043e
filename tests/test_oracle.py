"""Every registered query next to its SQL text on DuckDB."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from tests.conftest import SF

_spec = importlib.util.spec_from_file_location("check", Path(__file__).resolve().parent.parent / "tools" / "check.py")
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert check.rows_of(df.columns, got) == check.rows_of(names, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
