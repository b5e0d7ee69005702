"""Every registered query against its DuckDB oracle on the sf0.001 tables;
keys without an oracle must at least run and return rows."""

from __future__ import annotations

import importlib.util
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from ratelake.sources.tables import TABLES

_spec = importlib.util.spec_from_file_location(
    "oracle_check", os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts", "oracle_check.py")
)
oracle_check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(oracle_check)

KEYS = sorted(E.queries())
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield con
    con.close()


def test_every_oracle_key_is_a_query():
    assert set(SQL) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["restaurant_name", "country", "city"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    got = E.queries()[key](spark, SF001).toPandas()
    if key not in SQL:
        assert len(got) > 0
        return
    want = duck.sql(SQL[key]).df()
    r = oracle_check.compare(got, want)
    assert r["status"] == "match", r
