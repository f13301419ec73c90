"""Every named query with a SQL form must equal DuckDB; trained models are tested on their own."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import kind, normal

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    want = duck.sql(ORACLE[name])
    assert {c: kind(t) for c, t in df.dtypes} == {
        c: kind(str(t)) for c, t in zip(want.columns, want.types)
    }
    got, expected = normal(df.toPandas()), normal(want.df())
    assert len(expected) > 0
    assert got.equals(expected)


def test_comparison_sees_single_milliseconds():
    one, other = (normal(pd.DataFrame({"ms": [v, None], "n": [v, v]})) for v in (1_700_000_000_123, 1_700_000_000_124))
    assert not one.equals(other)


def test_oracles_belong_to_queries():
    assert set(ORACLE) <= set(queries())


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0
