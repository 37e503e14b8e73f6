"""Every query that has SQL gives the same rows as DuckDB does on the same tables."""

import duckdb
import pandas as pd
import pytest

from veritab.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def shown(value):
    if value is None or (not hasattr(value, "__len__") and pd.isna(value)):
        return ""
    if isinstance(value, float):
        return str(int(value)) if value.is_integer() else f"{value:.6g}"
    return str(value)


def rows(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(shown(v) for v in r) for r in df[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, sf, duck, name):
    assert rows(QUERIES[name](spark, sf).toPandas()) == rows(duck.sql(ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
