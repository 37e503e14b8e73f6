"""The corpus pipeline, stage by stage, and the queries' SQL."""

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from veritab.llm import registry
from veritab.llm.frames import written


def test_stages(spark, sf):
    docs = first = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, sf), name)
        counts.append(docs.count())
        if name != "byte_bpe":
            assert docs.columns == first.columns
        if name in ("quality_classifier", "near_dedup"):
            assert docs.exceptAll(before).count() == 0
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0 and counts[4] == counts[5]


def test_same_as_run(spark, sf):
    a, b = (corpus_pipeline.run(spark, sf).collect() for _ in range(2))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    expected, got = con.sql(registry.ORACLE_SQL[name]).df(), registry.QUERIES[name](spark, sf).toPandas()
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    # rows are put in order by what is no fraction, so that fractions meet their own
    exact = [c for c in columns if expected[c].dtype.kind != "f" or expected[c].dropna().mod(1).eq(0).all()]
    text = lambda v: "" if pd.isna(v) else str(int(v)) if isinstance(v, float) else str(v)
    a, b = (x.assign(_order=[tuple(map(text, r)) for r in x[exact].astype(object).itertuples(index=False)]).sort_values("_order", kind="stable").reset_index(drop=True) for x in (expected, got))
    assert a["_order"].tolist() == b["_order"].tolist()
    for c in set(columns) - set(exact):
        assert a[c].astype(float).fillna(-1).tolist() == pytest.approx(b[c].astype(float).fillna(-1).tolist())
