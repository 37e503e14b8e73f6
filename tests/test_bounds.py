"""What workers and states hold at once, and whole jobs."""

import io
import zipfile

import numpy as np
import pandas as pd
import pytest


def test_sheet_is_read_row_by_row():
    from veritab.operators.export import workbook
    from veritab.sources.files import sheet_rows

    whole = workbook({"one": (["id"], [[i] for i in range(20_000)])})
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(whole)) as z, zipfile.ZipFile(out, "w") as cut:
        for name in z.namelist():
            cut.writestr(name, z.read(name)[: -200 if name.endswith("sheet1.xml") else None])
    rows = sheet_rows(out.getvalue())
    # a file that ends too early is an error, but not before its rows were read
    assert next(rows) == ("one", 1, ["id"]) and next(rows) == ("one", 2, ["0"])
    with pytest.raises(Exception, match="unclosed token|no element found"):
        list(rows)
    assert [r[2][0] for r in sheet_rows(whole)][1:] == [str(i) for i in range(20_000)]


def test_pages_come_a_few_at_once(spark):
    from veritab.sources import files, markup

    pages = spark.createDataFrame([(1, "https://a.example.com/", "<a href='/x.pdf'>x</a><table><tr><td>1</td></tr></table>")], "page_id long, url string, html string")
    for read in (files.html_tables, markup.markup_links):
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert read(pages).count() == 1 and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == str(files.PAGE_BATCH)


def test_state_grows_with_an_entitys_rows():
    from test_queues import State

    from veritab.streaming import queues

    state, rng = State(), np.random.default_rng(1)
    rows = pd.DataFrame({"position": rng.permutation(60_000_000)[:500], "flags": 1})
    assert [list(p[["rows", "f0"]].iloc[0]) for p in queues.advanced((7,), iter([rows, rows]), state, 1000)] == [[500, 500]]
    assert sum(len(x) if isinstance(x, bytes) else sum(len(y) if isinstance(y, bytes) else 8 for y in x) for x in state.get if isinstance(x, bytes | list)) == 8 * 500


def test_category_deltas_of_all_units(spark, sf):
    from veritab.operators import diff
    from veritab.plans import queries

    t = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
    of_type = {tuple(r) for r in diff.align_categories(*queries._sides(t), ["scope"])[2].collect()}
    got = {tuple(r) for r in queries.QUERIES["category_deltas"](spark, sf).collect()}
    assert of_type and of_type <= got and any(unit.isdigit() for _, unit, *_ in got)
