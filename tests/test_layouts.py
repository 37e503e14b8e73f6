"""Roles of columns by assignment, and lists read by them."""

from itertools import permutations

import numpy as np
import pytest

from veritab.operators.layouts import assigned, listed_institutions


def best(score):
    """The largest sum over all ways to give rows columns, by trying them."""
    rows, columns = score.shape
    padded = np.concatenate([np.maximum(score, 0), np.zeros((rows, rows))], 1)
    return max(sum(padded[i, j] for i, j in enumerate(p)) for p in permutations(range(columns + rows), rows))


@pytest.mark.parametrize("seed", range(12))
def test_assignment_is_best(seed):
    rng = np.random.default_rng(seed)
    score = np.round(rng.normal(0.3, 1, (rng.integers(1, 5), rng.integers(1, 5))), 1)
    got = assigned(score)
    taken = [j for j in got if j >= 0]
    assert len(taken) == len(set(taken))
    assert sum(score[i, j] for i, j in enumerate(got) if j >= 0) == pytest.approx(best(score))


def cells(spark, *tables):
    rows = [(page, 0, r, c, text, None, False) for page, table in tables for r, line in enumerate(table) for c, text in enumerate(line)]
    return spark.createDataFrame(rows, "page_id long, tab int, row int, col int, text string, href string, is_header boolean")


def test_two_addresses_and_no_header(spark):
    table = [["東京専門学校", "東京都港区1-1", "学校法人東京学園", "東京都新宿区2-2"], ["大阪短期大学", "大阪府大阪市北区3", "学校法人大阪学院", ""]]
    got = {r["name"]: r for r in listed_institutions(cells(spark, (1, table))).collect()}
    assert got["東京専門学校"]["address"] == "東京都港区1-1" and got["東京専門学校"]["owner_address"] == "東京都新宿区2-2"
    assert got["大阪短期大学"]["owner"] == "学校法人大阪学院" and got["大阪短期大学"]["owner_address"] is None


def test_header_decides_where_cells_are_alike(spark):
    table = [["設置者住所", "学校名", "住所"], ["東京都港区1", "東京専門学校", "東京都北区2"]]
    (r,) = listed_institutions(cells(spark, (1, table))).collect()
    assert (r["address"], r["owner_address"]) == ("東京都北区2", "東京都港区1")


def test_rows_that_are_no_institutions(spark):
    table = [["学校名", "備考"], ["(私立専門学校)", ""], ["修学支援制度の対象機関一覧", ""], ["東京専門学校", "https://e.jp/a 統合"], ["", "x"], [None, None]]
    (r,) = listed_institutions(cells(spark, (1, table), (2, [["x", "y"]]))).collect()
    assert (r["name"], r["url"], r["page_id"]) == ("東京専門学校", "https://e.jp/a", 1)
    assert listed_institutions(cells(spark, (1, table)).filter("false")).count() == 0


def test_address_in_the_next_row_only(spark):
    table = [["学校名", "備考"], ["東京専門学校", ""], ["https://a.jp/", None], ["大阪短期大学", None], ["", ""], ["https://b.jp/", None], ["京都大学校", "https://c.jp/"], ["福岡看護学院", ""]]
    got = {r["name"]: r["url"] for r in listed_institutions(cells(spark, (1, table), (2, table[3:4]), (None, table))).collect()}
    assert got == {"東京専門学校": "https://a.jp/", "大阪短期大学": None, "京都大学校": "https://c.jp/", "福岡看護学院": None}


def test_lists_are_made_once(spark, sf):
    from veritab.plans.queries import QUERIES

    plan = QUERIES["listed_institutions"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("ArrowEvalPython") == 2
