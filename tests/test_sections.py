"""Unit records of page texts, on small pages told by hand."""

import pytest

from veritab.operators import sections

MEASURES = ("capacity", "enrollment", "intl_students", "graduates", "advanced", "employed", "other", "prev_enrollment", "dropouts", "dropout_rate")


def read(spark, *texts, doc="d"):
    return sections.unit_records(spark.createDataFrame([(doc, i, t) for i, t in enumerate(texts)], "doc_id string, page int, text string")).collect()


HEAD = "分野 課程名 学科名\n"
SEATS = "生徒総定員数 生徒実員 うち留学生数\n80人 75人 5人\n"


def test_whole_card(spark):
    (r,) = read(spark, HEAD + "工業 工業専門課程 ＡＩ システム科 〇\n修業年限\n３年 昼\n" + SEATS, "卒業者数 進学者数 就職者数 その他\n1,030人 4人 22人 7人\n100%\n中途退学の現状\n年度当初在学者数 76人 途中 4人 5.2%\n（主な理由）\n9 8 7")
    assert (r["name"], r["course_name"], r["duration_years"], r["shift"]) == ("AIシステム科", "工業専門課程", 3.0, "昼")
    assert tuple(r[m] for m in MEASURES) == (80, 75, 5, 1030, 4, 22, 7, 76, 4, 5.2)


def test_split_heading_over_pages(spark):
    (r,) = read(spark, "分野\n課程名", "学科名\n衛生関係\n衛生専門課程\n美容科\n生徒総定\n員数\n40人", "30人\nY0\n成績評価の基準\n99人 98人 97人")
    assert (r["name"], r["course_name"], r["capacity"], r["enrollment"], r["intl_students"]) == ("美容科", "衛生専門課程", 40, 30, 0)
    assert all(r[m] is None for m in MEASURES[3:])


def test_first_region_with_numbers_counts(spark):
    (r,) = read(spark, HEAD + "看護学科\n定員数は別に定める\n成績評価の基準\n" + SEATS + "生徒総定員 1人 2人 3人")
    assert r["capacity"] == 80


def test_course_and_name_swapped(spark):
    (r,) = read(spark, HEAD + "デジタル専門\n映像学科\n" + SEATS)
    assert (r["name"], r["course_name"]) == ("映像学科", "デジタル専門課程")


@pytest.mark.parametrize(("name", "seats", "expected"), [("音楽コース", "80人(116の内数) 75人 5人", True), ("音楽コース", "80人 75人 5人", False), ("音楽科", "80人(116の内数) 75人 5人", False)])
def test_breakdown(spark, name, seats, expected):
    (r,) = read(spark, f"{HEAD}{name}\n生徒総定員数 生徒実員\n{seats}")
    assert r["is_breakdown"] is expected


def test_no_card(spark):
    assert read(spark, "分野の説明\n学科名\n" + SEATS) == []
    assert read(spark, HEAD + "工業\n専門士\n" + SEATS) == []
    assert read(spark, HEAD + "看護学科\n生徒総定員 80人") == []
    assert read(spark, None, "", doc=None) == []
    empty = spark.createDataFrame([], "doc_id string, page int, text string")
    assert sections.unit_records(empty).count() == 0


def test_documents_stay_apart_and_repeat(spark):
    pages = [(d, p, t) for d in ("a", "b", None) for p, t in ((2, SEATS), (1, HEAD + f"{d}学科"))]
    got = sections.unit_records(spark.createDataFrame(pages, "doc_id string, page int, text string").withColumnRenamed("page", "page")).collect()
    assert sorted((r["name"], r["section"], r["enrollment"]) for r in got) == [("None学科", 1, 75), ("a学科", 1, 75), ("b学科", 1, 75)]


def test_very_long_document(spark):
    card = HEAD + "看護学科\n" + SEATS
    got = read(spark, *[card * 50 + "本文 " * 2000] * 40)
    assert len(got) == 2000 and [r["section"] for r in got] != [] and {r["enrollment"] for r in got} == {75}


def test_card_of_many_regions(spark):
    seats = "定員数は別に定める\n" * 300
    (r,) = read(spark, HEAD + "看護学科\n3年 昼\n" + seats, seats + SEATS, "卒業者数 進学者数 就職者数\n4人 5人 6人\n" + SEATS.replace("80", "99"))
    assert (r["section"], r["name"], r["capacity"], r["shift"], r["graduates"]) == (1, "看護学科", 80, "昼", 4)


def test_white_space_and_markup():
    text = "# 分野\u2003**学科名**\r\n![a](b)| Ａ |\tＢ | \n|---|:--|\n  c  d \n\nV0\nx V0\n"
    assert sections.cleaned_lines(text) == ["分野 学科名", "A B", "c d", "0人", "x V0"]
    assert sections.cleaned_lines("財務 1人") == [] and sections.cleaned_lines("財務 生徒実員") == ["財務 生徒実員"]


def test_lines_are_no_rows_and_pages_are_read_once(spark):
    pages = spark.createDataFrame([("a", 1, HEAD)], "doc_id string, page int, text string")
    plan = sections.unit_records(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan and "Generate" not in plan and plan.count("Exchange") == 2
