"""Table-driven boundary cases of the functions."""

import pytest
from pyspark.sql import functions as F

from veritab.functions import numbers, payloads, periods, states, text, urls


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("function", "value", "expected"),
    [
        (text.squeezed, "Ａ Ｂ　Ｃ", "ABC"), (text.squeezed, None, ""), (text.trimmed, " ａ b ", "a b"), (text.without_owner, "学校法人 東京&IT学院", "東京学院"),
        (text.plain_spaces, "a　b\tc", "ab\tc"), (text.collapsed, "辻\U000e0100 a", "辻a"), (text.name_variant, "A&Bアンドー・C", "abc"), (text.institution_key, "東京デザイン専門学校", "東京デザイン"),
        (text.institution_key, "大学", "大学"), (text.kana_folded, "クリエーター", "クリエタ"), (text.unit_key, "ビジネスコース", "ビジネス"), (text.unit_key_strict, "ビジネスコース", "ビジネスコース"),
        (text.unit_key, "情報(ビジネスコース)", "情報(ビジネス)"), (text.unit_key, "学科", "学科"), (text.unit_key, "情報学科", "情報"), (text.category_key, "文化・教養", "文化教養"), (text.category_key, "看護", "医療"),
        (text.course_name, "看護専門課程", "医療"), (text.course_name, "", None), (text.metric_of_label, "学 生 実 員", "enrollment"), (text.metric_of_label, "入学定員", "admission_capacity"), (text.metric_of_label, "教員数", None),
        (text.region_name, "01(青森)", "青森県"), (text.region_name, "13(東京)", "東京都"), (text.scrubbed, "a@b.co 03-1234-5678", "[email] [phone]"), (text.remark_tags, "校名変更、統合", ["name_change", "merger_reorg"]),
        (text.bracketed_tracks, "情報（Web・AI）", ["Web", "AI"]), (text.name_tokens, "東京デザイン専門学校", ["東京", "デザイン"]),
        (urls.canonical, "HTTPS://Ex.com:443//a//b/?b=2&utm_source=x&a=1#f", "https://ex.com/a/b?a=1&b=2"), (urls.canonical, " plain ", "plain"), (urls.dedupe_key, "http://e.com/%E6%9D%B1+x.pdf", "http://e.com/東+x.pdf"),
        (urls.host, "http://u@EX.com:80/x", "ex.com"), (urls.quality, "http://a/b.PDF", "direct_pdf"), (urls.quality, None, "none"), (urls.first_url, "see https://a.b/c, ok", "https://a.b/c,"),
        (urls.document_in_query, "http://v.com/?f=%2Fdoc%2Fa.pdf", "/doc/a.pdf"),
        (periods.period_of_era_text, "令和8年度", 2026), (periods.period_of_era_text, "令和元年度", 2019), (periods.period_of_era_text, "平成三十一年6月1日", 2019), (periods.period_of_era_text, "2026", None),
        (periods.has_period_text, "r8_form", True), (periods.has_period_text, "form", False), (periods.kanji_number, "二十一", 21),
        (numbers.safe_int, "8.9", 8), (numbers.safe_int, "-", None), (numbers.safe_int, "inf", None), (numbers.comparable, "1,234", "1234"), (numbers.comparable, "8.9", "8"), (numbers.comparable, "1e3", "1000"),
        (numbers.comparable, "inf", "inf"), (numbers.comparable, "―", None), (numbers.first_int, "計 １，２３４人", 1234), (numbers.all_ints, "3 と 45", [3, 45]),
        (states.text_class, "様式第2号 機関要件", "target"), (states.text_class, "別紙様式4 機関要件 修学支援", "non_target"), (states.text_class, " 　", "image_only"), (states.text_class, "(cid:12)", "image_only"),
        (states.trust_tier, "seed_csv", "t3_operator_approved"), (states.trust_tier, None, "t5_untrusted"), (states.truth_label, "match", "TRUE"), (states.truth_label, "excluded_not_comparable", ""),
    ],
)
def test_text_functions(spark, function, value, expected):
    assert one(spark, function(F.col("v")), v=value) == expected


@pytest.mark.parametrize(("score", "expected"), [(0.85, "auto"), (0.8499, "auto_flag"), (0.70, "auto_flag"), (0.50, "review_pending"), (0.4999, "rejected")])
def test_verdict(spark, score, expected):
    assert one(spark, numbers.verdict(F.col("v")), v=score) == expected


@pytest.mark.parametrize(("now", "before", "expected"), [(10.0, None, 0.7), (None, 10.0, 0.0), (10.0, 0.0, 0.7), (-1.0, 5.0, 0.0), (5.0, 10.0, 1.0), (20.0, 10.0, 1.0), (3.0, 10.0, 0.5), (30.0, 10.0, 0.5), (2.9, 10.0, 0.0)])
def test_sanity(spark, now, before, expected):
    column = numbers.sanity(F.lit(now).cast("double"), F.lit(before).cast("double"))
    assert one(spark, column, v=1.0) == expected


def test_granularity(spark):
    assert one(spark, text.granularity_collision(F.lit("ビジネスコース"), F.lit("ビジネス科")), v="x") is True


def test_search_tokens():
    assert "令和八" in periods.search_tokens(2026) and "R08" in periods.search_tokens(2026) and "令和元" in periods.search_tokens(2019)


def test_breakdown_json(spark):
    b = numbers.breakdown(F.lit(1.0), [F.lit(1), F.lit(None).cast("int")], F.lit(5), F.lit(None).cast("int"), "pdf_parse")
    shown = one(spark, payloads.breakdown_json(b), v="x")
    assert shown == '{"f1_extraction":1.0,"f2_completeness":0.5,"f3_yoy_sanity":0.7,"method":"pdf_parse","weights":[0.4,0.4,0.2],"composite":0.74}'


def test_composite_absent(spark):
    back = payloads.breakdown_of_json(F.lit('{"f1_extraction":1.0,"f2_completeness":0.5,"f3_yoy_sanity":0.5}'))
    assert one(spark, back["composite"], v="x") == pytest.approx(0.7)


def test_ocr_factor(spark):
    assert one(spark, numbers.ocr_factor(F.array(F.lit(-1.0), F.lit(80.0), F.lit(100.0))), v="x") == pytest.approx(0.9)
    assert one(spark, numbers.ocr_factor(F.array().cast("array<double>")), v="x") == 0.0


@pytest.mark.parametrize(
    ("url", "decision"),
    [("https://www.abk.ac.jp/", "auto"), ("https://abk.example.com/news/1", "reject"), ("https://www.facebook.com/abk", "reject"), ("https://abk.ac.jp/x.pdf", "reject"), ("https://abk.city.lg.jp/", "review"), ("nothing", "reject")],
)
def test_url_score(spark, url, decision):
    df = spark.createDataFrame([(url, "ABK専門学校", "ABK専門学校 公式", "情報公開 公式")], "url string, name string, title string, excerpt string")
    s = numbers.url_score(F.col("url"), F.col("name"), F.lit(""), F.col("title"), F.col("excerpt"))
    assert df.select(s["decision"].alias("d")).first()["d"] == decision
