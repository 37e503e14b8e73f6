"""Coercion, comparison and scoring of numbers.

Casts never raise: text that is no number becomes null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritab.functions import urls
from veritab.functions.text import folded, host_tokens, name_tokens, squeezed

# Fixed values.
BLANKS = ("", "-", "‐", "―")
WEIGHTS = (0.4, 0.4, 0.2)
CUTOFFS = (0.85, 0.70, 0.50)
NEUTRAL = 0.7
URL_CUTOFFS = (6.0, 4.0)
POSITIVE_WORDS = ("修学支援", "高等教育", "無償化", "確認申請", "機関要件", "様式第2号", "様式2", "学校教育法", "情報公開")
NEGATIVE_WORDS = (
    "シラバス", "syllabus", "募集要項", "パンフレット", "入学案内", "カリキュラム", "時間割", "規程", "規則", "規定", "就業規則", "学則", "事業計画", "事業報告", "財務諸表",
    "決算", "自己点検", "自己評価", "学校案内", "ガイドブック", "attachment", "appendix", "添付資料", "別紙", "bessi", "besshi",
)
LOW_VALUE_PATHS = (
    ("form_download", -3.0), ("admission", -3.0), ("/admis", -3.0), ("/enter", -2.0), ("application", -3.0),
    ("/archives/news", -2.0), ("/news", -2.0), ("/event", -2.0), ("opencampus", -2.0),
)
DISCLOSURE_TEXTS = ("情報公開", "公開情報", "教育情報", "公表", "修学支援", "高等教育", "無償化", "確認申請", "機関要件")


def safe_int(c: Column) -> Column:
    """NUM-01: the whole part of a number in a text; null for blanks, dashes and anything else."""
    value = F.trim(c.cast("string")).try_cast("double")
    finite = ~F.isnan(value) & (F.abs(value) < 9e18)
    return F.when(finite, F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))).cast("long")


def comparable(c: Column, exact: bool = False) -> Column:
    """NUM-02: the text that two cells are compared by: null for blanks and dashes; a number without its fraction
    (kept with exact); else the squeezed text.  Numbers that are not finite are text."""
    text = F.replace(F.trim(c.cast("string")), F.lit(","), F.lit(""))
    number = text.try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < 9e18)
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("long").cast("string")
    shown = F.when(finite, number.cast("string") if exact else whole).otherwise(squeezed(c.cast("string")))
    return F.when(c.isNull() | text.isin(*BLANKS), None).otherwise(shown)


def values_equal(a: Column, b: Column) -> Column:
    """NUM-03: equal as comparable values; two nulls are equal."""
    return comparable(a).eqNullSafe(comparable(b))


def within(a: Column, b: Column, tolerance: float) -> Column:
    """NUM-04, NUM-05: equal within an absolute tolerance; two nulls are equal, one null is not."""
    return F.coalesce(F.abs(a - b) <= tolerance, a.isNull() & b.isNull())


def difference_category(new: Column, old: Column, tolerance: float = 0.0) -> Column:
    """NUM-06: how two cells differ: equal, missing, extra, numeric or text."""
    a, b = F.nullif(F.trim(new), F.lit("")), F.nullif(F.trim(old), F.lit(""))
    x, y = a.try_cast("double"), b.try_cast("double")
    same = a.eqNullSafe(b) | F.coalesce(F.abs(x - y) <= tolerance, F.lit(False))
    return F.when(same, "equal").when(a.isNull(), "missing").when(b.isNull(), "extra").when(x.isNotNull() & y.isNotNull(), "numeric").otherwise("text")


def populated(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def count_populated(required: Sequence[Column]) -> Column:
    total = F.lit(0)
    for c in required:
        total = total + populated(c).cast("int")
    return total


def extraction_factor(required: Sequence[Column]) -> Column:
    """NUM-07: 1 if all required fields are there, 0 if none, else a half."""
    n = count_populated(required)
    return F.when(n == 0, 0.0).when(n >= len(required), 1.0).otherwise(0.5)


def completeness(required: Sequence[Column]) -> Column:
    """NUM-08: the share of required fields that are there; 0 is there."""
    return count_populated(required) / F.lit(float(len(required))) if required else F.lit(0.0)


def sanity(current: Column, previous: Column, neutral: float = NEUTRAL) -> Column:
    """NUM-09: bands of the ratio to the prior value; neutral without a positive prior."""
    ratio = F.try_divide(current.cast("double"), previous.cast("double"))
    return (
        F.when(previous.isNull(), neutral)
        .when(current.isNull(), 0.0)
        .when(previous <= 0, neutral)
        .when(current < 0, 0.0)
        .when(ratio.between(0.5, 2.0), 1.0)
        .when(ratio.between(0.3, 3.0), 0.5)
        .otherwise(0.0)
    )


def composite(f1: Column, f2: Column, f3: Column, weights: Sequence[float] = WEIGHTS) -> Column:
    """NUM-10: the weighted sum, kept in 0 to 1."""
    if abs(sum(weights) - 1) > 1e-6:
        raise ValueError("weights must sum to 1")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), f1 * weights[0] + f2 * weights[1] + f3 * weights[2]))


def verdict(score: Column, cutoffs: Sequence[float] = CUTOFFS) -> Column:
    """NUM-11: auto, auto_flag, review_pending or rejected; cut-offs belong to the better side."""
    if not 0 <= cutoffs[2] <= cutoffs[1] <= cutoffs[0] <= 1:
        raise ValueError("cut-offs must fall from auto to reject and lie in 0 to 1")
    return F.when(score >= cutoffs[0], "auto").when(score >= cutoffs[1], "auto_flag").when(score >= cutoffs[2], "review_pending").otherwise("rejected")


def breakdown(f1: Column, required: Sequence[Column], current: Column, prior: Column, method: str) -> Column:
    """NUM-12, NUM-13: the three factors and what they come to."""
    f2, f3 = completeness(required), sanity(current, prior)
    return F.struct(f1.alias("f1_extraction"), f2.alias("f2_completeness"), f3.alias("f3_yoy_sanity"), F.lit(method).alias("method"), composite(f1, f2, f3).alias("composite"))


def ocr_factor(confidences: Column) -> Column:
    """AGG-41: the mean of an array's word confidences that are not negative, over 100; 0 if there are none."""
    usable = F.filter(confidences, lambda c: c >= 0)
    total = F.aggregate(usable, F.lit(0.0), lambda a, c: a + c.cast("double"))
    return F.when(F.coalesce(F.size(usable), F.lit(0)) <= 0, 0.0).otherwise(F.least(F.lit(1.0), F.try_divide(total, F.size(usable)) / 100))


def _any(text: Column, words: Sequence[str]) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return hit


def url_score(url: Column, name: Column, region: Column, title: Column, excerpt: Column, romanised: dict[str, str] | None = None, directories: Sequence[str] = urls.DIRECTORY_HOSTS) -> Column:
    """NUM-14: a struct of breakdown, score and decision for a candidate site of an entity; name, title and excerpt are
    folded already (text.folded, in a projection before).

    Invalid, document, directory and social addresses are rejected at once.  Local-government hosts never pass on their
    own for an entity that is not publicly run.
    """
    low = F.lower(url)
    host, path, query = urls.host(url), F.lower(F.regexp_extract(url, r"^[^:]+://[^/?#]+([^?#]*)", 1)), F.regexp_extract(low, r"\?([^#]*)", 1)
    valid = low.rlike("^https?://") & (host != "")
    tld = F.when(host.rlike(r"\.(ac|ed|lg)\.jp$"), 3.0).when(host.rlike(r"(\.or)?\.jp$"), 1.0).when(host.rlike(r"\.(com|net|org|info|biz)$"), -1.0).otherwise(0.0)
    named = F.exists(host_tokens(name, romanised or {}), lambda t: host.contains(t))
    plain, heading = F.trim(name), F.trim(title)
    in_title = F.when((plain != "") & heading.contains(plain), 2.0).when(F.exists(name_tokens(name), lambda t: heading.contains(t)), 1.0).otherwise(0.0)
    about = F.coalesce(excerpt, F.lit(""))
    penalty = F.least(F.lit(0.0), *[F.when(path.contains(mark), value).otherwise(0.0) for mark, value in LOW_VALUE_PATHS])
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    stable = (tld >= 3) & (in_title >= 1) & (penalty == 0) & (F.size(segments) <= 1) & ~F.exists(segments, lambda s: s.contains("."))
    placed = F.coalesce((region != "") & F.concat(host, path).contains(F.lower(region)), F.lit(False))
    parts = {
        "domain_tld": tld, "domain_name_match": F.when(named, 2.0).otherwise(0.0), "region_in_url": F.when(placed, 1.0).otherwise(0.0), "page_title_match": in_title,
        "disclosure_keyword": F.when(_any(about, DISCLOSURE_TEXTS), 1.0).otherwise(0.0), "official_word": F.when(_any(F.lower(about), ("公式", "official")), 0.5).otherwise(0.0),
        "low_value_path": penalty, "stable_homepage_path": F.when(stable, 1.0).otherwise(0.0),
    }
    hard = F.when(~valid, F.create_map(F.lit("invalid_url"), F.lit(0.0)))
    hard = hard.when(path.endswith(".pdf") | query.contains(".pdf"), F.create_map(F.lit("document_url"), F.lit(-5.0)))
    if directories:
        hard = hard.when(urls.host_matches(host, tuple(directories)), F.create_map(F.lit("third_party_directory"), F.lit(-5.0)))
    hard = hard.when(urls.host_matches(host), F.create_map(F.lit("sns_or_jobboard"), F.lit(-5.0)))
    soft = F.map_filter(F.create_map(*[x for k, v in parts.items() for x in (F.lit(k), v)]), lambda _, v: v != 0)
    found = F.coalesce(hard.otherwise(F.lit(None)), soft)
    score = F.aggregate(F.map_values(found), F.lit(0.0), lambda a, v: a + v)
    public = plain.rlike("[国公都道府県市町村]立|県農業大学校")
    decision = F.when(hard.otherwise(F.lit(None)).isNotNull() | (score < URL_CUTOFFS[1]), "reject").when((score < URL_CUTOFFS[0]) | (host.endswith(".lg.jp") & ~public), "review").otherwise("auto")
    return F.struct(found.alias("breakdown"), score.alias("score"), decision.alias("decision"))


def candidate_score(text: Column, pattern: Column, hinted: Column, target: int) -> Column:
    """NUM-15: 2 for each good word, -3 for each bad one, and bonuses for period and delivery pattern."""
    low = F.lower(text)
    words = sum((F.when(low.contains(w.lower()), v).otherwise(0.0) for group, v in ((POSITIVE_WORDS, 2.0), (NEGATIVE_WORDS, -3.0)) for w in group), F.lit(0.0))
    year = F.when(hinted == target, 3.0).when(hinted == target - 1, 1.0).otherwise(0.0)
    return words + year + F.when((pattern == "direct") | pattern.endswith("_direct"), 0.5).when(pattern == "embed", 0.3).otherwise(0.0)


def search_result_score(url: Column, title: Column, description: Column, name: Column, owner: Column) -> Column:
    """NUM-16: how well a search result fits an entity, at most 0.99."""
    base = F.when(title.contains(name), 0.9).when(description.contains(name), 0.8).when(title.contains(owner), 0.7).when(description.contains(owner), 0.65).otherwise(0.5)
    worded = _any(F.concat_ws(" ", title, description), ("情報公開", "公開情報", "学校情報", "機関要件"))
    base = F.when(worded, F.least(base + 0.1, F.lit(0.99))).otherwise(base)
    return F.when(url.contains(".ac.jp"), F.least(base + 0.05, F.lit(0.99))).when(url.contains(".ed.jp") | url.contains(".go.jp"), F.least(base + 0.03, F.lit(0.99))).otherwise(base)


def score_to_confidence(score: Column) -> Column:
    """NUM-17: a score of 0 to 10 as 0 to 1 with two decimals."""
    return F.round(F.greatest(F.lit(0.0), F.least(score, F.lit(10.0))) / 10, 2)


def evaluated_equal(gold: Column, parsed: Column, tolerance: float = 0.01) -> Column:
    """NUM-18: for evaluation: both null, or no further apart than the tolerance."""
    return within(gold.cast("double"), parsed.cast("double"), tolerance)


def first_int(c: Column) -> Column:
    """NUM-19: the first whole number in a text, thousands separators allowed."""
    return F.replace(F.regexp_extract(folded(c), r"(\d[\d,]*)", 1), F.lit(","), F.lit("")).try_cast("long")


def all_ints(c: Column) -> Column:
    """NUM-20: all whole numbers of a line."""
    return F.transform(F.regexp_extract_all(folded(c), F.lit(r"(\d[\d,]*)"), 1), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("long"))


def yield_gate(percent: Column, passing: float = 60.0) -> Column:
    """NUM-21: the gate's status by yield."""
    return F.when(percent.isNull(), "not_measured").when(percent >= passing, "pass").otherwise("below_gate")
