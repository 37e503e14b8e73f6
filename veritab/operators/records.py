"""Record shapes: wide to long, grids to records, template layouts, candidate links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions import numbers, periods, states, urls
from veritab.functions.text import header_name, metric_of_label, squeezed, unit_key
from veritab.functions.words import first_word

# Fixed values.
STATUS_WORDS = {
    "〇": "collected", "〇（一部欠損）": "collected", "〇（一部昨年？）": "collected", "△": "collected", "△（不足）": "collected", "△（前年データ）": "stale",
    "△（前年）": "stale", "△（同一データ）": "stale", "対象外": "excluded", "学校なし": "excluded", "統合": "excluded", "統廃合": "excluded", "閉校": "excluded",
    "募集停止": "excluded", "リンクミス": "error", "職実": "collected", "職実代用": "collected", "一部職実": "collected", "一部職実代用": "collected",
    "一部学科職実": "collected", "不足": "collected", "欠損データ": "error", "データなし": "error", "前年データ": "stale", "日付は変更されるが内容同じ": "stale",
    "情報公開": "collected", "事業報告": "collected",
}

#: Strings in a link that tell of a document that is not wanted.
UNWANTED = (
    "実務経験", "授業科目", "jitsumukeiken", "course-subject", "course_subject", "subject_", "subject-", "info_", "grade_manage", "goal_policies", "curriculum", "財務", "zaimu",
    "収支計算書", "incomeandexpenditurestatement", "正味財産増減計算書", "calculationofchangesinassets", "貸借対照表", "balancesheet", "財産目録", "inventoryofassets", "監査報告書",
    "auditreport", "理事名簿", "rijimeibo", "役員名簿", "yakuinmeibo", "役員一覧", "executive-list", "executive_list", "board-member", "board_member", "学校情報", "学校紹介", "学校案内",
    "school-info", "schoolinfo", "gakkouinfo", "school-guide", "schoolguide", "学則", "regulation.pdf", "寄付行為", "寄附行為", "kifu", "donation.pdf", "報酬", "remuneration.pdf",
    "学校評価", "gakkouuneihyouka", "学校関係者評価", "kankeishahyouka", "職業実践", "shokugyouzissen", "shokugyojissen", "外部評価", "gaibuhyouka", "内部評価", "naibuhyouka",
    "自己点検", "自己評価", "jikohyoka", "evaluation", "hyoukahokoku", "daigakuhyouka", "客観的指標", "客観的な指標", "kyakkantekishihyo", "kyakangpa", "シラバス", "syllabus",
    "教育課程表", "教育課程", "教育課程編成", "議事録", "成績分布", "seiseki", "kamoku", "classsubject", "indexing_rule", "学年暦", "学年歴", "年間計画表", "年間計画", "nenkan",
    "学修評価", "learningassessment", "教育理念", "educationalphilosophy", "必要経費", "gakuinannai", "卒業認定", "卒業の認定", "進級", "卒業の要件", "sotugyo", "sotsugyo",
    "graduation", "diploma-policy", "成績評価", "grading", "給付金", "kyufukin", "実習施設", "インターンシップ", "internshipreport", "学校の現況", "gakkou_genjyou", "gakkou_genjo",
    "諸心得", "knowledge", "細則", "通期", "前期", "後期", "お知らせ", "ニュース", "/news/", "イベント", "オープンキャンパス", "open-campus", "opencampus", "進路相談会", "防災訓練",
    "防犯講話", "ハラスメント", "harassment", "planreport", "securitypolicy", "事業報告", "teikitenkenhokoku", "sihyosanshutu", "証明書", "推薦書", "個人票", "アルバイト", "外泊",
    "student_support_guidelines", "入学試験", "入試", "ao入試",
)


def melted(wide: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """FLT-07: always one row for each metric; nulls stay."""
    return wide.unpivot(list(ids), list(metrics), "metric", "value")


def with_evidence(wide: DataFrame, ids: Sequence[str], metrics: Sequence[str], evidence: str) -> DataFrame:
    """FLT-06: one row for each metric that has a value and an entry in the evidence map."""
    long = melted(wide, [*ids, evidence], metrics)
    return long.withColumn("evidence", F.try_element_at(evidence, F.col("metric"))).filter("value IS NOT NULL AND evidence IS NOT NULL").drop(evidence)


def external_rows(rows: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """FLT-08: a row that names its metric is one row; any other gives one for each metric that is not null."""
    named = rows.filter("metric IS NOT NULL").select(*ids, "metric", F.col("value").cast("string").alias("value"))
    wide = rows.filter("metric IS NULL").select(*ids, *[F.col(m).cast("string").alias(m) for m in metrics])
    return named.unionByName(wide.unpivot(list(ids), list(metrics), "metric", "value").filter("value IS NOT NULL"))


def renamed(rows: DataFrame) -> DataFrame:
    """STR-19: columns by their canonical names; unknown headers stay."""
    return rows.select(*[F.col(f"`{c}`").alias(header_name(c) or c) for c in rows.columns])


def status_of_text(c: Column) -> Column:
    """SRC-02: a sheet's free-text status; blank and unknown are pending."""
    table = F.create_map(*[F.lit(x) for pair in STATUS_WORDS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.trim(c)), F.lit("pending"))


def period_blocks(sheet: DataFrame, ids: Sequence[str], starts: dict[int, int], measures: Sequence[str]) -> DataFrame:
    """SRC-03: a sheet with one block of columns for each period as long rows; a block without any measure is skipped.

    starts: where each period's block begins among columns named c0, c1, ...; strides need not be even.
    """
    blocks = [F.struct(F.lit(p).alias("period"), *[numbers.safe_int(F.col(f"c{at + i}")).alias(m) for i, m in enumerate(measures)]) for p, at in starts.items() if f"c{at}" in sheet.columns]
    long = sheet.select(*ids, F.explode(F.array(*blocks)).alias("b")).select(*ids, "b.*")
    return long.filter(F.coalesce(*[F.col(m) for m in measures]).isNotNull())


def master_rows(facts: DataFrame, ids: Sequence[str], metrics: Sequence[str], required: str) -> tuple[DataFrame, DataFrame]:
    """SRC-07: long rows of a master sheet, and the rows that were skipped as they lack the required measure."""
    return melted(facts.filter(F.col(required).isNotNull()), ids, metrics), facts.filter(F.col(required).isNull()).select(*ids, F.lit(f"blank {required}").alias("reason"))


def cell_address(row: Column, column: int) -> Column:
    """SRC-08: a spreadsheet cell's address; column counts from 0."""
    letters, n = "", column
    while n >= 0:
        letters, n = chr(65 + n % 26) + letters, n // 26 - 1
    return F.concat(F.lit(letters), row.cast("string"))


def grid_records(grids: DataFrame) -> DataFrame:
    """SRC-14, ARR-01: (doc_id, page, table_index, grid) to records: the unit in the first column, metrics by what the
    header says, each with its cell.

    Header and data cells meet in a self join by table and column.
    """
    rows = grids.select("doc_id", "page", "table_index", F.posexplode("grid").alias("row", "cells"))
    cells = rows.select("doc_id", "page", "table_index", "row", F.posexplode("cells").alias("col", "raw"))
    head = cells.filter("row = 0").select("doc_id", "page", "table_index", "col", F.col("raw").alias("label"), metric_of_label(F.col("raw")).alias("metric")).filter("metric IS NOT NULL")
    units = rows.filter("row > 0").select("doc_id", "page", "table_index", "row", squeezed(F.get("cells", F.lit(0))).alias("unit")).filter("unit <> ''")
    at = ["doc_id", "page", "table_index"]
    out = cells.filter("row > 0").join(head, [*at, "col"]).join(units, [*at, "row"])
    return out.select(*at, "row", "col", "unit", "metric", "label", "raw", numbers.first_int(F.col("raw")).alias("value")).filter("value IS NOT NULL")


def unit_tables(tables: DataFrame, word: str = "学科") -> DataFrame:
    """ARR-04: page tables whose header row names units."""
    return tables.filter(F.exists(F.get("grid", F.lit(0)), lambda c: F.coalesce(c.contains(word), F.lit(False))))


def template_blocks(cells: DataFrame, gap: int = 2) -> DataFrame:
    """SRC-30, WIN-18: year columns of a template's header in blocks: a gap of more than so many columns starts one."""
    from veritab.operators.revision import blocks

    years = cells.filter(F.col("value").rlike(r"20\d{2}")).withColumn("period", F.regexp_extract("value", r"(20\d{2})", 1).cast("int"))
    return blocks(years, ["sheet", "row"], "col", gap)


# The headings of the support section's page.
SUPPORT_PAGES = (("別紙", "授業料等減免対象者"), ("前年度の授業料等減免対象者", "支援対象者数"))


def persons(part: Column) -> Column:
    """The numbers of persons that a part of a page tells, those in brackets left out."""
    found = F.regexp_extract_all(F.regexp_replace(part, r"\([^)]*\)", ""), F.lit(r"(\d[\d,]*)\s*人"), 1)
    return F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("long"))


def support_records(pages: DataFrame) -> DataFrame:
    """ARR-03: one row for each document of (doc_id, page, text) whose support section tells a total.

    The section is the first page with the appendix's mark, or else with its headings, and the page after it.  A class
    of support whose line has no number goes on in the next line.
    """
    folded = pages.select("doc_id", "page", numbers.folded(F.col("text")).alias("text"))
    marks = [F.col("text").contains(a) & F.col("text").contains(b) for a, b in SUPPORT_PAGES]
    start = folded.groupBy("doc_id").agg(F.coalesce(*[F.min(F.when(m, F.col("page"))) for m in marks]).alias("start"))
    near = folded.join(start, "doc_id").filter(F.col("page").between(F.col("start"), F.col("start") + 1))
    whole = near.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), "\n").alias("t"))
    t = F.col("t")

    def after(label: str) -> Column:
        return persons(F.regexp_extract(t, rf"{label}([^\n]*人[^\n]*|[^\n]*\n[^\n]*)", 1))

    totals = persons(F.regexp_extract(t, r"(?:支援対象者数|括弧内は多子世帯)([^\n]*\d\s*人[^\n]*)", 1))
    out = {"first_half_total": F.get(totals, F.lit(0)), "second_half_total": F.get(totals, F.lit(1)), "annual_total": F.get(totals, F.lit(2))}
    for n, label in enumerate(("第I区分", "第II区分", "第III区分", "第IV区分[^\\n]*理工農"), 1):
        out |= {f"first_half_cat{n}": F.get(after(label), F.lit(0)), f"second_half_cat{n}": F.get(after(label), F.lit(1))}
    out |= {"household_change": F.get(after(r"家計急変(?![^\n]*除く)"), F.lit(0)), "grand_total": F.get(persons(F.regexp_extract(t, r"合計[^\n]*年間([^\n]*)", 1)), F.lit(0))}
    rows = whole.select("doc_id", *[v.alias(k) for k, v in out.items()])
    return rows.filter("coalesce(first_half_total, second_half_total, grand_total) IS NOT NULL")


def unit_alias_classes(units: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """CLS-16: how sure an alias of a unit is, by (key, unit) and (key, candidate): one candidate whose key without the
    suffix is the unit's own is taken, another single one is reviewed, several are ambiguous, none is none."""
    j = units.join(candidates, key, "left").groupBy(key).agg(F.count("candidate").alias("n"), F.bool_or(unit_key(F.col("unit")) == unit_key(F.col("candidate"))).alias("same"))
    return j.select(key, states.alias_class(F.col("n"), F.coalesce("same", F.lit(False))).alias("class"))


def plausible_name(c: Column) -> Column:
    """FLT-17: whether a cell may be an institution's name."""
    t = squeezed(c)
    return F.length(t).between(3, 60) & ~t.rlike(r"(?U)^[\d\W_]+$") & ~t.rlike("確認大学等|学校名|所在地|設置者")


def intake_errors(name: Column, period: Column, page_url: Column, file_name: Column, latest: int) -> Column:
    """FLT-15: all that is wrong with an upload's details."""
    return states.errors(
        (F.trim(F.coalesce(name, F.lit(""))) == "", "name is empty"),
        (period.isNull() | ~period.between(2000, latest + 1), "period is out of range"),
        (page_url.isNotNull() & ~page_url.rlike("^https?://"), "page address is no URL"),
        (~F.lower(F.coalesce(file_name, F.lit(""))).rlike(r"\.(pdf|zip|csv)$"), "file type is not accepted"),
    )


def range_errors(fields: dict[str, tuple[Column, float, float]]) -> Column:
    """FLT-16: fields outside their range."""
    return states.errors(*[((~value.between(low, high)), f"{name} is out of range") for name, (value, low, high) in fields.items()])


def rejected(text: Column, hinted: Column, target: int, bad: Sequence[str] = UNWANTED) -> Column:
    """FLT-05: why a candidate is not worth a download; null if it is.  Of words in it the first of the list is told."""
    place = first_word(F.lower(text), [w.lower() for w in bad])
    word = F.get(F.array(*map(F.lit, bad)), place)
    return F.when(word.isNotNull(), F.concat(F.lit("negative_word:"), word)).when(hinted < target - 1, "stale_period").when(hinted > target + 1, "future_period")


def page_links(pages: DataFrame) -> DataFrame:
    """SRC-25, NUM-15, DAT-10: (page_id, position, href, text, pattern) of anchors, frames and embeds of raw HTML, comments
    removed first; relative addresses are completed by the page's origin."""
    html = F.regexp_replace(F.coalesce("html", F.lit("")), "(?s)<!--.*?-->", "")
    anchor, embed = r"(?is)<a\b[^>]*?href\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a\s*>", r"(?is)<(?:embed|iframe|object)\b[^>]*?(?:src|data)\s*=\s*[\"']([^\"']*)[\"']"
    base = pages.select("page_id", "url", html.alias("html"))
    found = F.arrays_zip(F.regexp_extract_all("html", F.lit(anchor), 1).alias("href"), F.regexp_extract_all("html", F.lit(anchor), 2).alias("text"))
    a = base.select("page_id", "url", F.posexplode(found).alias("position", "x")).select("page_id", "url", "position", "x.href", "x.text", F.lit("anchor").alias("source"))
    e = base.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(embed), 1)).alias("position", "href")).select("page_id", "url", "position", "href", F.lit("").alias("text"), F.lit("embed").alias("source"))
    plain = F.trim(F.regexp_replace(F.regexp_replace("text", "<[^>]+>", " "), r"\s+", " "))
    full = F.when(F.col("href").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.col("href")).when(F.col("href").startswith("//"), F.concat(F.regexp_extract("url", "^([^:]+:)", 1), "href"))
    full = full.when(F.col("href").startswith("/"), F.concat(urls.origin(F.col("url")), "href")).otherwise(F.concat(F.regexp_replace("url", "[^/]*$", ""), "href"))
    return a.unionByName(e).select("page_id", "position", "source", full.alias("href"), plain.alias("text"), urls.delivery_pattern(full, F.col("href"), F.when(F.col("source") == "embed", F.lit("embed"))).alias("pattern"))


def match_rank(detected: Column, in_link: Column, is_entity: Column) -> Column:
    """WIN-11: how a candidate fits the wanted entity: 0 if the document's own name is the entity's, 1 if only the link
    says so, 2 if nothing is known, 3 if the document names another."""
    known = F.length(F.coalesce(detected, F.lit(""))) >= 4
    return F.when(known & is_entity, 0).when(known, 3).when(in_link, 1).otherwise(2)


def ranked(candidates: DataFrame, target: int, most_general: int = 80) -> DataFrame:
    """WIN-11: candidates of a page in the order of download: tier, fit to the entity, period, -score, place; generic
    ones beyond most_general are marked as dropped.

    candidates: page_id, position, href, text, pattern, and match, the fit by match_rank (2 where there is no such
    column).
    """
    both = F.concat_ws(" ", "text", "href")
    hint = periods.period_hint(both, target)
    form, system = both.rlike("確認申請|申請書|様式"), both.rlike("修学支援|高等教育|無償化|機関要件")
    tier = F.when(form & system, 0).when(form, 1).otherwise(2)
    year = F.when(F.col("hint") == target, 0).when(F.col("hint").isNull(), 1).otherwise(2)
    fit = F.col("match") if "match" in candidates.columns else F.lit(2)
    out = candidates.withColumns({"hint": hint, "tier": tier, "match": fit}).withColumns({"score": numbers.candidate_score(both, F.col("pattern"), F.col("hint"), target), "year_rank": year})
    order = [F.col("tier"), F.col("match"), F.when(F.col("tier") < 2, F.col("year_rank")).otherwise(0), F.col("score").desc(), F.col("position"), F.col("href")]
    w, within = Window.partitionBy("page_id").orderBy(*order), Window.partitionBy("page_id", "tier").orderBy(*order[1:])
    return out.withColumns({"rank": F.row_number().over(w), "dropped": (F.col("tier") == 2) & (F.row_number().over(within) > most_general)})


def subpages(candidates: DataFrame, host: str = "host", most: int = 12) -> DataFrame:
    """WIN-23: links on the same host worth following: named ones first, then page order, the first of each address."""
    keep = candidates.filter(F.col("text").rlike("情報公開|公開|学校案内|about|info|news") | F.col("href").rlike("(?i)disclosure|joho|info|about|news"))
    first = keep.groupBy("page_id", "href").agg(F.min("position").alias("position"), F.max(F.col("text").contains("情報").cast("int")).alias("named"))
    w = Window.partitionBy("page_id").orderBy(F.col("named").desc(), "position", "href")
    return first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


