"""Queries of the text, URL, period and number functions.

The SQL folds wide letters with translate(): the names hold no other letter that compatibility folding changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions import numbers, periods, text, urls
from veritab.operators import records
from veritab.plans.registry import Load, query


def by_case(key: str, *values: object) -> Column:
    """The value whose place is the key modulo how many there are; SQL's CASE below says the same."""
    out = F.lit(None)
    for i, v in enumerate(values):
        out = F.when(F.col(key) % len(values) == i, F.lit(v)).otherwise(out)
    return out


def case_sql(key: str, *values: object) -> str:
    shown = ["NULL" if v is None else str(v) if isinstance(v, int | float) else "'" + v.replace("'", "''") + "'" for v in values]
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(shown)) + " END"


FOLD = "translate(name, 'ＡＢＣＩＴ＆　', 'ABCIT& ')"
SQUEEZED = f"regexp_replace({FOLD}, '\\s+', '', 'g')"


@query("name_spaces", f"SELECT id, trim({FOLD}) AS trimmed, replace({FOLD}, ' ', '') AS plain, replace({SQUEEZED}, chr(8203), '') AS cell FROM named", "named")
def name_spaces(t: Load) -> DataFrame:
    """STR-02, STR-05, STR-06."""
    n = F.col("name")
    return t("named").select("id", text.trimmed(n).alias("trimmed"), text.plain_spaces(n).alias("plain"), text.cell_text(n).alias("cell"))


COLLAPSED = f"replace({SQUEEZED}, chr(65024), '')"


@query("name_variants", f"SELECT id, {COLLAPSED} AS collapsed, regexp_replace(replace(lower({COLLAPSED}), 'アンド', ''), '[&ー・･]', '', 'g') AS variant, regexp_replace({SQUEEZED}, '[ーイィ]', '', 'g') AS kana, trim(translate({FOLD}, '髙澤', '高沢')) AS modern FROM named", "named")
def name_variants(t: Load) -> DataFrame:
    """STR-07, STR-08, STR-10, STR-26."""
    n = F.col("name")
    return t("named").select("id", text.collapsed(n).alias("collapsed"), text.name_variant(n).alias("variant"), text.kana_folded(n).alias("kana"), text.modern_glyphs(n).alias("modern"))


COURSES = ("医療専門課程", "看 護専門課程", "文化・教養専門課程", "ビジネス専門課程", " 　", "商業実務", None, "教育・社会福祉専門課程")
COURSE_NAMES = ("医療", "医療", "文化・教養", "ビジネス専門課程", None, "商業実務", None, "教育・社会福祉")
UNITS = ("工業情報処理科", "医療看護学科", "情報ビジネスコース", "学科", "農業科", "衛生美容科")
UNIT_KEYS = ("工業情報処理", "医療看護", "情報ビジネス", "学科", "農業", "衛生美容")
BARE_UNITS = ("情報処理科", "看護学科", "情報ビジネスコース", "学科", "農業科", "美容科")
CATEGORIES = ("看護", "文化・教養", "工業/農業", " 商業実務 ")
CATEGORY_KEYS = ("医療", "文化教養", "工業農業", "商業実務")


@query("course_names", f"SELECT p_partkey AS id, {case_sql('p_partkey', *COURSE_NAMES)} AS course, {case_sql('p_partkey', *CATEGORY_KEYS)} || '|' || {case_sql('p_partkey', *UNIT_KEYS)} AS composed, {case_sql('p_partkey', *BARE_UNITS)} AS bare FROM part")
def course_names(t: Load) -> DataFrame:
    """STR-14, STR-15, STR-21."""
    key, unit = "p_partkey", by_case("p_partkey", *UNITS)
    rows = t("part").select(F.col(key).alias("id"), by_case(key, *COURSES).alias("course"), by_case(key, *CATEGORIES).alias("category"), unit.alias("unit"))
    return rows.select("id", text.course_name(F.col("course")).alias("course"), text.composed_key(F.col("category"), F.col("unit")).alias("composed"), text.without_category_prefix(F.col("unit")).alias("bare"))


LABELS = ("生 徒 総 定 員 数", "入学定員（人）", "うち留学生数", "卒業者数", "中途退学者数", "学生実員（Ａ）", "在籍者数", "教員数", "総定員")
LABEL_METRICS = ("capacity", "admission_capacity", "intl_students", "graduates", "dropouts", "enrollment", "enrollment", None, "capacity")


@query("metric_labels", f"SELECT p_partkey AS id, {case_sql('p_partkey', *LABEL_METRICS)} AS metric FROM part")
def metric_labels(t: Load) -> DataFrame:
    """STR-18."""
    return t("part").select(F.col("p_partkey").alias("id"), text.metric_of_label(by_case("p_partkey", *LABELS)).alias("metric"))


@query("renamed_headers", "SELECT s_name AS entity_name, s_suppkey AS period, s_acctbal AS unit_name, s_nationkey AS remark FROM supplier")
def renamed_headers(t: Load) -> DataFrame:
    """STR-19."""
    s = t("supplier").select(F.col("s_name").alias("School Name"), F.col("s_suppkey").alias("ＦＩＳＣＡＬ_year"), F.col("s_acctbal").alias("department_Name"), F.col("s_nationkey").alias("remark"))
    return records.renamed(s)


OCR_SQL = r"""WITH m AS (SELECT doc_id, '# Head' || chr(10) || '|---|:--|' || chr(10) || '| **' || coalesce(text, '') || '** |' AS md FROM documents),
l AS (SELECT doc_id, list_filter(list_transform(string_split(md, chr(10)), lambda x: trim(regexp_replace(regexp_replace(x, '^#+\s*|\*\*|`', '', 'g'), '^\||\|$', '', 'g'))), lambda x: x <> '' AND NOT regexp_matches(x, '^[-|:\s]+$')) AS lines FROM m)
SELECT doc_id, len(lines) AS n, md5(array_to_string(lines, chr(10))) AS cleaned FROM l"""


@query("ocr_cleanup", OCR_SQL)
def ocr_cleanup(t: Load) -> DataFrame:
    """STR-22: whole documents as the body of recognised markdown."""
    md = F.concat(F.lit("# Head\n|---|:--|\n| **"), F.coalesce("text", F.lit("")), F.lit("** |"))
    return t("documents").select("doc_id", text.ocr_lines(md).alias("c")).select("doc_id", F.size(F.split("c", "\n")).cast("long").alias("n"), F.md5("c").alias("cleaned"))


REGIONS = ("01(北海道)", "13(東京)", "大阪", "26(京都府)", "青森", "神奈川県", "47(沖縄)")
REGION_NAMES = ("北海道", "東京都", "大阪府", "京都府", "青森県", "神奈川県", "沖縄県")


@query("region_names", f"SELECT s_suppkey AS id, {case_sql('s_suppkey', *REGION_NAMES)} AS region FROM supplier")
def region_names(t: Load) -> DataFrame:
    """STR-23."""
    return t("supplier").select(F.col("s_suppkey").alias("id"), text.region_name(by_case("s_suppkey", *REGIONS)).alias("region"))


TOKEN_NAMES = ("東京デザインABK専門学校", "大阪　こども福祉_学院", "日本ＩＴ・美容大学", "ＡＢＣ", "高知ひろめ情報校")
TOKENS = ("東京,デザイン,ABK", "大阪,こども,福祉", "日本,IT,美容", "ABC", "高知,ひろめ,情報")
HOSTS = ("abk,tokyo-design,design-abk,tokyodesign,designabk,tokyo-design-abk,tokyodesignabk", "", "it", "abc", "")


@query("name_token_lists", f"SELECT s_suppkey AS id, {case_sql('s_suppkey', *TOKENS)} AS tokens, {case_sql('s_suppkey', *HOSTS)} AS hosts FROM supplier")
def name_token_lists(t: Load) -> DataFrame:
    """STR-24, STR-25."""
    rows = t("supplier").select(F.col("s_suppkey").alias("id"), text.folded(by_case("s_suppkey", *TOKEN_NAMES)).alias("name"))
    hosts = text.host_tokens(F.col("name"), {"東京": "tokyo", "デザイン": "design"})
    return rows.select("id", F.array_join(text.name_tokens(F.col("name")), ",").alias("tokens"), F.array_join(hosts, ",").alias("hosts"))


TRACKED = ("情報（Ｗｅｂ・ＡＩ）", "美容(ヘア、メイク/ネイル)", "看護", "調理（昼間）")
TRACKS = ("Web|AI", "ヘア|メイク|ネイル", "", "昼間")
LINKS = ("「東京デザイン」公式サイト", " 学校 情報公開 PDF ", "Ｓｃｈｏｏｌ　ホームページ", "大阪|美容_専門-学校")
LINK_LABELS = ("東京デザイン", "学校情報公開", "school", "大阪美容専門学校")
REMARKS = ("新規", "新規取消", "校名変更、統合", "開校に伴う再編", "対象外", "変更なし", None)
TAGS = ("new_accreditation", "withdrawal", "name_change,merger_reorg", "new_accreditation,merger_reorg", "withdrawal", "", "")


@query("label_lists", f"SELECT p_partkey AS id, {case_sql('p_partkey', *TRACKS)} AS tracks, {case_sql('p_partkey', *LINK_LABELS)} AS link, {case_sql('p_partkey', *TAGS)} AS tags FROM part")
def label_lists(t: Load) -> DataFrame:
    """STR-27, STR-29, STR-30."""
    key = "p_partkey"
    rows = t("part").select(F.col(key).alias("id"), text.bracketed_tracks(by_case(key, *TRACKED)).alias("tracks"), text.link_label(by_case(key, *LINKS)).alias("link"), text.remark_tags(by_case(key, *REMARKS)).alias("tags"))
    return rows.select("id", F.array_join("tracks", "|").alias("tracks"), "link", F.array_join("tags", ",").alias("tags"))


@query("scrubbed_documents", r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace('C:\Users\me\x /home/you/y ' || coalesce(text, ''), '[\w.+-]+@[\w-]+\.[\w.-]+', '[email]', 'g'), '\b0\d{1,4}-\d{1,4}-\d{3,4}\b', '[phone]', 'g'), '(?i)(/home/|/Users/|C:\\Users\\)[^/\\\s]+', '\1[user]', 'g')) AS scrubbed FROM documents""")
def scrubbed_documents(t: Load) -> DataFrame:
    """STR-28: whole documents."""
    return t("documents").select("doc_id", F.md5(text.scrubbed(F.concat(F.lit("C:\\Users\\me\\x /home/you/y "), F.coalesce("text", F.lit(""))))).alias("scrubbed"))


PAGES = ("様式第2号\n学校名：東京デザイン専門学校\n設置者名 学校法人東京学園\n令和８年度", "名称 大阪大学\n設置者の名称：医療法人大阪会\n1", " 京都美容専門学校 \n2024年度", "何もない", None)
PAGE_ENTITIES = ("東京デザイン専門学校", "大阪大学", "京都美容専門学校", None, None)
PAGE_OWNERS = ("学校法人東京学園", "医療法人大阪会", None, None, None)
PAGE_PERIODS = (2026, None, 2024, None, None)


@query("page_entities", f"SELECT s_suppkey AS id, {case_sql('s_suppkey', *PAGE_ENTITIES)} AS entity, {case_sql('s_suppkey', *PAGE_OWNERS)} AS owner, {case_sql('s_suppkey', *PAGE_PERIODS)} AS period, concat_ws(';', s_name || ' 情報公開', s_name || ' 青森県', 'Owner ' || s_name || ' 公式') AS queries FROM supplier")
def page_entities(t: Load) -> DataFrame:
    """STR-31, STR-32, DAT-08."""
    rows = t("supplier").select(F.col("s_suppkey").alias("id"), "s_name", by_case("s_suppkey", *PAGES).alias("page"))
    queries = F.array_join(text.search_queries(F.col("s_name"), F.lit("Owner"), F.lit("青森県")), ";")
    return rows.select("id", text.entity_of_page(F.col("page")).alias("entity"), text.owner_of_page(F.col("page")).alias("owner"), periods.period_of_document(F.col("page"), 2026).alias("period"), queries.alias("queries"))


# --- addresses ---------------------------------------------------------------------------------------------------

URLS_SQL = """SELECT page_id, regexp_extract(url, '^([a-z]+://[^/]+)', 1) AS origin, regexp_extract(url, '^([a-z]+://[^/]+)', 1) || '/東 京+x.pdf?a=1' AS dedupe,
  CASE page_id % 3 WHEN 0 THEN 'embed_wordpress' WHEN 1 THEN 'cache_busted' ELSE 'direct' END AS pattern, url AS first, concat_ws(' ', regexp_extract(url, '^([a-z]+://[^/]+)', 1) || '/disclosure/', regexp_extract(url, '^([a-z]+://[^/]+)', 1) || '/information/',
  regexp_extract(url, '^([a-z]+://[^/]+)', 1) || '/joho/', regexp_extract(url, '^([a-z]+://[^/]+)', 1) || '/public/', regexp_extract(url, '^([a-z]+://[^/]+)', 1) || '/about/disclosure/') AS probes,
  CASE page_id % 4 WHEN 0 THEN TRUE WHEN 1 THEN TRUE ELSE FALSE END AS social, CASE WHEN page_id % 2 = 0 THEN url || '/form.pdf' END AS inner_document, concat_ws('/', '2026', sha256(html), 'form.pdf') AS path FROM pages"""


@query("url_parts", URLS_SQL)
def url_parts(t: Load) -> DataFrame:
    """URL-02, URL-06..12."""
    origin = urls.origin(F.col("url"))
    found = F.when(F.col("page_id") % 3 == 0, F.concat(origin, F.lit("/wp-content/a.pdf"))).otherwise(F.concat(origin, F.lit("/a.pdf")))
    raw = F.when(F.col("page_id") % 3 == 1, "a.pdf?v=2").otherwise("a.pdf")
    hosts = by_case("page_id", "m.facebook.com", "x.com", "notx.com", "school.example.com")
    viewer = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("https://view.example.com/v?z=1&file="), F.url_encode(F.concat("url", F.lit("/form.pdf"))))).otherwise(F.lit("https://view.example.com/v?file=form.html"))
    return t("pages").select(
        "page_id", origin.alias("origin"), urls.dedupe_key(F.concat(origin, F.lit("//%E6%9D%B1%20%E4%BA%AC+x.pdf?utm_source=y&a=1#p"))).alias("dedupe"),
        urls.delivery_pattern(found, raw, F.when(F.col("page_id") % 3 == 0, "embed")).alias("pattern"), urls.first_url(F.concat(F.lit("see <"), "url", F.lit("> or https://b.example.com"))).alias("first"),
        F.array_join(urls.probe_urls(F.col("url")), " ").alias("probes"), urls.host_matches(hosts).alias("social"), urls.document_in_query(viewer).alias("inner_document"),
        urls.content_path(F.lit(2026), F.col("html"), F.lit("form.pdf")).alias("path"),
    )


# --- periods -----------------------------------------------------------------------------------------------------

ERA_TEXTS = ("令和８年度", "平成三十一年6月1日", "令和元年度 確認申請", "平成二十年度 令和七年4月1日", "昭和", None, "２０２５年度", "R07_form.pdf", "reiwa8.pdf", "order8")
ERA_PERIODS = (2026, 2019, 2019, 2025, None, None, None, None, None, None)
HAS_PERIOD = (True, True, True, True, False, False, True, True, True, False)
NUMERALS = ("元", "十", "二十一", "三", "２", "九十九", "x", "四〇")
NUMERAL_VALUES = (1, 10, 21, 3, 2, 99, None, 40)


@query("era_texts", f"""SELECT o_orderkey, {case_sql('o_orderkey', *ERA_PERIODS)} AS period, {case_sql('o_orderkey', *HAS_PERIOD).replace("True", "TRUE").replace("False", "FALSE")} AS has_period, {case_sql('o_orderkey', *NUMERAL_VALUES)} AS numeral,
  1989 + o_orderkey % 30 - 1 AS era_period, CASE WHEN year(o_orderdate) + 25 >= 2019 THEN year(o_orderdate) + 25 - 2018 END::INT AS era_year FROM orders""")
def era_texts(t: Load) -> DataFrame:
    """DAT-02, DAT-03, DAT-04, DAT-06."""
    key = "o_orderkey"
    c = by_case(key, *ERA_TEXTS)
    return t("orders").select(
        key, periods.period_of_era_text(c).alias("period"), periods.has_period_text(c).alias("has_period"), periods.kanji_number(F.translate(by_case(key, *NUMERALS), "２", "2")).alias("numeral"),
        periods.era_to_period(F.lit(1989), F.col(key) % 30).alias("era_period"), periods.period_to_era_year(F.year("o_orderdate") + 25).alias("era_year"),
    )


@query("search_token_lists", "SELECT r_regionkey, CASE r_regionkey % 3 WHEN 0 THEN '2026,令和8,令和08,令和八,R8,R08,reiwa8' WHEN 1 THEN '2019,令和1,令和01,令和一,R1,R01,reiwa1,令和元' ELSE '2010,平成22,平成22,平成二十二,H22,H22,heisei22' END AS tokens FROM region")
def search_token_lists(t: Load) -> DataFrame:
    """DAT-05."""
    tokens = [",".join(periods.search_tokens(p)) for p in (2026, 2019, 2010)]
    return t("region").select("r_regionkey", by_case("r_regionkey", *tokens).alias("tokens"))


DOCUMENTS = (
    "令和７年度 2023年度 令和8年4月1日", "申請日 令和8年4月1日 2023年度", "令和9年4月1日 2024 年", "2021年 2022年 2022年", "2024.4.1 2023/5/1 2023年", "2031年度 2020年 2019/ 2019 2020.", "本文のみ", None,
)
DOCUMENT_PERIODS = (2025, 2026, 2024, 2022, 2024, 2020, None, None)
LINED = ("2019年度 施行\n2025年度 確認", "2030年度\n2024年度", "設立 2001年度", "2022年度", None)
LINED_PERIODS = (2025, 2024, None, 2022, None)


@query("document_periods", f"""SELECT o_orderkey, {case_sql('o_orderkey', *DOCUMENT_PERIODS)} AS period, {case_sql('o_orderkey', *LINED_PERIODS)} AS by_line, CASE WHEN o_custkey <= 2027 THEN o_custkey END::INT AS imported,
  CASE WHEN o_orderkey % 3 = 0 THEN 2026 ELSE 2020 END AS effective, date_diff('day', o_orderdate, DATE '1998-08-02') <= 370 AS recent FROM orders""")
def document_periods(t: Load) -> DataFrame:
    """DAT-08, DAT-09, DAT-11, DAT-12, DAT-13."""
    key = "o_orderkey"
    return t("orders").select(
        key, periods.period_of_document(by_case(key, *DOCUMENTS), 2026).alias("period"), periods.period_by_line(by_case(key, *LINED), 2026).alias("by_line"), periods.import_period(F.col("o_custkey"), 2026).alias("imported"),
        periods.effective_period(F.when(F.col(key) % 3 == 0, 2026), F.lit(2020)).alias("effective"), periods.recently(F.col("o_orderdate"), F.lit("1998-08-02").cast("date")).alias("recent"),
    )


HINTS = (
    "令和８年度 確認申請", "2024年度", "確認申請書(2023)", "2022_様式第2号.pdf", "yoshiki_2021a.pdf", "確認申請 2025年", "確認申請 /files/20240401.pdf", "kakunin/disclosure/2023/x", "機関要件 2026 学校", "r7.pdf", "令和七",
    "令和6年5月1日", "令和元年法律第8号", "2024.pdf", "平成30 確認", "お知らせ", None, "確認申請 修学支援新制度 2025年4月から", "確認申請書 2023年4月 就職 修学支援", "機関要件 高等教育の無償化は令和2年4月より", "令和2年4月 無償化", "12021 確認申請 x2022y.pdf",
)
HINT_PERIODS = (2026, 2024, 2023, 2022, 2021, 2025, 2024, 2023, 2026, 2025, 2025, None, None, None, 2018, None, None, 2025, None, 2020, None, 2022)


@query("period_hints", f"SELECT o_orderkey, {case_sql('o_orderkey', *HINT_PERIODS)} AS hint FROM orders")
def period_hints(t: Load) -> DataFrame:
    """DAT-10."""
    return t("orders").select("o_orderkey", periods.period_hint(by_case("o_orderkey", *HINTS), 2026).alias("hint"))


# --- numbers -----------------------------------------------------------------------------------------------------

COUNTS = ("計 １，２３４人", "3 と 45", "なし", None, "12,000/15")
FIRST = (1234, 3, None, None, 12000)
ALL = ("1234", "3,45", "", "", "12000,15")


@query("numbers_of_text", f"""SELECT o_orderkey, {case_sql('o_orderkey', *FIRST)}::BIGINT AS first, {case_sql('o_orderkey', *ALL)} AS every, round(least(greatest(o_orderkey % 13 - 1, 0), 10) / 10, 2) AS confidence,
  CASE WHEN o_orderkey % 7 = 0 THEN 'not_measured' WHEN o_orderkey % 100 >= 60 THEN 'pass' ELSE 'below_gate' END AS gate, CASE o_orderkey % 3 WHEN 0 THEN 0.75 WHEN 1 THEN 0.0 ELSE 0.4 END::DOUBLE AS ocr FROM orders""")
def numbers_of_text(t: Load) -> DataFrame:
    """NUM-17, NUM-19, NUM-20, NUM-21, AGG-41."""
    key = "o_orderkey"
    words = F.when(F.col(key) % 3 == 0, F.array(F.lit(90.0), F.lit(60.0), F.lit(-1.0))).when(F.col(key) % 3 == 1, F.array(F.lit(-1.0))).otherwise(F.array(F.lit(40.0)))
    return t("orders").select(
        key, numbers.first_int(by_case(key, *COUNTS)).alias("first"), F.array_join(F.transform(numbers.all_ints(by_case(key, *COUNTS)), lambda x: x.cast("string")), ",").alias("every"),
        numbers.score_to_confidence((F.col(key) % 13 - 1).cast("double")).alias("confidence"), numbers.yield_gate(F.when(F.col(key) % 7 != 0, F.col(key) % 100).cast("double")).alias("gate"), numbers.ocr_factor(words).alias("ocr"),
    )


TITLES = ("ABK専門学校 情報公開", "学校一覧", "学校法人甲 案内", "進学案内", "ABK専門学校")
DESCRIPTIONS = ("", "ABK専門学校の機関要件", "", "学校法人甲のページ", "公開情報")
RESULT_URLS = ("https://abk.ac.jp/", "https://x.ed.jp/", "https://a.com/", "https://b.com/", "https://c.go.jp/")
RESULT_SCORES = (0.99, 0.93, 0.7, 0.65, 0.99)


@query("search_result_scores", f"SELECT s_suppkey AS id, {case_sql('s_suppkey', *RESULT_SCORES)}::DOUBLE AS score FROM supplier")
def search_result_scores(t: Load) -> DataFrame:
    """NUM-16."""
    key = "s_suppkey"
    s = numbers.search_result_score(by_case(key, *RESULT_URLS), by_case(key, *TITLES), by_case(key, *DESCRIPTIONS), F.lit("ABK専門学校"), F.lit("学校法人甲"))
    return t("supplier").select(F.col(key).alias("id"), F.round(s, 6).alias("score"))


SITES = ("https://abk.ac.jp/", "https://abk.example.com/news/1", "https://www.facebook.com/abk", "https://abk.ac.jp/x.pdf", "https://abk.city.lg.jp/", "nothing")
SITE_SCORES = (9.5, 2.5, -5.0, -5.0, 9.5, 0.0)
SITE_DECISIONS = ("auto", "reject", "reject", "reject", "review", "reject")


@query("site_scores", f"SELECT s_suppkey AS id, {case_sql('s_suppkey', *SITE_SCORES)}::DOUBLE AS score, {case_sql('s_suppkey', *SITE_DECISIONS)} AS decision FROM supplier")
def site_scores(t: Load) -> DataFrame:
    """NUM-14."""
    key = "s_suppkey"
    rows = t("supplier").select(F.col(key).alias("id"), by_case(key, *SITES).alias("url"))
    s = numbers.url_score(F.col("url"), F.lit("ABK専門学校"), F.lit(""), F.lit("ABK専門学校 ページ"), F.lit("情報公開 公式"))
    return rows.withColumn("s", s).select("id", F.round("s.score", 6).alias("score"), "s.decision")
