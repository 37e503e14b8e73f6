"""Queries of the state rules, record shapes, review work, and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.functions import payloads, states
from veritab.functions.text import folded
from veritab.operators import evidence, records, report, resolve, revision, workflow
from veritab.plans.registry import Load, query
from veritab.plans.text_queries import by_case, case_sql
from veritab.sources import files
from veritab.streaming import queues

# --- rules -------------------------------------------------------------------------------------------------------

DIAGNOSIS = ("ambiguous_entity", "entity_missing", "no_units_parsed", "no_document", "unit_unmatched", "no_rows_for_period", "no_document_for_period", None)
DIAGNOSIS_FLAGS = {"has_entity": (1, 0, 1, 1, 1, 1, 1, 1), "ambiguous": (1, 0, 0, 0, 0, 0, 0, 0), "has_units": (1, 0, 0, 0, 1, 1, 1, 1), "has_unit": (1, 0, 0, 0, 0, 1, 1, 1), "has_document": (1, 0, 1, 0, 1, 1, 0, 1), "has_rows": (0, 0, 0, 0, 0, 0, 0, 1)}
PROPOSALS = ("no_candidate", "auto_alias", "review_alias", "ambiguous")
EXPANSIONS = ("東京デザイン専門学校", "東京デザイン学校", "東京デザイン大学", "東京デザイン", "大阪東京デザイン専門学校")
EXPANDED = (True, True, False, False, False)
BODIES = ("Access Denied", "welcome", None, "px: PerimeterX", "ok")
CODES = (200, 403, 503, 404, None)
BLOCKED = (True, True, True, True, False)


@query("rule_tables", f"""SELECT o_orderkey, {case_sql('o_orderkey', *DIAGNOSIS)} AS diagnosis, {case_sql('o_orderkey', 'text_extraction', 'ocr', 'manual_review')} AS lane, {case_sql('o_orderkey', *PROPOSALS)} AS proposal,
  {case_sql('o_orderkey', *EXPANDED)} AS low_risk, {case_sql('o_orderkey', *BLOCKED)} AS blocked FROM orders""")
def rule_tables(t: Load) -> DataFrame:
    """CLS-12, CLS-14, CLS-15, CLS-18, CLS-21."""
    key = "o_orderkey"
    flags = {name: by_case(key, *values) == 1 for name, values in DIAGNOSIS_FLAGS.items()}
    return t("orders").select(
        key, states.gap_diagnosis(**flags).alias("diagnosis"), states.lane(by_case(key, "text", "image", "mixed")).alias("lane"), states.alias_class(F.col(key) % 4 - (F.col(key) % 4 > 1).cast("int"), F.col(key) % 4 == 1).alias("proposal"),
        states.low_risk_expansion(by_case(key, *EXPANSIONS), F.lit("東京デザイン")).alias("low_risk"), states.blocked(by_case(key, *CODES), by_case(key, *BODIES)).alias("blocked"),
    )


@query("unit_proposals", "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'ambiguous' WHEN p_partkey % 3 = 0 THEN 'no_candidate' WHEN p_partkey % 2 = 0 THEN 'auto_alias' ELSE 'review_alias' END AS class FROM part")
def unit_proposals(t: Load) -> DataFrame:
    """CLS-16: units against the candidates that their entity has."""
    unit = t("part").select("p_partkey", F.concat(F.lit("情報"), F.col("p_partkey").cast("string")).alias("stem"))
    same, other = F.concat("stem", F.lit("科")), F.concat("stem", F.lit("ビジネス学科"))
    names = F.when(F.col("p_partkey") % 5 == 0, F.array(same, other)).when(F.col("p_partkey") % 3 == 0, F.array().cast("array<string>")).when(F.col("p_partkey") % 2 == 0, F.array(same)).otherwise(F.array(other))
    candidates = unit.select("p_partkey", F.explode(names).alias("candidate"))
    return records.unit_alias_classes(unit.select("p_partkey", F.concat("stem", F.lit("学科")).alias("unit")), candidates, "p_partkey")


LOG_SQL = """WITH l AS (SELECT event_id % 40 AS run_id, CASE event_type WHEN 'error' THEN 'Error: timed out' WHEN 'view' THEN 'Timeout' ELSE 'fine' END AS message, ts FROM events)
SELECT run_id, count(*) FILTER (message LIKE 'Error%') AS errors, count(*) FILTER (message <> 'fine') AS timeouts, max(ts) < TIMESTAMP '2100-01-01' AS quiet FROM l GROUP BY 1"""


@query("log_signals", LOG_SQL)
def log_signals(t: Load) -> DataFrame:
    """CLS-22."""
    log = t("events").select((F.col("event_id") % 40).alias("run_id"), F.when(F.col("event_type") == "error", "Error: timed out").when(F.col("event_type") == "view", "Timeout").otherwise("fine").alias("message"), F.col("ts").alias("at"))
    return workflow.log_signals(log, F.lit("2100-01-01").cast("timestamp")).select("run_id", "errors", "timeouts", "quiet")


@query("json_payloads", """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS region, CASE WHEN p_partkey % 3 = 0 THEN 'a,' || p_brand END AS tags, CASE p_partkey % 3 WHEN 0 THEN '{"region":"' || p_brand || '","tags":["a","' || p_brand || '"]}' WHEN 1 THEN '{"text":"no {json"}' ELSE p_size::VARCHAR END AS value FROM part""")
def json_payloads(t: Load) -> DataFrame:
    """JSN-06, JSN-07."""
    third = F.col("p_partkey") % 3
    shown = F.when(third == 0, F.concat(F.lit('{"region": "'), "p_brand", F.lit('", "tags": ["a", "'), "p_brand", F.lit('"]}'))).when(third == 1, "no {json").otherwise(F.col("p_size").cast("string"))
    rows = t("part").select("p_partkey", shown.alias("v"))
    p = payloads.remark_payload(F.col("v"))
    # a number is no object, so it has neither region nor tags
    return rows.select("p_partkey", p["region"].alias("region"), F.array_join(p["tags"], ",").alias("tags"), F.to_json(payloads.parsed_or_text(F.col("v"))).alias("value"))


# --- record shapes -----------------------------------------------------------------------------------------------

STATUS_TEXTS = ("〇", "△（前年）", "閉校", "リンクミス", "???", None, " 職実 ")
STATUS_NAMES = ("collected", "stale", "excluded", "error", "pending", "pending", "collected")


@query("status_texts", f"SELECT c_custkey AS id, {case_sql('c_custkey', *STATUS_NAMES)} AS status FROM customer")
def status_texts(t: Load) -> DataFrame:
    """SRC-02."""
    return t("customer").select(F.col("c_custkey").alias("id"), records.status_of_text(by_case("c_custkey", *STATUS_TEXTS)).alias("status"))


@query("rows_with_evidence", "SELECT unit_id, period, 'capacity' AS metric, capacity AS value, 'p' || period AS evidence FROM fact WHERE capacity IS NOT NULL UNION ALL SELECT unit_id, period, 'enrollment', enrollment, 'q' FROM fact WHERE enrollment IS NOT NULL AND unit_id % 2 = 0", "fact")
def rows_with_evidence(t: Load) -> DataFrame:
    """FLT-06."""
    page = F.create_map(F.lit("capacity"), F.concat(F.lit("p"), F.col("period").cast("string")), F.lit("enrollment"), F.when(F.col("unit_id") % 2 == 0, "q"))
    return records.with_evidence(t("fact").withColumn("pages", page), ["unit_id", "period"], ["capacity", "enrollment"], "pages")


@query("master_rows", "SELECT unit_id, period, unnest(['capacity', 'enrollment']) AS metric, unnest([capacity, enrollment]) AS value, NULL AS reason FROM fact WHERE capacity IS NOT NULL UNION ALL SELECT unit_id, period, NULL, NULL, 'blank capacity' FROM fact WHERE capacity IS NULL", "fact")
def master_rows(t: Load) -> DataFrame:
    """SRC-07: the long rows, and after them the rows that were skipped."""
    rows, skipped = records.master_rows(t("fact"), ["unit_id", "period"], ["capacity", "enrollment"], "capacity")
    return rows.withColumn("reason", F.lit(None).cast("string")).unionByName(skipped, allowMissingColumns=True)


@query("cell_addresses", "SELECT l_orderkey, l_linenumber, 'B' || l_orderkey AS near, 'AB' || l_linenumber AS far FROM lineitem")
def cell_addresses(t: Load) -> DataFrame:
    """SRC-08."""
    return t("lineitem").select("l_orderkey", "l_linenumber", records.cell_address(F.col("l_orderkey"), 1).alias("near"), records.cell_address(F.col("l_linenumber"), 27).alias("far"))


GRID_SQL = """SELECT o_orderkey AS doc_id, r::INT AS "row", c::INT AS col, '情報' || r AS unit, CASE c WHEN 1 THEN 'capacity' ELSE 'enrollment' END AS metric, CASE c WHEN 1 THEN '総定員' ELSE '生徒 実員' END AS label, (o_orderkey % 1000 + r * 10 + c)::BIGINT AS value
FROM orders, unnest([1, 2]) AS x(r), unnest([1, 3]) AS y(c) WHERE o_orderkey % 5 <> 0"""


@query("grid_records", GRID_SQL)
def grid_records(t: Load) -> DataFrame:
    """SRC-14, ARR-01, ARR-04: a table of units and one without for each document."""
    key = F.col("o_orderkey")
    head = F.when(key % 5 != 0, F.array(F.lit("学科名"), F.lit("総定員"), F.lit("備考"), F.lit("生徒 実員"))).otherwise(F.array(F.lit("名称"), F.lit("総定員"), F.lit("備考"), F.lit("生徒 実員")))
    line = lambda r: F.array(F.lit(f"情 報{r}"), F.concat((key % 1000 + r * 10 + 1).cast("string"), F.lit("人")), F.lit("-"), (key % 1000 + r * 10 + 3).cast("string"))
    grids = t("orders").select(key.alias("doc_id"), F.lit(1).alias("page"), F.lit(0).alias("table_index"), F.array(head, line(1), line(2)).alias("grid"))
    return records.grid_records(records.unit_tables(grids)).select("doc_id", "row", "col", "unit", "metric", "label", "value")


SUPPORT_PAGE = "（別紙）\n前年度の授業料等減免対象者\n支援対象者数 ※括弧内は多子世帯の学生等(内数) 342 人 (1人) 328 人 (11人) 350 人 (15人)\n第Ⅰ区分 177 人 166 人\n第Ⅱ区分\n90 人 88 人\n第Ⅲ区分 75 人\n第Ⅳ区分(理工農) 3 人 4 人\n※家計急変による者を除く"
SUPPORT_NEXT = "家計急変による\n2 人 (0人)\n合計(年間) 352 人 (15人)"


@query("support_sections", """SELECT o_orderkey AS doc_id, 342::BIGINT AS first_half_total, 328::BIGINT AS second_half_total, 350::BIGINT AS annual_total, 177::BIGINT AS first_half_cat1, 166::BIGINT AS second_half_cat1, 90::BIGINT AS first_half_cat2, 88::BIGINT AS second_half_cat2,
  75::BIGINT AS first_half_cat3, NULL::BIGINT AS second_half_cat3, 3::BIGINT AS first_half_cat4, 4::BIGINT AS second_half_cat4, 2::BIGINT AS household_change, 352::BIGINT AS grand_total FROM orders WHERE o_orderkey % 2 = 0""")
def support_sections(t: Load) -> DataFrame:
    """ARR-03: odd documents have no such page."""
    texts = [F.lit("表紙"), F.when(F.col("o_orderkey") % 2 == 0, SUPPORT_PAGE).otherwise("前年度の実績"), F.lit(SUPPORT_NEXT)]
    pages = t("orders").select(F.col("o_orderkey").alias("doc_id"), F.posexplode(F.array(*texts)).alias("page", "text"))
    return records.support_records(pages)


NAMES = ("東京デザイン専門学校", "学校名", "12-3", "短", None, "ＡＢＣ学院")
PLAUSIBLE = (True, False, False, False, False, True)
CANDIDATES = ("財務諸表 zaimu.pdf", "form 2026", "form 2023", "form 2029", "シラバス /news/1")
REASONS = ("negative_word:財務", None, "stale_period", "future_period", "negative_word:シラバス")


@query("row_checks", f"SELECT c_custkey AS id, {case_sql('c_custkey', *PLAUSIBLE)} AS plausible, {case_sql('c_custkey', *REASONS)} AS rejected FROM customer")
def row_checks(t: Load) -> DataFrame:
    """FLT-17, FLT-05."""
    key = "c_custkey"
    rejected = records.rejected(by_case(key, *CANDIDATES), by_case(key, None, 2026, 2023, 2029, None).cast("int"), 2026)
    return t("customer").select(F.col(key).alias("id"), records.plausible_name(by_case(key, *NAMES)).alias("plausible"), rejected.alias("rejected"))


LINKS_SQL = r"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->', '', 'g'), '(?is)<a\b[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a\s*>', 1)) AS href,
  unnest(regexp_extract_all(regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->', '', 'g'), '(?is)<a\b[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a\s*>', 2)) AS text FROM pages),
f AS (SELECT page_id, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href WHEN starts_with(href, '//') THEN regexp_extract(url, '^([^:]+:)', 1) || href WHEN starts_with(href, '/') THEN lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)) || href ELSE regexp_replace(url, '[^/]*$', '') || href END AS href,
  trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM a)"""


@query("anchor_counts", LINKS_SQL + " SELECT page_id, count(*) AS links, count(DISTINCT href) AS addresses, md5(string_agg(href || ' ' || text, chr(10) ORDER BY href, text)) AS digest FROM f GROUP BY 1")
def anchor_counts(t: Load) -> DataFrame:
    """SRC-25: the anchors of all pages by page."""
    links = records.page_links(t("pages")).filter("source = 'anchor'")
    shown = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("href", "text"))), lambda x: F.concat(x["href"], F.lit(" "), x["text"])), "\n")
    return links.groupBy("page_id").agg(F.count("*").alias("links"), F.count_distinct("href").alias("addresses"), F.md5(shown).alias("digest"))


@query("subpage_counts", "WITH x AS (SELECT p_partkey % 20 AS page_id, p_partkey AS position, CASE WHEN p_partkey % 3 = 0 THEN '情報公開' WHEN p_partkey % 3 = 1 THEN 'about us' ELSE 'map' END AS text, 'https://e.com/' || (p_partkey % 60) AS href FROM part), k AS (SELECT page_id, href, min(position) AS position, max((text LIKE '%情報%')::INT) AS named FROM x WHERE text <> 'map' GROUP BY ALL) SELECT page_id, href, position, named, row_number() OVER (PARTITION BY page_id ORDER BY named DESC, position, href) AS rank FROM k QUALIFY rank <= 12")
def subpage_counts(t: Load) -> DataFrame:
    """WIN-23."""
    k = F.col("p_partkey")
    links = t("part").select((k % 20).alias("page_id"), k.alias("position"), by_case("p_partkey", "情報公開", "about us", "map").alias("text"), F.concat(F.lit("https://e.com/"), (k % 60).cast("string")).alias("href"))
    return records.subpages(links)


RANK_SQL = """WITH c AS (SELECT p_partkey % 10 AS page_id, p_partkey AS position, p_partkey % 6 AS k, (p_partkey // 10) % 4 AS m FROM part),
s AS (SELECT *, CASE k WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS tier, CASE k WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS year_rank, CASE k WHEN 0 THEN 7.5 WHEN 1 THEN 2.5 WHEN 2 THEN -2.5 ELSE 0.5 END::DOUBLE AS score FROM c)
SELECT page_id, position, tier, m AS match, score, row_number() OVER (PARTITION BY page_id ORDER BY tier, m, CASE WHEN tier < 2 THEN year_rank ELSE 0 END, score DESC, position) AS rank,
  tier = 2 AND row_number() OVER (PARTITION BY page_id, tier ORDER BY m, CASE WHEN tier < 2 THEN year_rank ELSE 0 END, score DESC, position) > 5 AS dropped FROM s"""


@query("candidate_order", RANK_SQL)
def candidate_order(t: Load) -> DataFrame:
    """WIN-11, NUM-15, URL-07."""
    k = F.col("p_partkey")
    m = F.floor(k / 10) % 4
    rank = records.match_rank(F.when((m == 0) | (m == 3), "東京デザイン"), m == 1, m == 0)
    words = by_case("p_partkey", "令和８年度 確認申請書 修学支援", "2024年度 確認申請書", "シラバス", "案内", "案内", "案内")
    c = t("part").select((k % 10).alias("page_id"), k.alias("position"), words.alias("text"), F.concat(F.lit("https://e.com/"), k.cast("string")).alias("href"), F.lit("direct").alias("pattern"), rank.alias("match"))
    return records.ranked(c, 2026, 5).select("page_id", "position", "tier", "match", "score", "rank", "dropped")


# --- review work -------------------------------------------------------------------------------------------------

@query("current_revisions", "SELECT o_custkey AS entity_id, max(year(o_orderdate)) AS period, arg_max(o_orderkey, o_orderkey) AS position FROM orders GROUP BY o_custkey, o_orderstatus ORDER BY ALL")
def current_revisions(t: Load) -> DataFrame:
    """FLT-01: the highest order key takes the part of the revision."""
    rows = t("orders").select(F.col("o_custkey").alias("entity_id"), "o_orderstatus", F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("revision"))
    latest = rows.groupBy("entity_id", "o_orderstatus").agg(F.max("year").alias("period"))
    return revision.current(rows, ["entity_id", "o_orderstatus"]).join(latest, ["entity_id", "o_orderstatus"]).select("entity_id", "period", F.col("revision").alias("position"))


BLOCKERS = ("no_url", "no_target_pdf", "ocr_pending", "parse_failed", None, "review_required")
ACTIONS = ("add_url", "find_document", "recognise_or_enter", "enter", "export", "check_document")


@query("manual_queue", f"SELECT {case_sql('c_custkey', *ACTIONS)} AS action, count(*) AS n, count(*) FILTER ({case_sql('c_custkey', *ACTIONS)} = 'enter') AS to_enter FROM customer GROUP BY 1")
def manual_queue(t: Load) -> DataFrame:
    """AGG-30, FLT-13."""
    rows = t("customer").select("c_custkey", by_case("c_custkey", *BLOCKERS).alias("blocking_reason"))
    enter = workflow.of_action(rows, "enter").agg(F.count("*").alias("k"))
    n = workflow.manual_summary(rows)
    return n.join(F.broadcast(enter), F.lit(True)).select("action", "n", F.when(F.col("action") == "enter", F.col("k")).otherwise(0).alias("to_enter"))


@query("bucket_rows", "SELECT o_orderkey FROM orders WHERE o_custkey % 3 = 1")
def bucket_rows(t: Load) -> DataFrame:
    """FLT-12."""
    buckets = t("customer").select(F.col("c_custkey").alias("entity_id"), by_case("c_custkey", "a", "b", "c").alias("bucket"))
    return workflow.of_bucket(t("orders").withColumnRenamed("o_custkey", "entity_id"), buckets, "b").select("o_orderkey")


@query("sites_in_scope", "SELECT site_id, region, entity_type FROM site JOIN entity USING (entity_id) WHERE region = 'ASIA' AND method = 'region_index'", "site", "entity")
def sites_in_scope(t: Load) -> DataFrame:
    """JOIN-20, AGG-44."""
    return workflow.site_scope(t("site"), t("entity"), "ASIA", "region_index").select("site_id", "region", "entity_type")


PARSED = ("abcデザイン", "東京 デザイン学院本校", "大阪美容", "abcデザイン学院専攻", "短い名")
MATCHES = (True, True, False, True, False)
LABEL_CAMPUS = ("東京デザイン", "東京デザイン大阪校", "東京", "東京デザイン大学付属高校", "大阪美容学院", "京都調理専門")
SAME_CAMPUS = (True, True, False, True, False, False)
NAMES_OTHER = (False, False, False, False, True, False)


@query("identity_checks", f"SELECT c_custkey AS id, {case_sql('c_custkey', *MATCHES)} AS matches, {case_sql('c_custkey', *SAME_CAMPUS)} AS same_campus, {case_sql('c_custkey', *NAMES_OTHER)} AS names_another FROM customer")
def identity_checks(t: Load) -> DataFrame:
    """JOIN-25, JOIN-29, JOIN-30."""
    key, label = "c_custkey", by_case("c_custkey", *LABEL_CAMPUS)
    names = F.array(F.lit("abcデザイン"), F.lit("東京 デザイン学院"), F.lit("大阪"))
    others = F.array(F.lit("大阪美容学院"), F.lit("短"))
    return t("customer").select(
        F.col(key).alias("id"), workflow.identity_matches(by_case(key, *PARSED), names).alias("matches"), workflow.same_or_campus(label, F.lit("東京デザイン")).alias("same_campus"), workflow.names_another(label, F.lit("東京デザイン"), others).alias("names_another")
    )


@query("owner_pages", "WITH p AS (SELECT e.entity_id, 'https://o.example.com/' || e.entity_id || CASE k WHEN 0 THEN '/plan.pdf' WHEN 1 THEN '/disclosure' ELSE '/top' END AS url, k FROM entity e, unnest([0, 1, 2]) AS x(k) WHERE NOT (k = 0 AND e.entity_id % 2 = 0)) SELECT entity_id, arg_min(url, k) AS url FROM p GROUP BY 1", "entity")
def owner_pages(t: Load) -> DataFrame:
    """JOIN-28: each owner lists a page or more for each of its entities."""
    e = t("entity").select("entity_id", "owner", F.concat(F.lit("/"), F.col("entity_id").cast("string"), F.lit("/")).alias("token"))
    tails = F.when(F.col("entity_id") % 2 == 0, F.array(F.lit("/disclosure"), F.lit("/top"))).otherwise(F.array(F.lit("/plan.pdf"), F.lit("/disclosure"), F.lit("/top")))
    pages = t("entity").select("owner", F.explode(F.transform(tails, lambda x: F.concat(F.lit("https://o.example.com/"), F.col("entity_id").cast("string"), x))).alias("url"))
    return workflow.owner_pages(e, pages)


@query("todo_counts", "SELECT count(*) FILTER (event_type NOT IN ('error', 'click')) AS pending, max(ts) AS last_alias, date_diff('day', max(ts)::DATE, DATE '2100-01-01') > 30 AS aliases_stale FROM events")
def todo_counts(t: Load) -> DataFrame:
    """AGG-26."""
    items = t("events").select(F.when(F.col("event_type").isin("error", "click"), "approved").otherwise("pending").alias("status"))
    return workflow.todo_counts(items, t("events").select(F.col("ts").alias("created_at")), F.lit("2100-01-01").cast("timestamp"))


@query("region_report", "SELECT region, count(*) AS rows, count(*) FILTER (entity_id % 3 <> 0) AS matched, count(*) FILTER (entity_id % 3 = 1) AS exact, count(*) FILTER (entity_id % 3 = 2) AS loose FROM entity GROUP BY 1", "entity")
def region_report(t: Load) -> DataFrame:
    """AGG-21."""
    rows = t("entity").select(F.col("entity_id").alias("row_id"), "region")
    matches = t("entity").filter("entity_id % 3 <> 0").select(F.col("entity_id").alias("row_id"), "entity_id", F.when(F.col("entity_id") % 3 == 1, "exact").otherwise("nfkc").alias("tier"))
    return workflow.region_report(matches, rows)


@query("yield_bounds", "SELECT region, count(*) FILTER (entity_id % 4 = 0) * 100.0::DOUBLE / count(*) AS certain, (count(*) FILTER (entity_id % 4 = 0) + count(*) FILTER (entity_id % 2 = 1)) * 100.0::DOUBLE / count(*) AS possible, (count(*) FILTER (entity_id % 4 = 0) + count(*) FILTER (entity_id % 2 = 1)) * 100.0::DOUBLE / count(*) >= 74 AS reachable FROM entity GROUP BY 1", "entity")
def yield_bounds(t: Load) -> DataFrame:
    """AGG-33: by region: entities with even ids are processed, every fourth succeeds."""
    per = t("entity").groupBy("region").agg(F.count_if(F.col("entity_id") % 2 == 0).alias("processed"), F.count_if(F.col("entity_id") % 4 == 0).alias("successes"), F.count("*").alias("total"))
    b = report.yield_bound(F.col("processed"), F.col("successes"), F.col("total"), 74.0)
    return per.select("region", *[b[n].alias(n) for n in ("certain", "possible", "reachable")])


@query("weekly_yield", """SELECT region, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week, count(DISTINCT o_custkey) AS selected, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS confirmed, count(DISTINCT CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN o_custkey END) AS parsed,
  round(count(DISTINCT CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN o_custkey END) * 100.0 / count(DISTINCT o_custkey), 4) AS strict_yield, round(count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) * 100.0 / count(DISTINCT o_custkey), 4) AS broad_yield
FROM orders JOIN entity ON o_custkey = entity_id GROUP BY 1, 2""", "entity")
def weekly_yield(t: Load) -> DataFrame:
    """AGG-35."""
    rows = t("orders").join(t("entity").select("entity_id", "region"), F.col("o_custkey") == F.col("entity_id"))
    rows = rows.select("region", "entity_id", F.col("o_orderdate").alias("at"), (F.col("o_orderstatus") == "F").alias("confirmed"), ((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 2 == 0)).alias("parsed"))
    return workflow.weekly_yield(rows, ["region"]).withColumn("week", F.col("week").cast("string"))


GROUPINGS = {"status": ("url", "document", "extract", "blocker"), "url_document": ("url", "document"), "document": ("document",), "host": ("host",), "source": ("method",), "owner": ("owner",), "yearly_rows": ("has_rows",), "low_confidence": ("low",)}
GROUPED = " UNION ALL ".join(f"SELECT '{n}' AS \"grouping\", concat_ws('|', {', '.join(g)}) AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM r), 6) AS share FROM r GROUP BY {', '.join(g)}" for n, g in GROUPINGS.items())


@query("yield_groupings", f"""WITH r AS (SELECT CASE c_custkey % 2 WHEN 0 THEN 'no_url' ELSE 'region_url' END AS url, CASE c_custkey % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'confirmed' ELSE '-' END AS document, c_mktsegment AS extract, 'b' || c_custkey % 4 AS blocker,
  'h' || c_custkey % 9 AS host, CASE c_custkey % 2 WHEN 0 THEN 'web' ELSE '-' END AS method, 'o' || c_custkey % 40 AS owner, (c_custkey % 5 = 0)::VARCHAR AS has_rows, (c_custkey % 7 = 0)::VARCHAR AS low FROM customer) {GROUPED}""")
def yield_groupings(t: Load) -> DataFrame:
    """AGG-32: all eight groupings."""
    k = F.col("c_custkey")
    text = lambda p, n: F.concat(F.lit(p), (k % n).cast("string"))
    rows = t("customer").select(
        by_case("c_custkey", "no_url", "region_url").alias("url"), by_case("c_custkey", "none", "confirmed", None).alias("document"), F.col("c_mktsegment").alias("extract"), text("b", 4).alias("blocker"), text("h", 9).alias("host"),
        by_case("c_custkey", "web", None).alias("method"), text("o", 40).alias("owner"), (k % 5 == 0).alias("has_rows"), (k % 7 == 0).alias("low"),
    )
    return workflow.yield_groupings(rows, GROUPINGS)


KNOWN = ("東京デザイン専門学校", "大阪美容専門学校(なんば校舎)", "京都調理専門学校", "神戸医療大学", "神戸医療専門学校")
MISSING = ("東京デザイン 専門学校", "京都調理専門学校(夜間)", "大阪美容専門学校", "東京デザイン学校", "京都調理専門学校山科校", "神戸医療", "なし", "大阪美容専門学校(梅田校舎)")
ALIASED = ("0 exact", "2 bracket", None, "0 suffix", None, None, None, None)


@query("template_aliases", f"SELECT s_suppkey AS left_id, {case_sql('s_suppkey', *ALIASED)} AS alias FROM supplier WHERE {case_sql('s_suppkey', *ALIASED)} IS NOT NULL")
def template_aliases(t: Load) -> DataFrame:
    """JOIN-14: branches, and names that two institutions share, are refused."""
    missing = t("supplier").select(F.col("s_suppkey").alias("left_id"), by_case("s_suppkey", *MISSING).alias("name"))
    known = t("region").limit(1).select(F.posexplode(F.array(*map(F.lit, KNOWN))).alias("right_id", "name"))
    out = resolve.template_aliases(missing, known)
    return out.select("left_id", F.concat_ws(" ", F.col("right_id").cast("string"), "tier").alias("alias"))


@query("attached_urls", "SELECT o_custkey % 5 AS sheet, o_orderkey * 2 AS pos, o_orderstatus || o_orderkey AS name, CASE WHEN o_orderkey % 3 <> 0 THEN 'u' || o_orderkey END AS url FROM orders")
def attached_urls(t: Load) -> DataFrame:
    """WIN-24: a name's row, and, but for every third, a row with its address below."""
    k, sheet = F.col("o_orderkey"), (F.col("o_custkey") % 5).alias("sheet")
    names = t("orders").select(sheet, (k * 2).alias("pos"), F.concat("o_orderstatus", k.cast("string")).alias("name"), F.lit(None).cast("string").alias("url"))
    urls = t("orders").filter(k % 3 != 0).select(sheet, (k * 2 + 1).alias("pos"), F.lit(None).cast("string").alias("name"), F.concat(F.lit("u"), k.cast("string")).alias("url"))
    return revision.attached(names.unionByName(urls), ["sheet"], "pos", "name", "url")


LISTS_SQL = """SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'domain is no host' WHEN 2 THEN 'owner is empty' ELSE '' END AS domain_errors, CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'unknown region;expected is no count' ELSE 'url is no address' END AS coverage_errors, s_suppkey % 5 <> 0 AS imported FROM supplier"""


@query("url_lists", LISTS_SQL)
def url_lists(t: Load) -> DataFrame:
    """SRC-28, SRC-29, UPD-20: three kinds of lists of addresses."""
    key, k = "s_suppkey", F.col("s_suppkey")
    s = t("supplier")
    domains = s.select(k.alias("row"), F.when(k % 4 != 2, F.col("s_name")).otherwise(" ").alias("owner"), by_case(key, "https://A.example.com/x", "no host", "b.example.com", "c.example.com").alias("domain"))
    # rows without an owner are one group, of which only the first is not listed before
    told = files.owner_domains(domains).select(F.col("row").alias("id"), F.array_join(F.filter("errors", lambda e: e != "owner is listed before"), ";").alias("domain_errors"))
    coverage = s.select(k.alias("row"), by_case(key, "ASIA", "NOWHERE", "ASIA").alias("region"), by_case(key, "https://a.b", "https://a.b", "a.b").alias("url"), by_case(key, "3", "-1", "4").alias("expected"))
    covered = files.region_coverage(coverage, t("region").select(F.col("r_name").alias("region"))).select(F.col("row").alias("id"), F.array_join("errors", ";").alias("coverage_errors"))
    good, bad = files.url_import(s.select(k.cast("string").alias("id"), F.col("s_name").alias("name"), F.when(k % 5 != 0, F.lit("https://a.b")).alias("url")))
    split = good.select(F.col("id").cast("long").alias("id"), F.lit(True).alias("imported")).unionByName(bad.select(F.col("id").cast("long").alias("id"), F.lit(False).alias("imported")))
    return told.join(covered, "id").join(split, "id")


@query("manual_entry_audit", "SELECT o_custkey || '/' || year(o_orderdate) AS target_id, '5' AS new_value, count(*) AS n FROM orders WHERE o_orderkey % 9 <> 0 GROUP BY ALL")
def manual_entry_audit(t: Load) -> DataFrame:
    """UPD-05, UPD-17."""
    entries = t("orders").select(F.col("o_orderkey").alias("entry_id"), F.col("o_custkey").alias("unit_id"), F.year("o_orderdate").alias("period"), F.lit(5).alias("enrollment"))
    rows = workflow.manual_entry_audit(entries, entries.filter("entry_id % 9 <> 0"), "me", F.lit("2026-01-01").cast("timestamp"))
    return rows.groupBy("target_id", "new_value").agg(F.count("*").alias("n"))


@query("top_statuses", "SELECT status, count(*) AS n FROM document WHERE status IS NOT NULL GROUP BY 1 ORDER BY n DESC, status LIMIT 4", "document")
def top_statuses(t: Load) -> DataFrame:
    """SORT-11."""
    return report.top_n(t("document").filter("status IS NOT NULL"), "status", 4)


PACKET_SQL = """WITH m AS (SELECT * FROM evidence WHERE entity_id = 7) SELECT 7::BIGINT AS entity_id, (SELECT count(*) FROM site WHERE entity_id = 7) AS sites, least(5, (SELECT count(*) FROM m WHERE reason NOT IN ('candidate_budget_dropped', 'candidate_budget_exhausted'))) AS told WHERE EXISTS (SELECT 1 FROM m)"""


@query("entity_packet", PACKET_SQL, "evidence", "site")
def entity_packet(t: Load) -> DataFrame:
    """AGG-52."""
    p = evidence.packet(t("evidence"), t("site"), 7)
    return p.select(F.lit(7).cast("long").alias("entity_id"), F.size("sites").cast("long").alias("sites"), F.size("evidence").cast("long").alias("told"))


@query("distinct_words", "SELECT p_partkey, array_to_string([p_brand] || list_filter([p_type], lambda x: x <> p_brand), ',') AS words FROM part")
def distinct_words(t: Load) -> DataFrame:
    """SET-06."""
    return t("part").select("p_partkey", F.array_join(workflow.distinct_in_order(F.array("p_brand", "p_type", "p_brand", "p_type")), ",").alias("words"))


@query("orphan_files", "SELECT 'f' || o_orderkey AS path FROM orders WHERE year(o_orderdate) < 1995 UNION ALL SELECT 'x' || c_custkey FROM customer")
def orphan_files(t: Load) -> DataFrame:
    """SET-09."""
    documents = t("orders").select(F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("path"), F.year("o_orderdate").alias("period"))
    files = documents.select("path").unionByName(t("customer").select(F.concat(F.lit("x"), F.col("c_custkey").cast("string")).alias("path")))
    return workflow.orphans(files, documents, 1995)


# --- state changes -----------------------------------------------------------------------------------------------

ENTRY_SQL = "WITH e AS (SELECT o_orderkey AS entry_id, o_custkey AS unit_id, year(o_orderdate) AS period, CASE WHEN o_orderkey % 9 = 0 THEN -1 ELSE o_orderkey % 50 END AS capacity FROM orders)"


@query("manual_entries", ENTRY_SQL + " SELECT unit_id, period, entry_id, capacity, 2 + row_number() OVER (PARTITION BY unit_id, period ORDER BY entry_id) AS revision, 0.94::DOUBLE AS confidence FROM e WHERE capacity >= 0")
def manual_entries(t: Load) -> DataFrame:
    """UPD-05: onto rows that have two revisions already."""
    o = t("orders").select(F.col("o_orderkey").alias("entry_id"), F.col("o_custkey").alias("unit_id"), F.year("o_orderdate").alias("period"), F.when(F.col("o_orderkey") % 9 == 0, -1).otherwise(F.col("o_orderkey") % 50).alias("capacity"))
    existing = o.select("unit_id", "period").distinct().withColumn("revision", F.lit(2))
    out = workflow.manual_entries(o.withColumns({"enrollment": F.lit(5), "dropout_rate": F.lit(0.1)}), existing)
    return out.select("unit_id", "period", "entry_id", "capacity", F.col("revision").cast("long").alias("revision"), F.round("confidence", 6).alias("confidence"))


@query("applied_codes", "SELECT c_custkey AS entity_id, CASE WHEN c_custkey % 2 = 0 THEN 'old' WHEN c_custkey % 3 = 0 THEN 'H' || c_custkey END AS code FROM customer")
def applied_codes(t: Load) -> DataFrame:
    """UPD-07."""
    c = t("customer").select(F.col("c_custkey").alias("entity_id"))
    matches = c.filter("entity_id % 3 = 0").withColumn("code", F.concat(F.lit("H"), F.col("entity_id").cast("string")))
    return workflow.applied_codes(c.withColumn("code", F.when(F.col("entity_id") % 2 == 0, "old")), matches)


DECISION_SQL = "SELECT o_orderkey, CASE k WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN 'a correction needs a value' WHEN 3 THEN 'only a correction has a value' ELSE 'unknown decision' END AS errors FROM (SELECT *, o_orderkey % 5 AS k FROM orders)"


@query("decision_errors", DECISION_SQL)
def decision_errors(t: Load) -> DataFrame:
    """UPD-11."""
    key = "o_orderkey"
    d = t("orders").select(key, by_case(key, "accepted", "corrected", "corrected", "excluded", "maybe").alias("decision"), by_case(key, None, "5", None, "6", None).alias("value"))
    good, bad = workflow.decided(d)
    return good.select(key, F.lit("").alias("errors")).unionByName(bad.select(key, F.array_join("errors", ",").alias("errors")))


OUTCOMES = ("accept_primary", "accept_external", "neither")


@query("effective_values", f"SELECT o_orderkey, {case_sql('o_orderkey', 'p', 'e', None)} AS value FROM orders")
def effective_values(t: Load) -> DataFrame:
    """UPD-10."""
    from veritab.operators.diff import effective_value

    return t("orders").select("o_orderkey", effective_value(by_case("o_orderkey", *OUTCOMES), F.lit("p"), F.lit("e"), F.lit(None).cast("string")).alias("value"))


@query("new_review_items", "SELECT CASE o_orderkey % 3 WHEN 0 THEN 'code_conflict' WHEN 1 THEN 'unmatched' ELSE 'other' END AS kind, o_orderkey AS target_id, (o_orderkey % 3)::INT AS priority, 'pending' AS status FROM orders WHERE o_orderkey % 4 <> 0")
def new_review_items(t: Load) -> DataFrame:
    """UPD-13."""
    c = t("orders").select(by_case("o_orderkey", "code_conflict", "unmatched", "other").alias("kind"), F.col("o_orderkey").alias("target_id"))
    return workflow.new_review_items(c, c.filter("target_id % 4 = 0"))


@query("routed_sites", "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'auto' WHEN 1 THEN 'review' ELSE 'reject' END AS lane, round(least(s_suppkey % 13, 10) / 10, 2) AS confidence FROM supplier")
def routed_sites(t: Load) -> DataFrame:
    """UPD-16."""
    lanes = workflow.routed(t("supplier").select("s_suppkey", (F.col("s_suppkey") % 13).cast("double").alias("score"), by_case("s_suppkey", "auto", "review", "reject").alias("decision")))
    parts = [df.select("s_suppkey", F.lit(name).alias("lane"), "confidence") for name, df in lanes.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


AUDIT_SQL = """SELECT c_custkey::VARCHAR AS target_id, c_mktsegment AS new_value, sha256('["set","customer","' || c_custkey || '",null,"' || c_mktsegment || '","2026-01-01 00:00:00"]') AS action_id FROM customer"""


@query("audit_rows", AUDIT_SQL)
def audit_rows(t: Load) -> DataFrame:
    """UPD-17."""
    rows = workflow.audit(t("customer"), "set", "customer", F.col("c_custkey"), F.lit(None), F.col("c_mktsegment"), "checked", "me", F.lit("2026-01-01").cast("timestamp"))
    return rows.select("target_id", "new_value", "action_id")


@query("missing_queue_items", "SELECT o_orderkey, 'pending' AS status FROM orders WHERE o_orderkey % 3 <> 0")
def missing_queue_items(t: Load) -> DataFrame:
    """STM-02."""
    return queues.missing_items(t("orders"), t("orders").filter("o_orderkey % 3 = 0"), "o_orderkey")


@query("stale_runs", "SELECT c_custkey AS run_id, c_custkey % 2 = 0 AND (c_custkey % 5 = 0 OR c_custkey % 100 < 40) AS stale FROM customer")
def stale_runs(t: Load) -> DataFrame:
    """STM-07: reported at the second of the id modulo 100, none for every fifth; it is second 100 now."""
    k = F.col("c_custkey")
    runs = t("customer").select(k.alias("run_id"), (k % 2 == 0).alias("running"), F.when(k % 5 != 0, (k % 100).cast("double")).alias("reported_at"))
    return queues.stale(runs, 100.0, 60.0).select("run_id", "stale")


@query("folded_documents", "SELECT doc_id, md5(coalesce(text, '')) AS folded FROM documents")
def folded_documents(t: Load) -> DataFrame:
    """NFKC over all documents, whose texts hold no compatibility letters."""
    return t("documents").select("doc_id", F.md5(folded(F.col("text"))).alias("folded"))


