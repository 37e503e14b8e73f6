"""Queries over the adapters, each with the SQL that it is held against where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.functions import numbers, payloads, periods, states, text, urls
from veritab.operators import diff, evaluate, evidence, export, records, report, resolve, revision, workflow
from veritab.plans.registry import ORACLE_SQL, QUERIES, Load, query
from veritab.plans.views import PERIOD
from veritab.streaming import queues

from veritab.plans import file_queries, form_queries, text_queries, work_queries  # noqa: F401  they register their queries

__all__ = ["ORACLE_SQL", "QUERIES"]


# --- keyed comparisons -------------------------------------------------------------------------------------------

FIVE_SQL = """
WITH e AS (SELECT entity, metric, count(*) AS n, first(value) AS v FROM expected GROUP BY ALL), a AS (SELECT entity, metric, count(*) AS n, first(value) AS v FROM actual GROUP BY ALL),
five AS (SELECT entity, metric, category, CASE WHEN category <> 'ambiguous_key' THEN ev END AS expected_value, CASE WHEN category <> 'ambiguous_key' THEN av END AS actual_value FROM (
  SELECT coalesce(e.entity, a.entity) AS entity, coalesce(e.metric, a.metric) AS metric, e.v AS ev, a.v AS av,
    CASE WHEN coalesce(e.n, 0) > 1 OR coalesce(a.n, 0) > 1 THEN 'ambiguous_key' WHEN a.n IS NULL THEN 'missing_actual' WHEN e.n IS NULL THEN 'unexpected_actual'
      WHEN abs(e.v - a.v) <= 5 OR (e.v IS NULL AND a.v IS NULL) THEN 'exact_match' ELSE 'value_mismatch' END AS category
  FROM e FULL JOIN a ON e.entity = a.entity AND e.metric IS NOT DISTINCT FROM a.metric))
"""
KEY = ("entity", "metric")


def _five(t: Load) -> DataFrame:
    return diff.five_way(t("expected"), t("actual"), KEY, 5)


@query("metric_diff_five_way", FIVE_SQL + "SELECT * FROM five", "expected", "actual")
def metric_diff_five_way(t: Load) -> DataFrame:
    return _five(t)


@query("metric_diff_summary", FIVE_SQL + "SELECT c AS category, count(category) AS n FROM (SELECT unnest(['exact_match','value_mismatch','missing_actual','unexpected_actual','ambiguous_key']) AS c) LEFT JOIN five ON category = c GROUP BY c", "expected", "actual")
def metric_diff_summary(t: Load) -> DataFrame:
    return diff.summary(_five(t), "category", diff.FIVE)


GATE = """, g AS (SELECT entity % 50 AS scope, count(*) FILTER (category = 'ambiguous_key' OR (metric = 'F' AND category <> 'exact_match')) AS gate_failures,
  count(*) FILTER (NOT (category = 'ambiguous_key' OR (metric = 'F' AND category <> 'exact_match')) AND metric IN ('O', 'P') AND category <> 'exact_match') AS reconciliations FROM five GROUP BY 1)
SELECT *, CASE WHEN gate_failures > 0 THEN 'fail' WHEN reconciliations > 0 THEN 'pass_with_reconciliation' ELSE 'pass' END AS status FROM g"""


@query("metric_gate", FIVE_SQL + GATE, "expected", "actual")
def metric_gate(t: Load) -> DataFrame:
    return diff.gate(_five(t).withColumn("scope", F.col("entity") % 50), ["scope"], ["F"], ["O", "P"])


@query("reconciliation_report", FIVE_SQL + "SELECT *, actual_value - expected_value AS delta, 'cross_source_delta' AS classification, 'needs_owner_decision' AS operator_decision FROM five WHERE metric IN ('O', 'P') AND category = 'value_mismatch'", "expected", "actual")
def reconciliation_report(t: Load) -> DataFrame:
    return diff.reconciliation_report(_five(t), ["O", "P"])


KEYS_SQL = """replace(entity, ' ', '') || '|' || category || '|' || replace(unit, ' ', '') || '|' || period || '|' || metric"""
PAIRS_SQL = f"""
WITH r AS (SELECT *, {KEYS_SQL} AS key FROM reviewed), o AS (SELECT *, {KEYS_SQL} AS key FROM external), rn AS (SELECT key, count(*) AS n FROM r GROUP BY key), xn AS (SELECT key, count(*) AS n FROM o GROUP BY key),
keys AS (SELECT coalesce(rn.key, xn.key) AS key, coalesce(rn.n, 0) AS rows_r, coalesce(xn.n, 0) AS rows_o FROM rn FULL JOIN xn ON rn.key = xn.key)
"""
COMPARE_SQL = PAIRS_SQL + """, rows AS (
  SELECT k.key, review_id, source_row, final_value AS primary_value, value AS external_value,
    CASE WHEN rows_r = 0 THEN 'missing_in_primary' WHEN review_status = 'excluded' THEN 'excluded_not_comparable' WHEN final_value IS NULL THEN 'needs_review_not_comparable'
      WHEN rows_o = 0 THEN 'missing_in_external' WHEN final_value = value THEN 'match' ELSE 'value_mismatch' END AS status, '' AS reason
  FROM keys k LEFT JOIN r ON r.key = k.key LEFT JOIN o ON o.key = k.key WHERE rows_r <= 1 AND rows_o <= 1
  UNION ALL BY NAME SELECT k.key, review_id, NULL::BIGINT AS source_row, final_value AS primary_value, NULL::VARCHAR AS external_value, 'ambiguous_key_not_comparable' AS status,
    concat_ws('; ', CASE WHEN rows_r > 1 THEN 'duplicate reviewed rows=' || rows_r END, CASE WHEN rows_o > 1 THEN 'duplicate external rows=' || rows_o END) AS reason FROM keys k JOIN r ON r.key = k.key WHERE rows_r > 1 OR rows_o > 1
  UNION ALL BY NAME SELECT k.key, NULL::BIGINT AS review_id, source_row, NULL::VARCHAR AS primary_value, value AS external_value, 'ambiguous_key_not_comparable' AS status,
    concat_ws('; ', CASE WHEN rows_r > 1 THEN 'duplicate reviewed rows=' || rows_r END, CASE WHEN rows_o > 1 THEN 'duplicate external rows=' || rows_o END) AS reason FROM keys k JOIN o ON o.key = k.key WHERE rows_r > 1 OR rows_o > 1
), labelled AS (SELECT *, CASE WHEN status = 'match' THEN 'TRUE' WHEN status IN ('value_mismatch', 'missing_in_primary', 'missing_in_external') THEN 'FALSE' ELSE '' END AS result FROM rows)
"""


@query("double_check_compare", COMPARE_SQL + "SELECT * FROM labelled", "reviewed", "external")
def double_check_compare(t: Load) -> DataFrame:
    return diff.compare_external(t("reviewed"), t("external"))


@query("double_check_summary", COMPARE_SQL + "SELECT c AS status, count(status) AS n FROM (SELECT unnest(['match','value_mismatch','missing_in_primary','missing_in_external','ambiguous_key_not_comparable','needs_review_not_comparable','excluded_not_comparable']) AS c) LEFT JOIN labelled ON status = c GROUP BY c", "reviewed", "external")
def double_check_summary(t: Load) -> DataFrame:
    return diff.summary(diff.compare_external(t("reviewed"), t("external")), "status", diff.SEVEN_EXTERNAL)


@query("master_diff_seven_way", PAIRS_SQL + """
SELECT k.key, review_id, final_value AS extracted_value, value AS expected_value,
  CASE WHEN rows_r = 0 THEN 'missing_in_extraction' WHEN review_status = 'excluded' THEN 'excluded_not_comparable' WHEN final_value IS NULL THEN 'needs_review_not_comparable'
    WHEN rows_o = 0 THEN 'missing_in_master' WHEN final_value = value THEN 'match' ELSE 'value_mismatch' END AS status, '' AS reason
FROM keys k LEFT JOIN r ON r.key = k.key LEFT JOIN o ON o.key = k.key WHERE rows_r <= 1 AND rows_o <= 1
UNION ALL BY NAME SELECT k.key, review_id, final_value AS extracted_value, CASE WHEN rows_o = 1 THEN (SELECT min(value) FROM o WHERE o.key = k.key) END AS expected_value, 'ambiguous_key' AS status,
  concat_ws('; ', CASE WHEN rows_r > 1 THEN 'duplicate reviewed rows=' || rows_r END, CASE WHEN rows_o > 1 THEN 'duplicate master rows=' || rows_o END) AS reason FROM keys k JOIN r ON r.key = k.key WHERE rows_r > 1 OR rows_o > 1
UNION ALL BY NAME SELECT k.key, NULL::BIGINT AS review_id, NULL::VARCHAR AS extracted_value, value AS expected_value, 'ambiguous_key' AS status, 'duplicate master rows=' || rows_o AS reason
  FROM keys k JOIN o ON o.key = k.key WHERE rows_r = 0 AND rows_o > 1""", "reviewed", "external")
def master_diff_seven_way(t: Load) -> DataFrame:
    return diff.diff_master(t("reviewed"), t("external"))


def _sides(t: Load) -> tuple[DataFrame, DataFrame]:
    part = t("part").select((F.col("p_size") % 5).alias("scope"), F.concat_ws(" ", "p_type", F.when(F.col("p_partkey") % 3 != 0, F.col("p_partkey").cast("string").substr(-2, 2))).alias("unit"), F.col("p_brand").alias("category"), "p_partkey")
    return part.filter("p_partkey % 2 = 0"), part.filter("p_partkey % 2 = 1")


ALIGN_SQL = """
WITH p AS (SELECT p_size % 5 AS scope, concat_ws(' ', p_type, CASE WHEN p_partkey % 3 <> 0 THEN right(p_partkey::VARCHAR, 2) END) AS unit, p_brand AS category, p_partkey FROM part), e AS (SELECT * FROM p WHERE p_partkey % 2 = 0), a AS (SELECT * FROM p WHERE p_partkey % 2 = 1),
ec AS (SELECT scope, unit, list_sort(list(DISTINCT category)) AS c FROM e GROUP BY ALL), ac AS (SELECT scope, unit, list_sort(list(DISTINCT category)) AS c FROM a GROUP BY ALL),
b AS (SELECT coalesce(ec.scope, ac.scope) AS scope, coalesce(ec.unit, ac.unit) AS unit, coalesce(ec.c, []) AS ecs, coalesce(ac.c, []) AS acs FROM ec FULL JOIN ac ON ec.scope = ac.scope AND ec.unit = ac.unit)
"""


@query("align_category_keys", ALIGN_SQL + "SELECT p_partkey, CASE WHEN len(ecs) <= 1 AND len(acs) <= 1 THEN '*' ELSE category END || '|' || p.unit AS aligned FROM p JOIN b ON p.scope = b.scope AND p.unit = b.unit")
def align_category_keys(t: Load) -> DataFrame:
    e, a, _ = diff.align_categories(*_sides(t), ["scope"])
    return e.unionByName(a).select("p_partkey", "aligned")


# every part stands in the unit of its type, as in ALIGN_SQL, and in one that it shares with its neighbour, the other side
DELTA_SQL = ALIGN_SQL.replace(" FROM part), e AS", " FROM part UNION ALL SELECT (p_partkey // 2) % 5 AS scope, (p_partkey // 2)::VARCHAR AS unit, p_brand AS category, p_partkey FROM part), e AS")


@query("category_deltas", DELTA_SQL + "SELECT scope, unit, ecs[1] AS expected_category, acs[1] AS actual_category FROM b WHERE len(ecs) = 1 AND len(acs) = 1 AND ecs[1] <> acs[1]")
def category_deltas(t: Load) -> DataFrame:
    """JOIN-04: the units of all parts' types, and neighbouring parts as the two sides of a unit, most of another brand."""
    half = F.floor(F.col("p_partkey") / 2)
    part = t("part").select((half % 5).alias("scope"), half.cast("string").alias("unit"), F.col("p_brand").alias("category"), "p_partkey")
    of_type, pairs = _sides(t), (part.filter("p_partkey % 2 = 0"), part.filter("p_partkey % 2 = 1"))
    return diff.align_categories(*[x.unionByName(y) for x, y in zip(of_type, pairs, strict=True)], ["scope"])[2]


@query("key_collisions", ALIGN_SQL + "SELECT scope, unit, array_to_string(c, ',') AS categories, 'master' AS side FROM ec WHERE len(c) > 1 UNION ALL SELECT scope, unit, array_to_string(c, ',') AS categories, 'document' AS side FROM ac WHERE len(c) > 1")
def key_collisions(t: Load) -> DataFrame:
    e, a = _sides(t)
    return diff.key_collisions(e, ["scope"], "master").unionByName(diff.key_collisions(a, ["scope"], "document"))


def _nation(t: Load, changed: bool) -> DataFrame:
    n = t("nation").withColumn("row", F.col("n_nationkey").cast("int"))
    if changed:
        n = n.filter("n_nationkey <> 3").withColumn("n_name", F.when(F.col("n_nationkey") % 7 == 0, F.concat("n_name", F.lit("*"))).otherwise(F.col("n_name"))).withColumn("n_regionkey", F.when(F.col("n_nationkey") == 5, 9).otherwise(F.col("n_regionkey")))
    return n


NATION_SQL = """WITH o AS (SELECT n_nationkey, n_name, n_regionkey::VARCHAR AS n_regionkey FROM nation),
n AS (SELECT n_nationkey, CASE WHEN n_nationkey % 7 = 0 THEN n_name || '*' ELSE n_name END AS n_name, CASE WHEN n_nationkey = 5 THEN '9' ELSE n_regionkey::VARCHAR END AS n_regionkey FROM nation WHERE n_nationkey <> 3)"""


@query("cell_diff", NATION_SQL + """, oc AS (UNPIVOT (SELECT n_nationkey AS row, n_name, n_regionkey FROM o) ON n_name, n_regionkey INTO NAME col VALUE value),
nc AS (UNPIVOT (SELECT n_nationkey AS row, n_name, n_regionkey FROM n) ON n_name, n_regionkey INTO NAME col VALUE value)
SELECT 'nation' AS sheet, coalesce(nc.row, oc.row) AS row, coalesce(nc.col, oc.col) AS col, nc.value AS new_value, oc.value AS old_value,
  CASE WHEN nc.value IS NULL THEN 'missing' WHEN oc.value IS NULL THEN 'extra' WHEN try_cast(nc.value AS DOUBLE) IS NOT NULL AND try_cast(oc.value AS DOUBLE) IS NOT NULL THEN 'numeric' ELSE 'text' END AS kind
FROM nc FULL JOIN oc ON nc.row = oc.row AND nc.col = oc.col WHERE nc.value IS DISTINCT FROM oc.value""")
def cell_diff(t: Load) -> DataFrame:
    new, old = (diff.cells(_nation(t, c), F.lit("nation"), F.col("row"), ["n_name", "n_regionkey"]) for c in (True, False))
    return diff.cell_diff(new, old)


@query("business_diff", NATION_SQL + """, oc AS (UNPIVOT (SELECT n_name, n_nationkey::VARCHAR AS n_nationkey, n_regionkey FROM o) ON n_nationkey, n_regionkey INTO NAME field VALUE value),
nc AS (UNPIVOT (SELECT n_name, n_nationkey::VARCHAR AS n_nationkey, n_regionkey FROM n) ON n_nationkey, n_regionkey INTO NAME field VALUE value)
SELECT coalesce(nc.n_name, oc.n_name) AS n_name, coalesce(nc.field, oc.field) AS field, nc.value AS new_value, oc.value AS old_value,
  CASE WHEN oc.field IS NULL THEN 'extra_row' WHEN nc.field IS NULL THEN 'missing_row' ELSE 'numeric' END AS kind, FALSE AS soft_match
FROM nc FULL JOIN oc ON nc.n_name = oc.n_name AND nc.field = oc.field WHERE nc.value IS DISTINCT FROM oc.value""")
def business_diff(t: Load) -> DataFrame:
    return diff.business_diff(_nation(t, True), _nation(t, False), ["n_name"], ["n_nationkey", "n_regionkey"])


@query("sheet_row_counts", "SELECT coalesce(a.s, b.s) AS sheet, coalesce(a.n, 0) AS new_rows, coalesce(b.n, 0) AS old_rows FROM (SELECT o_orderpriority AS s, count(*) AS n FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1) a FULL JOIN (SELECT o_orderpriority AS s, count(*) AS n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1) b ON a.s = b.s")
def sheet_row_counts(t: Load) -> DataFrame:
    o = t("orders").withColumnRenamed("o_orderpriority", "sheet")
    return diff.row_counts(o.filter("o_orderkey % 3 = 0"), o.filter("sheet <> '5-LOW'"))


@query("duplicate_business_keys", "SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1")
def duplicate_business_keys(t: Load) -> DataFrame:
    return diff.duplicate_keys(t("part"), ["p_brand", "p_size"])


@query("resolution_values", "SELECT review_id, CASE review_status WHEN 'accepted' THEN final_value WHEN 'corrected' THEN '0' END AS effective, review_status = 'corrected' OR (review_status = 'accepted' AND review_id % 10 >= 5) AS ready FROM reviewed", "reviewed")
def resolution_values(t: Load) -> DataFrame:
    s = F.col("review_status")
    return t("reviewed").select("review_id", diff.final_value(s, F.col("final_value"), F.lit("0")).alias("effective"), diff.final_ready(s, F.when(F.col("review_id") % 10 >= 5, 0.9).otherwise(0.5)).alias("ready"))


@query("resolution_errors", "SELECT review_id, concat_ws('; ', CASE WHEN review_status = 'corrected' AND final_value IS NULL THEN 'a correction needs a value' END, CASE WHEN review_status <> 'corrected' AND final_value IS NOT NULL THEN 'only a correction has a value' END) AS errors FROM reviewed", "reviewed")
def resolution_errors(t: Load) -> DataFrame:
    outcome = F.when(F.col("review_status") == "corrected", "correct").otherwise("accept_primary")
    return t("reviewed").select("review_id", F.array_join(diff.resolution_errors(outcome, F.col("final_value"), F.lit("x"), F.lit("checked")), "; ").alias("errors"))


# --- revisions ---------------------------------------------------------------------------------------------------

@query("revision_current", "SELECT entity_id, period, position, status, row_number() OVER (PARTITION BY entity_id, period ORDER BY position) AS revision FROM yearly_status QUALIFY row_number() OVER (PARTITION BY entity_id, period ORDER BY position DESC) = 1", "yearly_status")
def revision_current(t: Load) -> DataFrame:
    return revision.numbered(t("yearly_status"), ["entity_id", "period"], ["position"]).filter("is_current").drop("is_current")


@query("revision_appended", """WITH a AS (SELECT *, row_number() OVER (PARTITION BY entity_id, period ORDER BY position) AS revision FROM yearly_status WHERE position % 2 = 0), m AS (SELECT entity_id, period, max(revision) AS top FROM a GROUP BY ALL)
SELECT y.entity_id, y.period, position, status, coalesce(top, 0) + row_number() OVER (PARTITION BY y.entity_id, y.period ORDER BY position) AS revision, row_number() OVER (PARTITION BY y.entity_id, y.period ORDER BY position DESC) = 1 AS is_current
FROM yearly_status y LEFT JOIN m ON y.entity_id = m.entity_id AND y.period = m.period WHERE position % 2 = 1""", "yearly_status")
def revision_appended(t: Load) -> DataFrame:
    rows = t("yearly_status")
    old = revision.numbered(rows.filter("position % 2 = 0"), ["entity_id", "period"], ["position"])
    return revision.appended(old, rows.filter("position % 2 = 1"), ["entity_id", "period"], ["position"])


@query("revision_latest_decision", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def revision_latest_decision(t: Load) -> DataFrame:
    return revision.latest(t("events").select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"])


@query("decisions_overlaid", "SELECT r.review_id, coalesce(d.review_status, r.review_status) AS review_status FROM reviewed r LEFT JOIN (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS review_id, 'accepted' AS review_status FROM lineitem WHERE l_partkey % 4 = 0) d ON r.review_id = d.review_id", "reviewed")
def decisions_overlaid(t: Load) -> DataFrame:
    d = t("lineitem").filter("l_partkey % 4 = 0").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("review_id"), F.lit("accepted").alias("review_status"), F.lit(1).alias("revision"))
    return revision.overlaid(t("reviewed").select("review_id", "review_status"), d, ["review_id"], ["revision"], ["review_status"])


@query("carry_forward_merge", """WITH a AS (SELECT user_id, event_type, max(value) AS value, max(CASE WHEN event_id % 3 = 0 THEN event_id END) AS mark FROM events WHERE event_id % 2 = 0 GROUP BY ALL),
b AS (SELECT user_id, event_type, max(CASE WHEN event_id % 5 <> 0 THEN value END) AS value, max(CASE WHEN event_id % 3 = 0 THEN event_id END) AS mark FROM events WHERE event_id % 2 = 1 GROUP BY ALL)
SELECT b.user_id, b.event_type, coalesce(b.value, a.value) AS value, coalesce(b.mark, a.mark) AS mark FROM b LEFT JOIN a ON a.user_id = b.user_id AND a.event_type = b.event_type""")
def carry_forward_merge(t: Load) -> DataFrame:
    def side(odd: int, value: F.Column) -> DataFrame:
        return t("events").filter(F.col("event_id") % 2 == odd).groupBy("user_id", "event_type").agg(F.max(value).alias("value"), F.max(F.when(F.col("event_id") % 3 == 0, F.col("event_id"))).alias("mark"))

    return revision.carried(side(0, F.col("value")), side(1, F.when(F.col("event_id") % 5 != 0, F.col("value"))), ["user_id", "event_type"], ["value", "mark"])


@query("noop_detection", "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 8 = 0")
def noop_detection(t: Load) -> DataFrame:
    o = t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 10 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return revision.changed(o.filter("o_orderkey % 8 <> 0"), new, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query("hash_dedupe_keep_first", "SELECT doc_id, sha256(text) AS digest, CASE WHEN row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1 THEN 'keep' WHEN lang = 'en' THEN 'leave' ELSE 'demote' END AS verdict FROM documents")
def hash_dedupe_keep_first(t: Load) -> DataFrame:
    d = t("documents").select("doc_id", "lang", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    return revision.kept_hashes(d, "digest", "doc_id", F.col("lang") == "en").select("doc_id", "digest", "verdict")


@query("hash_twins", "SELECT doc_id, twin_id, inherited_status FROM (SELECT doc_id, first_value(doc_id) OVER w AS twin_id, first_value(source) OVER w AS inherited_status FROM documents WINDOW w AS (PARTITION BY sha256(text) ORDER BY doc_id)) WHERE doc_id <> twin_id")
def hash_twins(t: Load) -> DataFrame:
    return revision.twins(t("documents").withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)), "digest", "doc_id", "source")


@query("period_override", """WITH moved AS (SELECT * FROM fact WHERE document_id % 50 = 0 AND period <> 1998), base AS (SELECT unit_id, period, max(1) AS top FROM fact WHERE period = 1998 GROUP BY ALL),
added AS (SELECT m.unit_id, 1998 AS period, coalesce(top, 0) + row_number() OVER (PARTITION BY m.unit_id ORDER BY m.period) AS revision, m.period AS came FROM moved m LEFT JOIN base b ON b.unit_id = m.unit_id),
rest AS (SELECT unit_id, period, 1 AS revision, document_id % 50 = 0 AND period <> 1998 AS demoted FROM fact)
SELECT unit_id, period, count(*) AS revisions, count(*) FILTER (is_current) AS current_rows FROM (SELECT unit_id, period, NOT demoted AND revision = max(CASE WHEN NOT demoted THEN revision END) OVER (PARTITION BY unit_id, period) AS is_current FROM (SELECT unit_id, period, revision, demoted FROM rest UNION ALL SELECT unit_id, period, revision, FALSE FROM added)) GROUP BY ALL""", "fact")
def period_override(t: Load) -> DataFrame:
    facts, _ = revision.overridden(t("fact").withColumn("revision", F.lit(1)), F.col("document_id") % 50 == 0, 1998, "checked")
    return facts.groupBy("unit_id", "period").agg(F.count("*").alias("revisions"), F.count_if("is_current").alias("current_rows"))


UNIT_SQL = """WITH units AS (SELECT p_partkey AS unit_id, p_brand AS owner, CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size % 10 END AS code FROM part),
s AS (SELECT unit_id, min(unit_id) OVER (PARTITION BY owner, code) AS survivor_id FROM units),
kids AS (SELECT l_partkey AS unit_id, year(l_shipdate) AS period, max(l_orderkey) AS mark FROM lineitem GROUP BY ALL)"""


@query("merged_units", UNIT_SQL + " SELECT survivor_id AS unit_id, period, mark FROM kids JOIN s USING (unit_id) QUALIFY row_number() OVER (PARTITION BY survivor_id, period ORDER BY CASE WHEN unit_id = survivor_id THEN 0 ELSE 1 END, unit_id) = 1")
def merged_units(t: Load) -> DataFrame:
    units = t("part").select(F.col("p_partkey").alias("unit_id"), F.col("p_brand").alias("owner"), F.nullif(F.col("p_size") % 10, F.lit(0)).alias("code"))
    kids = t("lineitem").groupBy(F.col("l_partkey").alias("unit_id"), F.year("l_shipdate").alias("period")).agg(F.max("l_orderkey").alias("mark"))
    return revision.merged_units(units, kids, ["owner", "code"], ["period"])[1].select("unit_id", "period", "mark")


@query("forward_fill", "SELECT event_id, last_value(CASE WHEN event_id % 4 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS filled FROM events")
def forward_fill(t: Load) -> DataFrame:
    e = t("events").select("user_id", "event_id", F.when(F.col("event_id") % 4 == 0, F.col("event_type")).alias("filled"))
    return revision.filled(e, ["user_id"], ["event_id"], "filled").select("event_id", "filled")


@query("gap_blocks", "SELECT event_id, sum(jump) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS block FROM (SELECT user_id, event_id, CASE WHEN event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) > 50 THEN 1 ELSE 0 END AS jump FROM events)")
def gap_blocks(t: Load) -> DataFrame:
    return revision.blocks(t("events"), ["user_id"], "event_id", 50).select("event_id", "block")


@query("first_seen_rows", "SELECT l_suppkey, l_shipdate, l_orderkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_orderkey * 10 + l_linenumber) = 1")
def first_seen_rows(t: Load) -> DataFrame:
    rows = t("lineitem").withColumn("position", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return revision.first_seen(rows, ["l_suppkey", "l_shipdate"], "position").select("l_suppkey", "l_shipdate", "l_orderkey")


@query("candidate_dedupe", "SELECT user_id, arg_max(event_id, value * 1e9 - event_id) AS best, min(event_id) AS position FROM (SELECT user_id, event_id, (event_id % 3)::DOUBLE AS value FROM events) GROUP BY user_id")
def candidate_dedupe(t: Load) -> DataFrame:
    e = t("events").select("user_id", F.col("event_id").alias("position"), F.col("event_id").alias("best"), (F.col("event_id") % 3).alias("weight"))
    return revision.best_duplicate(e, ["user_id"], ["weight"], "position").select("user_id", "best", "position")


@query("voided_events", "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND event_id % 60 = 0)")
def voided_events(t: Load) -> DataFrame:
    return revision.without_voided(t("events").select("event_id", "user_id"), t("events").filter("event_type = 'error' AND event_id % 60 = 0"), "user_id").select("event_id", "user_id")


# --- entity resolution -------------------------------------------------------------------------------------------

def _names(t: Load) -> tuple[DataFrame, DataFrame]:
    left = t("entity").select(F.col("entity_id").alias("left_id"), F.when(F.col("entity_id") % 3 == 0, F.replace("name", F.lit("#"), F.lit(" # "))).when(F.col("entity_id") % 5 == 0, F.concat(F.lit("学校法人"), "name")).when(F.col("entity_id") % 7 == 0, F.concat("name", F.lit("xy"))).otherwise(F.col("name")).alias("name"), "region")
    right = t("entity").filter("entity_id % 11 <> 0").select(F.col("entity_id").alias("right_id"), "name", "region")
    return left, right


NAMES_SQL = """WITH l AS (SELECT entity_id AS left_id, CASE WHEN entity_id % 3 = 0 THEN replace(name, '#', ' # ') WHEN entity_id % 5 = 0 THEN '学校法人' || name WHEN entity_id % 7 = 0 THEN name || 'xy' ELSE name END AS name, region FROM entity),
r AS (SELECT entity_id AS right_id, name, region FROM entity WHERE entity_id % 11 <> 0),
t1 AS (SELECT left_id, right_id, 'exact' AS tier FROM l JOIN r ON l.name = r.name QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY right_id) = 1),
t2 AS (SELECT left_id, right_id, 'normalised' AS tier FROM l JOIN r ON replace(l.name, ' ', '') = replace(r.name, ' ', '') WHERE left_id NOT IN (SELECT left_id FROM t1) QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY right_id) = 1),
t3 AS (SELECT left_id, right_id, 'without_owner' AS tier FROM l JOIN r ON regexp_replace(replace(l.name, ' ', ''), '^学校法人', '') = r.name AND l.region = r.region WHERE left_id NOT IN (SELECT left_id FROM t1 UNION SELECT left_id FROM t2) QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY right_id) = 1),
m AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3),
t4 AS (SELECT left_id, right_id, 'containment' AS tier FROM l JOIN r ON l.region = r.region AND (contains(l.name, r.name) OR contains(r.name, l.name)) AND least(length(l.name), length(r.name)) / greatest(length(l.name), length(r.name)) >= 0.7
  WHERE left_id NOT IN (SELECT left_id FROM m) QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY least(length(l.name), length(r.name)) / greatest(length(l.name), length(r.name)) DESC, right_id) = 1),
matched AS (SELECT * FROM m UNION ALL SELECT * FROM t4)"""
TIERS = [("exact", lambda c: c, False), ("normalised", text.squeezed, False), ("without_owner", text.without_owner, True)]


@query("tiered_name_match", NAMES_SQL + " SELECT * FROM matched", "entity")
def tiered_name_match(t: Load) -> DataFrame:
    return resolve.tiered(*_names(t), TIERS, least=0.7)


@query("unconflicted_matches", NAMES_SQL + " SELECT left_id, right_id, tier FROM (SELECT *, count(*) OVER (PARTITION BY right_id) AS n FROM matched) WHERE n = 1 AND tier IN ('exact', 'normalised')", "entity")
def unconflicted_matches(t: Load) -> DataFrame:
    return resolve.unconflicted(resolve.tiered(*_names(t), TIERS, least=0.7), ["exact", "normalised"])


@query("unique_suffix_match", """WITH r AS (SELECT p_partkey AS right_id, p_name || p_partkey || CASE p_partkey % 3 WHEN 0 THEN '専門学校' WHEN 1 THEN '学校' ELSE '' END AS name FROM part WHERE p_partkey % 4 <> 0), l AS (SELECT p_partkey AS left_id, p_name || p_partkey AS name FROM part),
x AS (SELECT replace(name, ' ', '') AS k, count(DISTINCT right_id) AS n, min(right_id) AS right_id FROM r GROUP BY 1 HAVING count(DISTINCT right_id) = 1), h AS (SELECT left_id, x.right_id, 'exact' AS tier FROM l JOIN x ON replace(l.name, ' ', '') = x.k),
y AS (SELECT regexp_replace(replace(name, ' ', ''), '(専門学校|学校)$', '') AS k, min(right_id) AS right_id FROM r GROUP BY 1 HAVING count(DISTINCT right_id) = 1)
SELECT * FROM h UNION ALL SELECT left_id, y.right_id, 'suffix' AS tier FROM l JOIN y ON replace(l.name, ' ', '') = y.k WHERE left_id NOT IN (SELECT left_id FROM h)""")
def unique_suffix_match(t: Load) -> DataFrame:
    ending = F.when(F.col("p_partkey") % 3 == 0, "専門学校").when(F.col("p_partkey") % 3 == 1, "学校").otherwise("")
    right = t("part").filter("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("right_id"), F.concat("p_name", "p_partkey", ending).alias("name"))
    return resolve.unique_match(t("part").select(F.col("p_partkey").alias("left_id"), F.concat("p_name", "p_partkey").alias("name")), right, [("exact", text.squeezed), ("suffix", text.institution_key)])


@query("containment_match_blocked", """WITH l AS (SELECT s_suppkey AS left_id, s_nationkey % 5 AS block, replace(s_name, 'Supplier', '') AS name FROM supplier), r AS (SELECT s_suppkey AS right_id, s_nationkey % 5 AS block, s_name AS name FROM supplier)
SELECT left_id, min(right_id) AS right_id FROM l JOIN r ON l.block = r.block AND (contains(r.name, l.name) OR contains(l.name, r.name)) WHERE length(l.name) >= 4 GROUP BY left_id HAVING count(DISTINCT right_id) = 1""")
def containment_match_blocked(t: Load) -> DataFrame:
    s = t("supplier").withColumn("block", F.col("s_nationkey") % 5)
    left = s.select(F.col("s_suppkey").alias("left_id"), "block", F.replace("s_name", F.lit("Supplier"), F.lit("")).alias("name"))
    return resolve.unique_containment(left, s.select(F.col("s_suppkey").alias("right_id"), "block", F.col("s_name").alias("name")), "block", lambda c: c, 4).select("left_id", "right_id")


GREEDY_SQL = """WITH e AS (SELECT s_suppkey AS entity_id, 'N' || (s_suppkey % 30) || CASE WHEN s_suppkey % 4 = 0 THEN 'branch' ELSE '' END AS name, s_nationkey % 5 AS region FROM supplier),
g AS (SELECT s_suppkey AS code, 'N' || (s_suppkey % 30) || CASE WHEN s_suppkey % 6 = 0 THEN 'branch!' ELSE '' END AS name, s_nationkey % 5 AS region, s_suppkey AS position FROM supplier WHERE s_suppkey % 3 <> 1),
f AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY name, region ORDER BY position) = 1), x AS (SELECT code, min(entity_id) AS entity_id FROM e JOIN f USING (name, region) WHERE code % 7 <> 0 GROUP BY code),
p AS (SELECT e.entity_id, g.code, g.position, least(length(e.name), length(g.name)) / greatest(length(e.name), length(g.name)) AS score FROM e JOIN g ON e.region = g.region AND (contains(e.name, g.name) OR contains(g.name, e.name)) LEFT JOIN x ON x.code = g.code
  WHERE e.entity_id NOT IN (SELECT entity_id FROM x) AND g.code % 7 <> 0 AND (x.entity_id IS NULL OR x.entity_id > e.entity_id)),
b AS (SELECT * FROM p WHERE score >= 0.6 QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY score DESC, position) = 1)
SELECT entity_id, code, 'exact' AS tier FROM x UNION ALL SELECT entity_id, code, 'containment' FROM b"""


@query("greedy_code_assign", GREEDY_SQL)
def greedy_code_assign(t: Load) -> DataFrame:
    s = t("supplier").withColumns({"region": F.col("s_nationkey") % 5, "stem": F.concat(F.lit("N"), (F.col("s_suppkey") % 30).cast("string"))})
    e = s.select(F.col("s_suppkey").alias("entity_id"), F.concat("stem", F.when(F.col("s_suppkey") % 4 == 0, "branch").otherwise("")).alias("name"), "region")
    g = s.filter("s_suppkey % 3 <> 1").select(F.col("s_suppkey").alias("code"), F.concat("stem", F.when(F.col("s_suppkey") % 6 == 0, "branch!").otherwise("")).alias("name"), "region", F.col("s_suppkey").alias("position"))
    return resolve.greedy_codes(e, g, s.filter("s_suppkey % 7 = 0").select(F.col("s_suppkey").alias("code")))


@query("code_set_difference", "SELECT c_custkey + 100 AS code FROM customer EXCEPT SELECT o_custkey FROM orders")
def code_set_difference(t: Load) -> DataFrame:
    return resolve.set_difference(t("customer").select((F.col("c_custkey") + 100).alias("code")), t("orders").select(F.col("o_custkey").alias("code")), "code")


@query("duplicate_codes", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def duplicate_codes(t: Load) -> DataFrame:
    return diff.duplicate_keys(t("orders"), ["o_custkey"])


@query("alias_proposals", "WITH k AS (SELECT regexp_replace(replace(p_name, ' ', ''), '[0-9]+$', '') AS k, p_partkey AS right_id FROM part WHERE p_partkey % 9 = 0), h AS (SELECT p_partkey AS left_id, count(DISTINCT right_id) AS matches, min(right_id) AS right_id FROM part LEFT JOIN k ON regexp_replace(replace(p_name, ' ', ''), '[0-9]+$', '') = k.k GROUP BY 1) SELECT *, CASE WHEN matches = 0 THEN 'no_candidate' WHEN matches = 1 THEN 'auto_alias' ELSE 'ambiguous' END AS proposal FROM h")
def alias_proposals(t: Load) -> DataFrame:
    p = t("part")
    return resolve.proposals(p.select(F.col("p_partkey").alias("left_id"), F.col("p_name").alias("name")), p.filter("p_partkey % 9 = 0").select(F.col("p_partkey").alias("right_id"), F.col("p_name").alias("name")), lambda c: F.regexp_replace(text.squeezed(c), "[0-9]+$", ""))


#: Six units of each entity as they are known, and as they are missing: swapped endings, parts, long vowels, or nothing.
KNOWN_UNITS = ("デザイン#学科", "情報処理#科", "コンピュータ#専攻", "Ｗｅｂ 制作#学科", "看護", "ビューティ#コース")
MISSING_UNITS = ("デザイン#科", "情報処理#", "コンピューター#専攻", "Web制作#科(昼)", "看護学科", "音楽#")
UNITS_SQL = f"""WITH u AS (SELECT c_custkey AS id, c_custkey // 6 AS entity_id, replace({text_queries.case_sql('c_custkey', *KNOWN_UNITS)}, '#', (c_custkey // 6 % 97)::VARCHAR) AS known, replace({text_queries.case_sql('c_custkey', *MISSING_UNITS)}, '#', (c_custkey // 6 % 97)::VARCHAR) AS missing FROM customer),
r AS (SELECT id AS right_id, entity_id, replace(replace(known, 'Ｗｅｂ', 'Web'), ' ', '') AS d FROM u), l AS (SELECT id AS left_id, entity_id, missing AS t FROM u),
v AS (SELECT left_id, entity_id, t AS v FROM l UNION SELECT left_id, entity_id, regexp_replace(t, '学科$', '科') FROM l WHERE t LIKE '%学科' UNION SELECT left_id, entity_id, regexp_replace(t, '科$', '学科') FROM l WHERE t LIKE '%科'),
h AS (SELECT left_id, right_id, 0 AS turn FROM v JOIN r ON v.entity_id = r.entity_id AND v = d UNION SELECT left_id, right_id, 1 FROM v JOIN r ON v.entity_id = r.entity_id AND length(v) >= 4 AND (contains(v, d) OR contains(d, v))
  UNION SELECT left_id, right_id, 2 FROM l JOIN r ON l.entity_id = r.entity_id AND regexp_replace(t, '[ーイィ]', '', 'g') = regexp_replace(d, '[ーイィ]', '', 'g')),
b AS (SELECT left_id, right_id, min(turn) AS turn FROM h GROUP BY ALL)
SELECT left_id, right_id, ['suffix', 'part', 'kana'][turn + 1] AS tier FROM b QUALIFY turn = min(turn) OVER (PARTITION BY left_id)"""


@query("unit_aliases", UNITS_SQL)
def unit_aliases(t: Load) -> DataFrame:
    """JOIN-15."""
    e = F.floor(F.col("c_custkey") / 6)
    named = lambda names: F.replace(text_queries.by_case("c_custkey", *names), F.lit("#"), (e % 97).cast("string"))
    c = t("customer").select("c_custkey", e.alias("entity_id"), named(KNOWN_UNITS).alias("known"), named(MISSING_UNITS).alias("missing"))
    return resolve.unit_aliases(c.select(F.col("c_custkey").alias("left_id"), "entity_id", F.col("missing").alias("name")), c.select(F.col("c_custkey").alias("right_id"), "entity_id", F.col("known").alias("name")))


@query("unit_groups", "WITH u AS (SELECT p_partkey AS right_id, p_size AS entity_id, unnest(string_split(p_type, ' ')) AS track FROM part WHERE p_partkey % 2 = 0), l AS (SELECT p_partkey AS left_id, p_size AS entity_id, unnest(string_split(p_type, ' ')) AS track FROM part WHERE p_partkey % 2 = 1) SELECT left_id, array_to_string(list_sort(list(DISTINCT right_id::VARCHAR)), ',') AS unit_ids FROM l JOIN u USING (entity_id, track) GROUP BY 1")
def unit_groups(t: Load) -> DataFrame:
    p = t("part").select("p_partkey", F.col("p_size").alias("entity_id"), F.split("p_type", " ").alias("tracks"))
    return resolve.unit_groups(p.filter("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "left_id"), p.filter("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "right_id"))


@query("copied_rows", "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 = 0)")
def copied_rows(t: Load) -> DataFrame:
    s = t("supplier").select("s_suppkey", "s_name")
    return export.copied(s, s.filter("s_suppkey % 3 = 0"), ["s_suppkey"])


# --- reports -----------------------------------------------------------------------------------------------------

def _four(t: Load) -> tuple[DataFrame, ...]:
    return t("entity"), t("site"), t("document"), t("fact")


FOUR = ("entity", "site", "document", "fact")
FLAG_SQL = f"""WITH sf AS (SELECT entity_id, bool_or(verified) AS verified_url, bool_or(http_status IS NULL OR http_status = 200) AS crawlable,
  bool_or((http_status IS NULL OR http_status = 200) AND method = 'region_index') AS region_site, bool_or((http_status IS NULL OR http_status = 200) AND method = 'operator_manual') AS operator_site FROM site GROUP BY 1),
df AS (SELECT entity_id, coalesce(bool_or(doc_class = 'target' AND status = 'ingested'), FALSE) AS any_target, coalesce(bool_or(doc_class = 'target' AND status = 'ingested' AND period = {PERIOD}), FALSE) AS current_target,
  coalesce(bool_or(status = 'ingested' AND period = {PERIOD}), FALSE) AS current_document, coalesce(bool_or(status = 'ingested' AND doc_class <> 'target'), FALSE) AS other_ingested,
  coalesce(bool_or(period = {PERIOD} AND status = 'ingested' AND doc_class IN ('target', 'image_only')), FALSE) AS confirmed, coalesce(bool_or(period = {PERIOD} AND doc_class = 'image_only' AND status IN ('ocr_pending', 'parse_failed')), FALSE) AS image_current,
  coalesce(bool_or(status = 'ocr_pending'), FALSE) AS any_ocr, coalesce(bool_or(status = 'parse_failed'), FALSE) AS any_failed, coalesce(bool_or(doc_class = 'target' AND status = 'ingested' AND period < {PERIOD}), FALSE) AS stale,
  list(DISTINCT status) FILTER (status IS NOT NULL) AS statuses, max(CASE WHEN doc_class = 'target' THEN CASE WHEN period = {PERIOD} THEN 3 WHEN period IS NOT NULL THEN 2 ELSE 0 END END) AS best, coalesce(bool_or(doc_class = 'target' AND period <> {PERIOD}), FALSE) AS any_conflict
  FROM document GROUP BY 1),
xr AS (SELECT DISTINCT entity_id FROM fact WHERE period = {PERIOD} AND is_current AND capacity IS NOT NULL),
flags AS (SELECT e.*, sf.entity_id IS NOT NULL AS has_url, coalesce(verified_url, FALSE) AS verified, df.entity_id IS NOT NULL AS has_document, coalesce(any_target, FALSE) AS any_t, coalesce(current_target, FALSE) AS ct, coalesce(current_document, FALSE) AS cd, xr.entity_id IS NOT NULL AS extracted, coalesce(stale, FALSE) AS st
  FROM entity e LEFT JOIN sf USING (entity_id) LEFT JOIN df USING (entity_id) LEFT JOIN xr USING (entity_id) WHERE active)
"""


@query("coverage_by_region", FLAG_SQL + """SELECT coalesce(region, '__total__') AS region, count(*) AS entities, count(*) FILTER (has_url) AS with_url, count(*) FILTER (verified) AS with_verified_url, count(*) FILTER (has_document) AS with_any_document,
  count(*) FILTER (any_t) AS with_target_any_period, count(*) FILTER (ct) AS with_target_this_period, count(*) FILTER (cd) AS with_document_this_period, count(*) FILTER (extracted) AS with_rows_this_period FROM flags GROUP BY ROLLUP (region)""", *FOUR)
def coverage_by_region(t: Load) -> DataFrame:
    return report.coverage(*_four(t), PERIOD)


@query("export_readiness", FLAG_SQL + f"""SELECT count(*) AS entities, count(*) FILTER (has_url) AS with_url, count(*) FILTER (NOT has_url) AS without_url, count(*) FILTER (ct) AS target_documents, count(*) FILTER (st AND NOT ct) AS stale_fallbacks,
  count(*) FILTER (NOT ct) AS missing_target, count(*) FILTER (extracted) AS extracted, (SELECT count(*) FROM fact JOIN entity USING (entity_id) WHERE period = {PERIOD} AND is_current AND active) AS target_rows FROM flags""", *FOUR)
def export_readiness(t: Load) -> DataFrame:
    return report.export_readiness(*_four(t), PERIOD)


@query("yoy_outliers", f"""SELECT n.unit_id, n.entity_id, n.enrollment AS current_value, p.enrollment AS previous_value, round((n.enrollment - p.enrollment) / p.enrollment::DOUBLE * 100, 1) AS delta_pct
FROM fact n JOIN fact p ON n.unit_id = p.unit_id AND n.period = {PERIOD} AND p.period = {PERIOD - 1} WHERE n.enrollment IS NOT NULL AND p.enrollment <> 0 AND abs((n.enrollment - p.enrollment) / p.enrollment::DOUBLE * 100) >= 50""", "fact")
def yoy_outliers(t: Load) -> DataFrame:
    return report.outliers(t("fact"), PERIOD)


@query("extraction_stats", f"""SELECT (SELECT count(*) FROM document WHERE period = {PERIOD} AND status = 'ingested') AS documents, (SELECT count(*) FROM document WHERE period = {PERIOD} AND status = 'ingested' AND document_id IN (SELECT document_id FROM fact)) AS documents_with_rows,
count(*) AS rows, count(capacity) AS rows_with_capacity, count(enrollment) AS rows_with_enrollment FROM fact WHERE period = {PERIOD} AND is_current""", "document", "fact")
def extraction_stats(t: Load) -> DataFrame:
    return report.extraction_stats(t("document"), t("fact"), PERIOD)


YOY_SQL = f"""WITH yy AS (SELECT coalesce(n.entity_id, p.entity_id) AS entity_id, CASE WHEN NOT bool_or(n.unit_id IS NOT NULL) THEN 'unchecked' WHEN NOT bool_or(p.unit_id IS NOT NULL) THEN 'new_entity'
  WHEN bool_and(n.unit_id IS NOT NULL AND p.unit_id IS NOT NULL AND n.capacity IS NOT DISTINCT FROM p.capacity AND n.enrollment IS NOT DISTINCT FROM p.enrollment) THEN 'identical_to_prev_period' ELSE 'partial_diff' END AS yoy_status
  FROM (SELECT * FROM fact WHERE period = {PERIOD}) n FULL JOIN (SELECT * FROM fact WHERE period = {PERIOD - 1}) p ON n.unit_id = p.unit_id GROUP BY 1)"""


@query("yoy_status", YOY_SQL + " SELECT * FROM yy", "fact")
def yoy_status(t: Load) -> DataFrame:
    return report.yoy_status(t("fact"), PERIOD)


@query("gaps_no_site", "SELECT region, count(*) AS n, 'no_site' AS reason FROM entity WHERE active AND entity_id NOT IN (SELECT entity_id FROM site) GROUP BY 1", "entity", "site")
def gaps_no_site(t: Load) -> DataFrame:
    return report.gaps_no_site(t("entity"), t("site"))


GAP_SQL = FLAG_SQL + """, gaps AS (SELECT e.entity_id, CASE WHEN df.entity_id IS NULL THEN CASE WHEN sf.entity_id IS NOT NULL THEN 'site_known_no_document' ELSE 'no_site_no_document' END WHEN current_target THEN NULL WHEN any_target THEN 'stale_pdf_only' WHEN other_ingested THEN 'non_target_only'
  WHEN list_contains(statuses, 'ocr_pending') THEN 'ocr_pending_only' WHEN list_contains(statuses, 'in_progress') THEN 'in_progress_only' WHEN list_contains(statuses, 'entity_mismatch') THEN 'mismatch_only' WHEN list_contains(statuses, 'parse_failed') THEN 'parse_failed_only'
  WHEN list_contains(statuses, 'no_file') THEN 'no_file_only' WHEN list_contains(statuses, 'pending') THEN 'in_progress_only' ELSE 'other_only' END AS reason FROM entity e LEFT JOIN df USING (entity_id) LEFT JOIN sf USING (entity_id) WHERE active)"""


@query("gaps_state", GAP_SQL + " SELECT * FROM gaps WHERE reason IS NOT NULL", *FOUR)
def gaps_state(t: Load) -> DataFrame:
    return report.gaps_documents(t("entity"), t("site"), t("document"), PERIOD)


@query("gaps_by_reason", GAP_SQL + " SELECT reason, count(*) AS n FROM gaps WHERE reason IS NOT NULL GROUP BY 1", *FOUR)
def gaps_by_reason(t: Load) -> DataFrame:
    return report.by_reason(report.gaps_documents(t("entity"), t("site"), t("document"), PERIOD))


@query("gaps_no_fact", f"SELECT document_id, entity_id, 'ingested_no_rows' AS reason FROM document WHERE period = {PERIOD} AND status = 'ingested' AND document_id NOT IN (SELECT document_id FROM fact)", "document", "fact")
def gaps_no_fact(t: Load) -> DataFrame:
    return report.gaps_rows(t("document"), t("fact"), PERIOD)


STATUS_SQL = FLAG_SQL + ", " + YOY_SQL[5:] + f""", er AS (SELECT DISTINCT entity_id FROM fact WHERE period = {PERIOD} AND is_current AND capacity IS NOT NULL AND (confidence IS NULL OR confidence >= 0.7)),
s1 AS (SELECT e.entity_id, e.region, CASE WHEN NOT coalesce(crawlable, FALSE) THEN 'no_url' WHEN region_site THEN 'region_url' WHEN operator_site THEN 'operator_url' ELSE 'unknown' END AS url_status,
  CASE WHEN confirmed THEN 'confirmed_target' WHEN image_current OR any_ocr THEN 'image_pending' WHEN stale THEN 'rejected_stale' WHEN df.entity_id IS NOT NULL THEN 'discovered' ELSE 'none' END AS document_status,
  CASE WHEN er.entity_id IS NOT NULL THEN 'parsed' WHEN any_ocr THEN 'ocr_pending' WHEN any_failed THEN 'parse_failed' ELSE 'none' END AS extract_status, coalesce(yoy_status, 'unchecked') AS yoy_status, best, coalesce(any_conflict, FALSE) AS any_conflict
  FROM entity e LEFT JOIN sf USING (entity_id) LEFT JOIN df USING (entity_id) LEFT JOIN er USING (entity_id) LEFT JOIN yy USING (entity_id) WHERE active),
s2 AS (SELECT *, CASE WHEN best IS NULL THEN 'none' WHEN document_status = 'rejected_stale' AND any_conflict THEN 'conflict' WHEN best = 3 THEN 'pdf_text' WHEN best = 2 THEN 'conflict' ELSE 'none' END AS level FROM s1),
s3 AS (SELECT *, CASE WHEN yoy_status = 'partial_diff' AND level NOT IN ('conflict', 'operator_override') THEN 'prev_year_diff' ELSE level END AS evidence_level FROM s2),
s4 AS (SELECT *, document_status = 'confirmed_target' AND extract_status = 'parsed' AND evidence_level IN ('pdf_text', 'prev_year_diff') AND yoy_status <> 'identical_to_prev_period' AS ready FROM s3),
st AS (SELECT entity_id, region, url_status, document_status, extract_status, yoy_status, evidence_level, ready, CASE WHEN ready THEN NULL WHEN document_status = 'none' AND url_status = 'no_url' THEN 'no_url' WHEN document_status = 'none' THEN 'no_target_pdf'
  WHEN document_status = 'rejected_stale' THEN 'stale_pdf_only' WHEN document_status = 'image_pending' THEN 'ocr_pending' WHEN extract_status = 'parse_failed' THEN 'parse_failed' WHEN extract_status = 'none' THEN 'not_extracted' ELSE 'review_required' END AS blocking_reason FROM s4)"""


def _status(t: Load) -> DataFrame:
    return report.status_rows(*_four(t), PERIOD)


@query("status_rebuild", STATUS_SQL + " SELECT * FROM st", *FOUR)
def status_rebuild(t: Load) -> DataFrame:
    return _status(t)


@query("status_refresh", STATUS_SQL + " SELECT * FROM st", *FOUR)
def status_refresh(t: Load) -> DataFrame:
    """UPD-12: a table built before some rows came, changed and went, brought up to date for the entities they belong to."""
    import uuid

    from veritab.streaming.state import checkpoint_dir

    entity, site, document, fact = _four(t)
    came = {"site": F.col("site_id") % 7 == 0, "document": F.col("document_id") % 50 == 0, "fact": F.col("unit_id") % 90 == 0, "entity": F.col("entity_id") % 40 == 0}
    path = f"{checkpoint_dir(entity.sparkSession)}/status-{uuid.uuid4().hex}"
    before = entity.withColumn("active", F.when(came["entity"], ~F.col("active")).otherwise(F.col("active")))
    # some documents stood elsewhere before
    moved = document.withColumn("period", F.when(F.col("document_id") % 70 == 1, F.col("period") - 1).otherwise(F.col("period")))
    report.build_status(path, before, site.filter(~came["site"]), moved.filter(~came["document"]), fact.filter(~came["fact"]), PERIOD)
    touched = site.filter(came["site"]).select("entity_id").unionByName(document.filter(came["document"] | (F.col("document_id") % 70 == 1)).select("entity_id"))
    touched = touched.unionByName(fact.filter(came["fact"]).select("entity_id")).unionByName(entity.filter(came["entity"]).select("entity_id"))
    report.refresh_status(path, touched, entity, site, document, fact, PERIOD)
    return entity.sparkSession.read.parquet(path).drop("part")


@query("status_counts", STATUS_SQL + """ SELECT count(*) AS total, count(*) FILTER (ready) AS ready, count(*) FILTER (document_status = 'confirmed_target') AS confirmed_target, count(*) FILTER (document_status = 'confirmed_target' AND extract_status = 'parsed') AS confirmed_target_parsed,
  count(*) FILTER (document_status = 'confirmed_target' AND ready) AS confirmed_target_ready, count(*) FILTER (document_status = 'image_pending') AS image_pending, count(*) FILTER (document_status = 'rejected_stale') AS rejected_stale, count(*) FILTER (document_status = 'discovered') AS discovered,
  count(*) FILTER (document_status = 'none') AS none, count(*) FILTER (extract_status = 'parse_failed') AS parse_failed FROM st""", *FOUR)
def status_counts(t: Load) -> DataFrame:
    return report.status_counts(_status(t))


@query("ship_readiness", STATUS_SQL + """, c AS (SELECT count(*) AS total, count(*) FILTER (document_status = 'confirmed_target' AND extract_status = 'parsed') / count(*) AS target_rate, count(*) FILTER (document_status = 'confirmed_target' AND ready) / count(*) AS ready_rate,
  1 - count(*) FILTER (document_status IN ('confirmed_target', 'image_pending')) / count(*) AS manual_rate FROM st) SELECT *, target_rate >= 0.6 AS target_passed, ready_rate >= 0.6 AS ready_passed, manual_rate <= 0.3 + 1e-9 AS manual_passed FROM c""", *FOUR)
def ship_readiness(t: Load) -> DataFrame:
    return report.readiness(_status(t))


@query("task_summary", STATUS_SQL + " SELECT url_status, document_status, extract_status, coalesce(blocking_reason, '') AS blocking_reason, count(*) AS n FROM st GROUP BY ALL", *FOUR)
def task_summary(t: Load) -> DataFrame:
    return report.task_summary(_status(t))


PICK_SQL = f""", pd AS (SELECT entity_id, document_id FROM document QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY CASE WHEN period = {PERIOD} THEN 3 WHEN period < {PERIOD} THEN 2 WHEN period IS NULL THEN 1 ELSE 0 END DESC, coalesce(period, 0) DESC,
  CASE WHEN status = 'ingested' THEN 3 WHEN status IN ('review_pending', 'parse_failed', 'ocr_pending') THEN 2 ELSE 1 END DESC, document_id DESC) = 1),
ps AS (SELECT entity_id, site_id, url FROM site QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY (http_status IS NULL OR http_status = 200) AND NOT lower(url) LIKE '%.pdf' DESC, site_id DESC) = 1)"""


@query("task_list_topk", STATUS_SQL + PICK_SQL + """ SELECT st.entity_id, name, document_id, site_id, ready, blocking_reason, CASE WHEN coalesce(lower(url) LIKE '%.pdf', FALSE) AND blocking_reason IN ('no_target_pdf', 'publication_lag_latest_public', 'stale_pdf_only') THEN 'add_url' WHEN blocking_reason IS NULL THEN 'export' WHEN blocking_reason = 'no_url' THEN 'add_url'
  WHEN blocking_reason = 'no_target_pdf' THEN 'find_document' WHEN blocking_reason = 'stale_pdf_only' THEN 'await_publication' WHEN blocking_reason = 'ocr_pending' THEN 'recognise_or_enter' WHEN blocking_reason = 'parse_failed' THEN 'enter' WHEN blocking_reason IN ('not_extracted', 'review_required') THEN 'check_document' ELSE 'check' END AS next_action
  FROM st JOIN entity e USING (entity_id) LEFT JOIN pd USING (entity_id) LEFT JOIN ps USING (entity_id) ORDER BY ready, blocking_reason NULLS LAST, st.region, st.entity_id LIMIT 500""", *FOUR)
def task_list_topk(t: Load) -> DataFrame:
    out = report.task_list(_status(t), t("entity"), t("document"), t("site"), PERIOD)
    return out.select("entity_id", "name", "document_id", "site_id", "ready", "blocking_reason", "next_action")


@query("task_document_pick", "WITH x AS (SELECT 1)" + PICK_SQL + " SELECT * FROM pd", "document", "site")
def task_document_pick(t: Load) -> DataFrame:
    return report.pick_documents(t("document"), PERIOD)


@query("site_pick", "WITH x AS (SELECT 1)" + PICK_SQL + " SELECT entity_id, site_id FROM ps", "document", "site")
def site_pick(t: Load) -> DataFrame:
    return report.pick_sites(t("site"))


@query("latest_excluded_entities", "SELECT entity_id FROM (SELECT entity_id, arg_max(status, period) AS s FROM status WHERE is_current GROUP BY 1) WHERE s = 'excluded'", "status")
def latest_excluded_entities(t: Load) -> DataFrame:
    return report.excluded_entities(t("status"))


@query("queue_depth", "SELECT count(*) FILTER (coalesce(status, 'pending') = 'pending') AS pending, count(*) FILTER (status = 'ingested') AS ingested, count(*) FILTER (status = 'in_progress') AS in_progress, count(*) FILTER (coalesce(status, 'pending') NOT IN ('pending', 'ingested', 'in_progress')) AS other FROM document", "document")
def queue_depth(t: Load) -> DataFrame:
    return report.queue_depth(t("document"), ["pending", "ingested", "in_progress"])


@query("pipeline_stats", "SELECT 'status' AS kind, coalesce(status, 'null') AS value, count(*) AS n FROM document GROUP BY 2 UNION ALL SELECT 'doc_class', doc_class, count(*) FROM document GROUP BY 2 UNION ALL SELECT 'period', period::VARCHAR, count(*) FROM document GROUP BY 2", "document")
def pipeline_stats(t: Load) -> DataFrame:
    return report.pipeline_stats(t("document"))


@query("quality_warnings", "SELECT count(*) FILTER (confidence IS NULL) AS no_confidence, count(*) FILTER (confidence < 0.7) AS below_review, count(*) FILTER (confidence >= 0.7 AND confidence < 0.85) AS flagged, count(*) FILTER (capacity IS NULL) AS no_capacity FROM fact WHERE is_current", "fact")
def quality_warnings(t: Load) -> DataFrame:
    return report.quality_warnings(t("fact"))


@query("exclusion_union", "SELECT 'unit' AS kind, entity_id, period, confidence FROM fact WHERE confidence < 0.7 UNION ALL SELECT 'support', o_custkey, year(o_orderdate), (o_orderkey % 100) / 100.0::DOUBLE FROM orders WHERE (o_orderkey % 100) / 100.0::DOUBLE < 0.7", "fact")
def exclusion_union(t: Load) -> DataFrame:
    supports = t("orders").select(F.col("o_custkey").alias("entity_id"), F.year("o_orderdate").alias("period"), ((F.col("o_orderkey") % 100) / 100.0).alias("confidence"), F.lit(True).alias("is_current"))
    return report.exclusions(t("fact"), supports)


@query("rows_by_document_status", "SELECT status, count(DISTINCT d.document_id) AS documents, count(confidence) AS scored_rows, round(avg(confidence), 3) AS mean_confidence FROM document d LEFT JOIN fact f ON d.document_id = f.document_id GROUP BY 1", "document", "fact")
def rows_by_document_status(t: Load) -> DataFrame:
    return report.rows_by_document_status(t("document"), t("fact"))


@query("site_hosts", "SELECT lower(regexp_extract(url, '^[a-z]+://([^/]+)', 1)) AS host, count(DISTINCT entity_id) AS entities FROM site WHERE entity_id IN (SELECT entity_id FROM document WHERE status = 'entity_mismatch') GROUP BY 1", "site", "document")
def site_hosts(t: Load) -> DataFrame:
    return report.hosts(t("site"), t("document").filter("status = 'entity_mismatch'"))


@query("owners_without_url", "WITH m AS (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY name) AS rn FROM entity WHERE active AND entity_id NOT IN (SELECT entity_id FROM site)) SELECT owner, count(*) AS entities, array_to_string(list_sort(list(DISTINCT region)), ',') AS regions, array_to_string(list_sort(list(name) FILTER (rn <= 3)), ',') AS samples FROM m GROUP BY 1", "entity", "site")
def owners_without_url(t: Load) -> DataFrame:
    return report.owners_without_url(t("entity"), t("site"))


@query("snapshot_delta", "SELECT coalesce(a.m, b.m) AS metric, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM (SELECT event_type AS m, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1) a FULL JOIN (SELECT event_type AS m, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1) b ON a.m = b.m")
def snapshot_delta(t: Load) -> DataFrame:
    def counted(where: str) -> DataFrame:
        return t("events").filter(where).groupBy(F.col("event_type").alias("metric")).agg(F.count("*").alias("value"))

    return report.snapshot_delta(counted("ts < TIMESTAMP_NTZ '2024-01-10'"), counted("ts >= TIMESTAMP_NTZ '2024-01-10'"))


@query("table_counts", "SELECT 'entity' AS table_name, count(*) AS rows FROM customer UNION ALL SELECT 'document', count(*) FROM orders UNION ALL SELECT 'row', count(*) FROM lineitem")
def table_counts(t: Load) -> DataFrame:
    return report.table_counts({"entity": t("customer"), "document": t("orders"), "row": t("lineitem")})


# --- evidence ----------------------------------------------------------------------------------------------------

BUCKET_SQL = r"""WITH f AS (SELECT *, reason = 'accepted_downloaded' AS accepted, reason = 'pdf_entity_mismatch' AS mismatch, starts_with(reason, 'fiscal_year_mismatch:') AND pdf_type = 'target' AS old_year,
  reason = 'target_fiscal_year_not_detected' AND NOT (regexp_extract(url, '(20\d\d)/', 1)::INT >= target_period - 8 AND regexp_extract(url, '(20\d\d)/', 1)::INT < target_period) AS yearless,
  reason = 'no_candidates_found' AS nocand, reason = 'discovery_error' AS err, regexp_matches(lower(error), 'certificate[_ ]verify[_ ]failed') AS tls FROM evidence WHERE reason NOT IN ('candidate_budget_dropped', 'candidate_entity_mismatch')),
b AS (SELECT entity_id, CASE WHEN bool_or(accepted) THEN 'accepted_target_pdf' WHEN bool_or(mismatch) THEN 'entity_identity_mismatch' WHEN bool_or(yearless) THEN 'target_form_without_year_evidence' WHEN bool_or(coalesce(old_year, FALSE)) THEN 'publication_lag_or_old_target_pdf'
  WHEN bool_or(nocand) THEN 'no_pdf_candidates' WHEN bool_and(err) AND bool_or(tls) THEN 'tls_certificate_verify_failed' WHEN bool_and(err) THEN 'site_fetch_error_only' WHEN bool_or(err) THEN 'mixed_with_site_fetch_error' ELSE 'non_target_candidates_only' END AS bucket, count(*) AS rows FROM f GROUP BY 1)"""


@query("evidence_buckets", BUCKET_SQL + " SELECT * FROM b", "evidence")
def evidence_buckets(t: Load) -> DataFrame:
    return evidence.buckets(t("evidence"))


@query("evidence_rollup_topn", """WITH l AS (SELECT 'reason' AS kind, reason AS value FROM evidence UNION ALL SELECT 'pdf_type', coalesce(pdf_type, 'null') FROM evidence UNION ALL SELECT 'pattern', pattern FROM evidence UNION ALL SELECT 'host', regexp_extract(url, '^https://([^/]+)', 1) FROM evidence)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, value) AS rank FROM (SELECT kind, value, count(*) AS n FROM l GROUP BY kind, value)) WHERE rank <= 5""", "evidence")
def evidence_rollup_topn(t: Load) -> DataFrame:
    return evidence.rollup(t("evidence"), 5)


REASON_SQL = "CASE WHEN reason = 'accepted_downloaded' THEN 0 WHEN reason = 'pdf_entity_mismatch' THEN 1 WHEN reason = 'target_fiscal_year_not_detected' THEN 2 WHEN starts_with(reason, 'fiscal_year_mismatch:') THEN 3 WHEN reason = 'no_candidates_found' THEN 4 WHEN reason = 'discovery_error' THEN 5 ELSE 6 END"


@query("evidence_representatives", f"SELECT entity_id, position, reason, row_number() OVER w AS rank FROM evidence QUALIFY row_number() OVER w <= 3 WINDOW w AS (PARTITION BY entity_id ORDER BY {REASON_SQL}, position)".replace("QUALIFY row_number() OVER w <= 3 WINDOW w AS", "WINDOW w AS") + " QUALIFY rank <= 3", "evidence")
def evidence_representatives(t: Load) -> DataFrame:
    return evidence.representatives(t("evidence"), 3).select("entity_id", "position", "reason", "rank")


#: The log with a hundred entities in place of each, so that most are told by a few rows and not all are accepted.
SPREAD_SQL = BUCKET_SQL.replace("WITH f AS", "WITH spread AS (SELECT * REPLACE (entity_id * 100 + position % 100 AS entity_id) FROM evidence), f AS").replace("FROM evidence WHERE", "FROM spread WHERE")


@query("batch_plan", SPREAD_SQL + """ SELECT c.entity_id, candidates, coalesce(bucket, 'no_evidence') AS bucket, coalesce(rows, 0) AS rows FROM (SELECT entity_id, count(*) AS candidates FROM spread GROUP BY 1) c LEFT JOIN b USING (entity_id) WHERE coalesce(bucket, 'no_evidence') <> 'accepted_target_pdf'
ORDER BY list_position(['target_form_without_year_evidence','publication_lag_or_old_target_pdf','entity_identity_mismatch','mixed_with_site_fetch_error','site_fetch_error_only','tls_certificate_verify_failed','non_target_candidates_only','no_pdf_candidates','no_evidence'], coalesce(bucket, 'no_evidence')), coalesce(rows, 0) DESC, candidates DESC, entity_id LIMIT 100""", "evidence")
def batch_plan(t: Load) -> DataFrame:
    rows = t("evidence").withColumn("entity_id", F.col("entity_id") * 100 + F.col("position") % 100)
    return evidence.batch_plan(rows, 100).select("entity_id", "candidates", "bucket", "rows")


@query("plan_coverage", "WITH o AS (SELECT c_custkey AS entity_id, 1 + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS n FROM customer WHERE c_custkey % 3 <> 0), p AS (SELECT c_custkey AS entity_id FROM customer WHERE c_custkey % 4 <> 0), j AS (SELECT coalesce(p.entity_id, o.entity_id) AS entity_id, CASE WHEN n IS NULL THEN 'missing' WHEN p.entity_id IS NULL THEN 'extra' WHEN n > 1 THEN 'duplicate' END AS problem FROM p FULL JOIN o ON p.entity_id = o.entity_id) SELECT * FROM j WHERE problem IS NOT NULL")
def plan_coverage(t: Load) -> DataFrame:
    c = t("customer").select(F.col("c_custkey").alias("entity_id"))
    outcomes = c.filter("entity_id % 3 <> 0")
    return evidence.plan_coverage(outcomes.unionByName(outcomes.filter("entity_id % 10 = 0")), c.filter("entity_id % 4 <> 0"))


PREDICT_SQL = """CASE WHEN reason = 'accepted_downloaded' THEN 'accepted_target_pdf' WHEN starts_with(reason, 'fiscal_year_mismatch:') AND pdf_type = 'image_only' THEN 'needs_operator_review' WHEN starts_with(reason, 'fiscal_year_mismatch:') THEN 'publication_lag_latest_public' WHEN reason = 'target_fiscal_year_not_detected' THEN 'needs_operator_review' WHEN reason = 'no_candidates_found' THEN 'no_target_candidate_found' WHEN reason = 'discovery_error' THEN 'site_fetch_error' END"""


@query("evidence_predictions", f"SELECT entity_id, outcome, url FROM (SELECT *, {PREDICT_SQL} AS outcome FROM evidence) WHERE outcome IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY list_position(['accepted_target_pdf','publication_lag_latest_public','needs_operator_review','site_fetch_error','no_target_candidate_found'], outcome), position) = 1", "evidence")
def evidence_predictions(t: Load) -> DataFrame:
    return evidence.predictions(t("evidence"))


# --- evaluation --------------------------------------------------------------------------------------------------

@query("gold_eval_fields", "WITH g AS (SELECT doc_id, 'quality' AS field, quality::DOUBLE AS gold FROM labels UNION ALL SELECT doc_id, 'toxic', toxic::DOUBLE FROM labels), p AS (SELECT doc_id, 'quality' AS field, CASE WHEN n_chars >= 600 THEN 1 ELSE 0 END::DOUBLE AS parsed FROM documents UNION ALL SELECT doc_id, 'toxic', CASE WHEN lang = 'en' THEN 0 END::DOUBLE FROM documents) SELECT field, count(*) AS n, avg(CASE WHEN abs(gold - parsed) <= 0.01 THEN 1.0 ELSE 0.0 END) AS accuracy FROM g LEFT JOIN p USING (doc_id, field) WHERE gold IS NOT NULL GROUP BY 1")
def gold_eval_fields(t: Load) -> DataFrame:
    parsed = t("documents").select("doc_id", F.when(F.col("n_chars") >= 600, 1).otherwise(0).alias("quality"), F.when(F.col("lang") == "en", 0).alias("toxic"))
    return evaluate.field_accuracy(t("labels"), parsed, ["doc_id"], ["quality", "toxic"])


@query("gold_recall_precision", "WITH g AS (SELECT DISTINCT doc_id FROM labels), p AS (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0) SELECT (SELECT count(*) FROM g) AS gold, (SELECT count(*) FROM p) AS parsed, count(*) / (SELECT count(*) FROM g) AS recall, count(*) / (SELECT count(*) FROM p) AS precision FROM g JOIN p USING (doc_id)")
def gold_recall_precision(t: Load) -> DataFrame:
    return evaluate.recall_precision(t("labels"), t("documents").filter("doc_id % 3 <> 0"), ["doc_id"])


@query("gold_predictions", "WITH g AS (SELECT doc_id AS entry_id, quality, toxic FROM labels), p AS (SELECT doc_id AS entry_id, 1 AS quality, 0 AS toxic FROM documents WHERE doc_id % 4 <> 0) SELECT coalesce(g.entry_id, p.entry_id) AS entry_id, CASE WHEN p.entry_id IS NULL THEN 'missing' WHEN g.entry_id IS NULL THEN 'unexpected' WHEN g.quality = p.quality AND g.toxic = p.toxic THEN 'ok' ELSE 'mismatch' END AS verdict, CASE WHEN g.entry_id IS NOT NULL AND p.entry_id IS NOT NULL THEN concat_ws(',', CASE WHEN g.quality <> p.quality THEN 'quality' END, CASE WHEN g.toxic <> p.toxic THEN 'toxic' END) ELSE '' END AS fields FROM g FULL JOIN p ON g.entry_id = p.entry_id")
def gold_predictions(t: Load) -> DataFrame:
    told = t("documents").filter("doc_id % 4 <> 0").select(F.col("doc_id").alias("entry_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    return evaluate.compared_predictions(t("labels").withColumnRenamed("doc_id", "entry_id"), told, ["quality", "toxic"])


@query("gold_summary", "SELECT status AS outcome, count(*) AS n, array_to_string(list_sort(list(DISTINCT period::VARCHAR)), ',') AS periods FROM yearly_status GROUP BY 1", "yearly_status")
def gold_summary(t: Load) -> DataFrame:
    return evaluate.gold_summary(t("yearly_status").withColumnRenamed("status", "outcome"))


@query("gold_entry_errors", "SELECT entry_id, array_to_string(errors, '; ') AS errors FROM (SELECT entry_id, list_filter([CASE WHEN count(*) OVER (PARTITION BY entry_id) > 1 THEN 'duplicate id' END, CASE WHEN outcome = 'error' THEN 'unknown outcome' END], lambda x: x IS NOT NULL) AS errors FROM (SELECT entity_id::VARCHAR || '-' || period AS entry_id, status AS outcome FROM yearly_status)) WHERE len(errors) > 0", "yearly_status")
def gold_entry_errors(t: Load) -> DataFrame:
    e = t("yearly_status").select(F.concat_ws("-", "entity_id", "period").alias("entry_id"), F.col("status").alias("outcome"), F.lit("u").alias("url"))
    return evaluate.entry_errors(e, ["excluded", "collected", "stale"]).select("entry_id", F.array_join("errors", "; ").alias("errors"))


#: Unit after unit of each document, with the list of what is taken.
GREEDY_SQL = """WITH RECURSIVE u AS (SELECT l_orderkey AS doc_id, l_linenumber::BIGINT AS pos, 'unit' || (l_partkey % 4) AS name, l_returnflag AS shift, l_quantity % 3 AS years FROM lineitem),
g AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos, name, shift, years) AS turn FROM u WHERE pos % 2 = 1),
e AS (SELECT g.doc_id, g.turn, p.pos, CASE WHEN g.shift = p.shift AND g.years = p.years THEN 0 ELSE 1 END AS other FROM g JOIN u p ON p.doc_id = g.doc_id AND p.pos % 2 = 0 AND p.name = g.name),
walk AS (
  SELECT DISTINCT doc_id, 0::BIGINT AS turn, []::BIGINT[] AS taken, NULL::BIGINT AS pick FROM g
  UNION ALL
  SELECT doc_id, turn, CASE WHEN best IS NULL THEN taken ELSE list_append(taken, best.pos) END, best.pos FROM (
    SELECT w.doc_id, g.turn, w.taken, min(CASE WHEN e.pos IS NOT NULL THEN {'other': e.other, 'pos': e.pos} END) AS best
    FROM walk w JOIN g ON g.doc_id = w.doc_id AND g.turn = w.turn + 1 LEFT JOIN e ON e.doc_id = w.doc_id AND e.turn = g.turn AND NOT list_contains(w.taken, e.pos)
    GROUP BY w.doc_id, g.turn, w.taken)
)
SELECT doc_id, g.pos AS gold_pos, pick AS parsed_pos FROM walk JOIN g USING (doc_id, turn) WHERE pick IS NOT NULL"""


@query("greedy_unit_match", GREEDY_SQL)
def greedy_unit_match(t: Load) -> DataFrame:
    """JOIN-10."""
    l = t("lineitem").withColumn("name", F.concat(F.lit("unit"), (F.col("l_partkey") % 4).cast("string"))).select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("long").alias("pos"), "name", F.col("l_returnflag").alias("shift"), (F.col("l_quantity") % 3).alias("years"))
    return evaluate.matched_units(l.filter("pos % 2 = 1").withColumnRenamed("pos", "gold_pos"), l.filter("pos % 2 = 0").withColumnRenamed("pos", "parsed_pos"))


@query("new_ids", "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_custkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END NULLS FIRST) + 1000 AS new_id FROM orders")
def new_ids(t: Load) -> DataFrame:
    """JOIN-09: ids for keys of which one part may be null."""
    keyed = t("orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("p"))
    return resolve.new_ids(keyed, ["o_custkey", "p"], 1000).select("o_orderkey", "new_id")


# --- export ------------------------------------------------------------------------------------------------------

@query("period_pivot_status", "SELECT c_custkey AS entity_id, " + ", ".join(f"max(CASE WHEN period = {p} THEN status END) AS status_{p}" for p in (1996, 1997, 1998)) + " FROM customer LEFT JOIN (SELECT * FROM status WHERE is_current) s ON c_custkey = entity_id GROUP BY 1", "status")
def period_pivot_status(t: Load) -> DataFrame:
    return export.status_pivot(t("customer").select(F.col("c_custkey").alias("entity_id")), t("status"), [1996, 1997, 1998])


@query("period_pivot_measures", "SELECT entity_id, unit_id, " + ", ".join(f"max(CASE WHEN period = {p} THEN {m} END) AS {m}_{p}" for p in (1997, 1998) for m in ("capacity", "enrollment")) + " FROM fact GROUP BY ALL", "fact")
def period_pivot_measures(t: Load) -> DataFrame:
    return export.measure_pivot(t("fact"), [1997, 1998], ["capacity", "enrollment"])


@query("unit_rollup_sum_nulls", f"SELECT entity_id, sum(capacity)::BIGINT AS capacity, sum(enrollment)::BIGINT AS enrollment FROM fact WHERE period = {PERIOD} GROUP BY 1", "fact")
def unit_rollup_sum_nulls(t: Load) -> DataFrame:
    return export.rolled_up(t("fact"), PERIOD, ["capacity", "enrollment"])


@query("prev_period_ratio", "SELECT unit_id, period, enrollment / nullif(CASE WHEN lag(period) OVER w = period - 1 THEN lag(enrollment) OVER w END, 0) AS ratio FROM fact WINDOW w AS (PARTITION BY unit_id ORDER BY period)", "fact")
def prev_period_ratio(t: Load) -> DataFrame:
    return export.previous_ratio(t("fact"), "enrollment")


@query("template_gaps", f"""WITH tmpl AS (SELECT s_suppkey AS row_id, s_name AS name, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_suppkey END AS entity_id FROM supplier), sums AS (SELECT entity_id, sum(capacity) AS capacity FROM fact WHERE period = {PERIOD} GROUP BY 1)
SELECT row_id, name, CASE WHEN entity_id IS NULL THEN 'entity_missing' ELSE 'no_rows_for_period' END AS gap_reason FROM tmpl LEFT JOIN sums USING (entity_id) WHERE capacity IS NULL""", "fact")
def template_gaps(t: Load) -> DataFrame:
    s = t("supplier")
    template, matches = s.select(F.col("s_suppkey").alias("row_id"), F.col("s_name").alias("name")), s.filter("s_suppkey % 5 <> 0").select(F.col("s_suppkey").alias("row_id"), F.col("s_suppkey").alias("entity_id"))
    return export.overlay(template, matches, export.rolled_up(t("fact"), PERIOD, ["capacity"]), ["capacity"])[1]


@query("content_addressed", "SELECT doc_id, sha256(text) AS sha256, substr(sha256(text), 1, 2) || '/' || sha256(text) AS path FROM documents")
def content_addressed(t: Load) -> DataFrame:
    return export.content_addressed(t("documents"), F.col("text")).select("doc_id", "sha256", "path")


# --- functions ---------------------------------------------------------------------------------------------------

@query("unpivot_metrics", "SELECT unit_id, period, unnest(['capacity', 'enrollment']) AS metric, unnest([capacity, enrollment]) AS value FROM fact", "fact")
def unpivot_metrics(t: Load) -> DataFrame:
    return records.melted(t("fact"), ["unit_id", "period"], ["capacity", "enrollment"])


@query("external_long_rows", "SELECT o_orderkey AS id, 'price' AS metric, o_orderstatus AS value FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT id, metric, value FROM (SELECT o_orderkey AS id, unnest(['a', 'b']) AS metric, unnest([CASE WHEN o_orderkey % 3 = 0 THEN o_custkey::VARCHAR END, o_orderpriority]) AS value FROM orders WHERE o_orderkey % 2 = 1) WHERE value IS NOT NULL")
def external_long_rows(t: Load) -> DataFrame:
    even = F.col("o_orderkey") % 2 == 0
    rows = t("orders").select(F.col("o_orderkey").alias("id"), F.when(even, "price").alias("metric"), F.when(even, F.col("o_orderstatus")).alias("value"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")).alias("a"), F.col("o_orderpriority").alias("b"))
    return records.external_rows(rows, ["id"], ["a", "b"])


CONF_SQL = """WITH j AS (SELECT n.unit_id, n.period, n.capacity, n.enrollment, p.enrollment AS prior, (n.capacity IS NOT NULL)::INT + (n.enrollment IS NOT NULL)::INT AS got FROM fact n LEFT JOIN fact p ON n.unit_id = p.unit_id AND p.period = n.period - 1),
c AS (SELECT unit_id, period, CASE got WHEN 0 THEN 0.0 WHEN 2 THEN 1.0 ELSE 0.5 END::DOUBLE AS f1, got / 2 AS f2, CASE WHEN prior IS NULL THEN 0.7 WHEN enrollment IS NULL THEN 0.0 WHEN prior <= 0 THEN 0.7 WHEN enrollment / prior BETWEEN 0.5 AND 2 THEN 1.0 WHEN enrollment / prior BETWEEN 0.3 AND 3 THEN 0.5 ELSE 0.0 END::DOUBLE AS f3 FROM j),
k AS (SELECT *, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, f1 * 0.4::DOUBLE + f2 * 0.4::DOUBLE + f3 * 0.2::DOUBLE)), 9) AS composite FROM c)"""


def _confidence(t: Load) -> DataFrame:
    f = t("fact")
    prior = f.select("unit_id", (F.col("period") + 1).alias("period"), F.col("enrollment").alias("prior"))
    required = [F.col("capacity"), F.col("enrollment")]
    b = numbers.breakdown(numbers.extraction_factor(required), required, F.col("enrollment"), F.col("prior"), "pdf_parse")
    return f.select("unit_id", "period", "capacity", "enrollment").join(prior, ["unit_id", "period"], "left").withColumn("b", b)


@query("confidence_composite", CONF_SQL + " SELECT unit_id, period, f1, f2, f3, composite FROM k", "fact")
def confidence_composite(t: Load) -> DataFrame:
    return _confidence(t).select("unit_id", "period", F.col("b.f1_extraction").alias("f1"), F.col("b.f2_completeness").alias("f2"), F.col("b.f3_yoy_sanity").alias("f3"), F.round("b.composite", 9).alias("composite"))


@query("confidence_verdict", CONF_SQL + " SELECT CASE WHEN composite >= 0.85 THEN 'auto' WHEN composite >= 0.7 THEN 'auto_flag' WHEN composite >= 0.5 THEN 'review_pending' ELSE 'rejected' END AS verdict, count(*) AS n FROM k GROUP BY 1", "fact")
def confidence_verdict(t: Load) -> DataFrame:
    return _confidence(t).groupBy(numbers.verdict(F.round("b.composite", 9)).alias("verdict")).agg(F.count("*").alias("n"))


@query("json_breakdown_roundtrip", CONF_SQL + " SELECT unit_id, period, round(f2, 4) AS f2, round(composite, 4) AS composite FROM k", "fact")
def json_breakdown_roundtrip(t: Load) -> DataFrame:
    back = payloads.breakdown_of_json(payloads.breakdown_json(F.col("b")))
    return _confidence(t).withColumn("r", back).select("unit_id", "period", F.col("r.f2_completeness").alias("f2"), F.round("r.composite", 4).alias("composite"))


@query("row_keys", "SELECT p_partkey, sha256('[\"' || p_brand || '\",\"' || p_size || '\"]') AS row_key FROM part")
def row_keys(t: Load) -> DataFrame:
    return t("part").select("p_partkey", payloads.row_key(F.col("p_brand"), F.col("p_size")).alias("row_key"))


@query("review_ids", "SELECT p_partkey, substr(sha256('{\"brand\": \"' || p_brand || '\", \"size\": \"' || p_size || '\"}'), 1, 24) AS review_id FROM part")
def review_ids(t: Load) -> DataFrame:
    return t("part").select("p_partkey", payloads.review_id({"size": F.col("p_size"), "brand": F.col("p_brand")}).alias("review_id"))


@query("confidence_panel", CONF_SQL + " SELECT unit_id, period, unnest(['f1_extraction', 'f2_completeness', 'f3_yoy_sanity']) AS factor, unnest([round(f1, 4), round(f2, 4), round(f3, 4)]) AS value, unnest([0.4, 0.4, 0.2])::DOUBLE AS weight FROM k", "fact")
def confidence_panel(t: Load) -> DataFrame:
    return _confidence(t).select("unit_id", "period", F.inline(payloads.panel(payloads.breakdown_json(F.col("b")))))


@query("comparable_values", "WITH v AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN value::VARCHAR WHEN 1 THEN '-' WHEN 2 THEN '1,234' WHEN 3 THEN ' x y ' WHEN 4 THEN NULL ELSE '8.9' END AS raw FROM events) SELECT event_id, CASE WHEN raw IS NULL OR raw = '-' THEN NULL WHEN raw = '1,234' THEN '1234' WHEN raw = ' x y ' THEN 'xy' ELSE trunc(raw::DOUBLE)::BIGINT::VARCHAR END AS value FROM v")
def comparable_values(t: Load) -> DataFrame:
    k = F.col("event_id") % 6
    raw = F.when(k == 0, F.col("value").cast("string")).when(k == 1, "-").when(k == 2, "1,234").when(k == 3, " x y ").when(k == 5, "8.9")
    return t("events").select("event_id", numbers.comparable(raw).alias("value"))


@query("safe_ints", "SELECT event_id, trunc(value)::BIGINT AS whole, NULL::BIGINT AS none FROM events")
def safe_ints(t: Load) -> DataFrame:
    return t("events").select("event_id", numbers.safe_int(F.col("value")).alias("whole"), numbers.safe_int(F.col("event_type")).alias("none"))


@query("fiscal_year_of_date", "SELECT o_orderkey, year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END AS period, year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END || '年度（平成' || (year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END - 1988) || '年度）' AS label FROM orders")
def fiscal_year_of_date(t: Load) -> DataFrame:
    p = periods.fiscal_period(F.col("o_orderdate"))
    return t("orders").select("o_orderkey", p.alias("period"), periods.period_label(p).alias("label"))


@query("url_canonical", r"""WITH q AS (SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_|gclid|fbclid)'))), '&') AS query FROM pages)
SELECT page_id, lower(regexp_extract(url, '^([a-z]+://[^/]+)', 1)) || regexp_replace(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/+', '/', 'g'), '/$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical,
  lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM q""")
def url_canonical(t: Load) -> DataFrame:
    bare = F.regexp_replace("url", "#.*$", "")
    messy = F.concat(bare, F.when(bare.contains("?"), "&").otherwise("?"), F.lit("utm_source=x&gclid=1#top"))
    return t("pages").select("page_id", urls.canonical(messy).alias("canonical"), urls.host(F.col("url")).alias("host"))


@query("url_quality_action", "SELECT site_id, q AS quality, CASE WHEN q = 'direct_pdf' THEN 'upgrade' ELSE 'noop' END AS action FROM (SELECT site_id, CASE WHEN lower(url) LIKE '%.pdf' THEN 'direct_pdf' WHEN contains(lower(url), 'info') THEN 'disclosure' ELSE 'homepage' END AS q FROM site)", "site")
def url_quality_action(t: Load) -> DataFrame:
    q = urls.quality(F.col("url"))
    return t("site").select("site_id", q.alias("quality"), urls.writer_action(q, F.array(F.lit("homepage"), F.lit("disclosure"))).alias("action"))


@query("url_score")
def url_score(t: Load) -> DataFrame:
    pages = t("pages").withColumns({"name": F.lit("東京デザインABK専門学校"), "title": F.lit("ABK 東京デザイン"), "excerpt": text.folded(F.col("html"))})
    s = numbers.url_score(F.col("url"), F.col("name"), F.lit("tokyo"), F.col("title"), F.col("excerpt"), {"東京": "tokyo", "デザイン": "design"})
    return pages.withColumn("s", s).select("page_id", "s.score", "s.decision", F.array_join(F.array_sort(F.map_keys("s.breakdown")), ",").alias("parts"))


ANCHOR = r"""'(?is)<a\b[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a\s*>'"""
LINKS_SQL = rf"""WITH h AS (SELECT page_id, url, regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->', '', 'g') AS html FROM pages), a AS (SELECT page_id, url, generate_subscripts(regexp_extract_all(html, {ANCHOR}, 1), 1) - 1 AS position, unnest(regexp_extract_all(html, {ANCHOR}, 1)) AS href, unnest(regexp_extract_all(html, {ANCHOR}, 2)) AS text FROM h),
f AS (SELECT page_id, position, href AS raw, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href WHEN starts_with(href, '//') THEN regexp_extract(url, '^([^:]+:)', 1) || href WHEN starts_with(href, '/') THEN lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)) || href ELSE regexp_replace(url, '[^/]*$', '') || href END AS href,
  trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM a)
SELECT page_id, position::INT AS position, 'anchor' AS source, href, text, CASE WHEN contains(href, '/wp-content/') THEN 'wordpress' WHEN contains(raw, '?') THEN 'cache_busted' ELSE 'direct' END AS pattern FROM f
UNION ALL SELECT page_id, 0, 'embed', lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)) || '/v?x=' || page_id, '', 'embed_cache_busted' FROM pages"""


@query("page_links", LINKS_SQL)
def page_links(t: Load) -> DataFrame:
    """SRC-25: the pages' own anchors, and a frame added to each."""
    frame = F.concat(F.col("html"), F.lit("<!-- <a href='/no'>no</a> --><iframe src='/v?x="), F.col("page_id").cast("string"), F.lit("'></iframe>"))
    return records.page_links(t("pages").withColumn("html", frame))


@query("candidate_rank")
def candidate_rank(t: Load) -> DataFrame:
    return records.ranked(records.page_links(t("pages")), 2026).select("page_id", "position", "href", "tier", "score", "rank", "dropped")


@query("text_class", r"SELECT doc_id, CASE WHEN regexp_full_match(coalesce(text, ''), '\s*') THEN 'image_only' WHEN contains(text, 'MIT License') OR contains(text, 'Apache License') THEN 'non_target' WHEN contains(text, 'the')::INT + contains(text, ' of ')::INT + contains(text, ' and ')::INT >= 2 THEN 'target' ELSE 'non_target' END AS class FROM documents")
def text_class(t: Load) -> DataFrame:
    return t("documents").select("doc_id", states.text_class(F.col("text"), ("the", " of ", " and "), ("MIT License", "Apache License")).alias("class"))


#: The documents hold no letters that compatibility folding changes; wide ones are put before them.
@query("text_normalise", r"SELECT doc_id, md5('ABC12' || regexp_replace(coalesce(text, ''), '\s+', '', 'g')) AS squeezed FROM documents")
def text_normalise(t: Load) -> DataFrame:
    return t("documents").select("doc_id", F.md5(text.squeezed(F.concat(F.lit("ＡＢ　Ｃ １２ "), F.coalesce("text", F.lit(""))))).alias("squeezed"))


@query("trust_tiers", "SELECT site_id, CASE method WHEN 'region_index' THEN 't1_authority_index' WHEN 'operator_manual' THEN 't3_operator_approved' ELSE 't4_search_candidate' END AS tier FROM site", "site")
def trust_tiers(t: Load) -> DataFrame:
    return t("site").select("site_id", states.trust_tier(F.col("method")).alias("tier"))


@query("eligible_documents", "SELECT document_id FROM document WHERE (status IS NULL OR status IN ('pending', 'transient_error', 'ocr_pending', 'in_progress')) AND doc_class <> 'non_target'", "document")
def eligible_documents(t: Load) -> DataFrame:
    return t("document").filter(report.eligible(F.col("status"), F.col("doc_class"), F.lit("p"))).select("document_id")


@query("url_list_errors", "SELECT s_suppkey, array_to_string(list_filter([CASE WHEN s_suppkey % 4 = 0 THEN 'name is empty' END, CASE WHEN s_suppkey % 6 = 0 THEN 'url is empty' END, CASE WHEN s_suppkey % 6 = 0 THEN 'url is no address' END], lambda x: x IS NOT NULL), '; ') AS errors FROM supplier")
def url_list_errors(t: Load) -> DataFrame:
    from veritab.sources.files import url_rows

    rows = t("supplier").select(F.col("s_suppkey").cast("string").alias("s_suppkey"), F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")).alias("name"), F.when(F.col("s_suppkey") % 6 != 0, F.lit("https://a.example.com")).alias("url"))
    return url_rows(rows).select(F.col("s_suppkey").cast("long").alias("s_suppkey"), F.array_join("errors", "; ").alias("errors"))


CELLS_SQL = """WITH c AS (SELECT page_id, unnest([0, 0, 1, 1, 2]) AS r, unnest([0, 1, 0, 1, 0]) AS c, unnest(['No', '学校 名', page_id::VARCHAR, '甲 & 乙', 'after']) AS text, unnest([NULL, NULL, NULL, lower(regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1)) || '/p' || page_id, NULL]) AS href, unnest([1, 1, 1, 1, 2]) AS tab FROM pages)
SELECT page_id, tab::INT AS tab, r::INT AS "row", c::INT AS col, text, href, r = 0 AS is_header FROM c"""


@query("html_table_cells", CELLS_SQL)
def html_table_cells(t: Load) -> DataFrame:
    """SRC-24: the pages have no tables, so two are put behind each."""
    from veritab.sources.files import html_tables

    tables = F.concat(F.lit("<table><tr><th>No</th><th>学校\n名</th></tr><tr><td>"), F.col("page_id").cast("string"), F.lit("</td><td><a href='/p"), F.col("page_id").cast("string"), F.lit("'>甲 &amp; 乙</a><a href='/q'></a></td></tr></table><table><tr><td> after </td></tr></table>"))
    return html_tables(t("pages").withColumn("html", F.concat("html", tables)))


@query("throttle_replay")
def throttle_replay(t: Load) -> DataFrame:
    """STM-06: state that depends on all decisions before it; tests hold it against a plain version.  Ten minutes of the
    events pass as a second, so that hosts are busy."""
    log = t("events").select((F.col("user_id") % 20).cast("string").alias("host"), (F.unix_timestamp(F.col("ts").cast("timestamp")) / 600).alias("at"), (F.col("event_type") != "error").alias("ok"), (F.col("event_id") % 17 == 0).alias("blocked"))
    return queues.throttle(log)


@query("ingest_units", """WITH a AS (SELECT n.unit_id, n.period, n.capacity, n.enrollment, p.enrollment AS prior, 2 + (n.capacity IS NOT NULL)::INT + 1 AS got FROM fact n LEFT JOIN fact p ON n.unit_id = p.unit_id AND n.period = p.period WHERE n.enrollment IS NOT NULL)
SELECT unit_id, period, CASE WHEN capacity IS NOT NULL OR enrollment IS NOT NULL THEN CASE WHEN round((CASE got WHEN 4 THEN 1.0 ELSE 0.5 END) * 0.4 + got / 4 * 0.4 + 0.2, 9) >= 0.85 THEN 'auto' ELSE 'auto_flag' END END AS verdict FROM a WHERE round((CASE got WHEN 4 THEN 1.0 ELSE 0.5 END) * 0.4 + got / 4 * 0.4 + 0.2, 9) >= 0.7""", "fact")
def ingest_units(t: Load) -> DataFrame:
    rows = t("fact").select("entity_id", "document_id", "unit_id", F.lit("unit").alias("name"), "period", "capacity", "enrollment", F.lit(1).alias("graduates"), F.lit(0).alias("dropouts"))
    return queues.ingest_units(rows, t("fact"), 2030).select("unit_id", "period", "verdict")


@query("stream_bucket_counts", BUCKET_SQL + " SELECT * FROM b", "evidence")
def stream_bucket_counts(t: Load) -> DataFrame:
    """The evidence log as a stream: the table is read as files until none is new, then the buckets are given."""
    import uuid

    from veritab.plans.views import ADAPTERS
    from veritab.streaming.state import checkpoint_dir

    events = t("events")
    spark = events.sparkSession
    path = events.inputFiles()[0].rsplit("/", 1)[0]
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet" if path.rsplit("/", 1)[1] != "events.parquet" else "*.parquet").parquet(path)
    rows = spark.sql(ADAPTERS["evidence"], events=stream)
    name = f"{checkpoint_dir(spark)}/buckets-{uuid.uuid4().hex}"
    queues.bucket_stream(rows, f"{name}-table", f"{name}-progress")
    return queues.latest_buckets(spark, f"{name}-table")


@query("stream_evidence_state", BUCKET_SQL + " SELECT * FROM b", "evidence")
def stream_evidence_state(t: Load) -> DataFrame:
    """STM-05: the same log in several files, of which the last brings rows once more, through state that expires."""
    import uuid

    from veritab.plans.views import ADAPTERS
    from veritab.streaming.state import checkpoint_dir

    events = t("events")
    spark = events.sparkSession
    name = f"{checkpoint_dir(spark)}/evidence-{uuid.uuid4().hex}"
    for part in range(3):
        # late rows come in the second part, repeated ones in the third
        events.filter(F.col("event_id") % 2 == part if part < 2 else F.col("event_id") % 5 == 0).coalesce(1).write.mode("append").parquet(f"{name}-log")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{name}-log")
    queues.evidence_stream(spark.sql(ADAPTERS["evidence"], events=stream), f"{name}-table", f"{name}-progress", 24 * 3_600_000)
    return queues.latest_buckets(spark, f"{name}-table")


# --- review work -------------------------------------------------------------------------------------------------

METHODS = ("region_index", "operator_manual")


def _items(t: Load) -> DataFrame:
    return t("events").select(F.col("event_id").alias("item_id"), F.when(F.col("event_type") == "error", "approved").when(F.col("event_type") == "click", "corrected").otherwise("pending").alias("status"), (F.col("event_id") % 4).alias("priority"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("confidence"))


ITEM_SQL = "WITH i AS (SELECT event_id AS item_id, CASE event_type WHEN 'error' THEN 'approved' WHEN 'click' THEN 'corrected' ELSE 'pending' END AS status, event_id % 4 AS priority, CASE WHEN event_id % 5 <> 0 THEN value END AS confidence FROM events)"


@query("pending_items", ITEM_SQL + " SELECT item_id, priority, confidence FROM i WHERE status = 'pending' ORDER BY priority, confidence DESC NULLS LAST, item_id LIMIT 200")
def pending_items(t: Load) -> DataFrame:
    return workflow.pending(_items(t), 200).select("item_id", "priority", "confidence")


@query("review_stats", ITEM_SQL + " SELECT count(*) AS total, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status <> 'pending') AS resolved, count(*) FILTER (status = 'pending' AND priority <= 1) AS urgent FROM i")
def review_stats(t: Load) -> DataFrame:
    return workflow.review_stats(_items(t))


@query("recent_actions", "SELECT event_id, user_id FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 50")
def recent_actions(t: Load) -> DataFrame:
    e = t("events").withColumns({"at": F.col("ts"), "id": F.col("event_id")})
    return workflow.recent(e, 50, event_type="error").select("event_id", "user_id")


@query("documents_to_enter", f"SELECT document_id, status FROM document WHERE status IN ('ocr_pending', 'parse_failed') AND (period = {PERIOD} OR period IS NULL) ORDER BY status, document_id DESC LIMIT 100", "document")
def documents_to_enter(t: Load) -> DataFrame:
    return workflow.documents_in(t("document"), ["ocr_pending", "parse_failed"], PERIOD, limit=100).select("document_id", "status")


@query("entities_by_name", "SELECT entity_id, name FROM entity WHERE active AND contains(name, '7') ORDER BY name, entity_id LIMIT 20", "entity")
def entities_by_name(t: Load) -> DataFrame:
    return workflow.found_by_name(t("entity"), "7").select("entity_id", "name")


MISSING_SQL = f"SELECT entity_id FROM entity WHERE active AND entity_id IN (SELECT entity_id FROM site WHERE method IN ('region_index', 'operator_manual')) AND entity_id NOT IN (SELECT entity_id FROM document WHERE doc_class = 'target' AND status = 'ingested' AND period = {PERIOD})"


@query("missing_target_entities", MISSING_SQL, "entity", "site", "document")
def missing_target_entities(t: Load) -> DataFrame:
    return workflow.missing_target(t("entity"), t("site"), t("document"), PERIOD, METHODS)


@query("stale_entities", f"WITH m AS ({MISSING_SQL}) SELECT entity_id, max(period) AS latest FROM m JOIN document USING (entity_id) WHERE doc_class = 'target' AND status = 'ingested' AND period < {PERIOD} GROUP BY 1", "entity", "site", "document")
def stale_entities(t: Load) -> DataFrame:
    return workflow.stale(t("entity"), t("site"), t("document"), PERIOD, METHODS)


@query("crawl_order", f"""SELECT site_id FROM site WHERE entity_id NOT IN (SELECT entity_id FROM document WHERE status = 'entity_mismatch') AND entity_id NOT IN (SELECT entity_id FROM document WHERE doc_class = 'target' AND status = 'ingested' AND period = {PERIOD})
ORDER BY list_position(['domain_override','operator_manual','seed_csv','region_index','official_site','owner_pattern','web_search'], method), entity_id, CASE WHEN lower(url) LIKE '%.pdf' OR NOT contains(lower(url), 'info') THEN 1 ELSE 0 END, site_id LIMIT 100""", "site", "document")
def crawl_order(t: Load) -> DataFrame:
    done = t("document").filter((F.col("doc_class") == "target") & (F.col("status") == "ingested") & (F.col("period") == PERIOD))
    return workflow.crawl_order(t("site"), t("document").filter("status = 'entity_mismatch'"), done, 100).select("site_id")


@query("year_overview", f"WITH p AS (SELECT entity_id, bool_or(period = {PERIOD}) AS n, bool_or(period < {PERIOD}) AS o, bool_or(period > {PERIOD}) AS l FROM document WHERE doc_class = 'target' AND status = 'ingested' AND entity_id IN (SELECT entity_id FROM entity WHERE active) GROUP BY 1) SELECT count(*) FILTER (n) AS current, count(*) FILTER (o AND NOT n) AS stale, count(*) FILTER (l) AS future FROM p", "entity", "document")
def year_overview(t: Load) -> DataFrame:
    return workflow.year_overview(t("entity"), t("document"), PERIOD)


@query("url_stats", "SELECT count(DISTINCT e.entity_id) AS entities, count(DISTINCT s.entity_id) AS with_url, count(DISTINCT CASE WHEN verified THEN e.entity_id END) AS verified, count(*) FILTER (method IN ('region_index', 'operator_manual')) AS trusted_sites FROM entity e LEFT JOIN site s ON e.entity_id = s.entity_id WHERE active", "entity", "site")
def url_stats(t: Load) -> DataFrame:
    return workflow.url_stats(t("entity"), t("site"))


@query("worst_verdicts", "SELECT document_id, count(*) AS rows, round(avg(confidence), 6) AS mean_confidence, arg_max(CASE WHEN confidence >= 0.85 THEN 'auto' WHEN confidence >= 0.7 THEN 'auto_flag' WHEN confidence >= 0.5 THEN 'review_pending' ELSE 'rejected' END, -confidence) AS worst FROM fact WHERE confidence IS NOT NULL GROUP BY 1", "fact")
def worst_verdicts(t: Load) -> DataFrame:
    return workflow.worst_verdict(t("fact"))


@query("strict_yield", STATUS_SQL + ", u AS (SELECT 'url_status' AS dimension, url_status AS value FROM st UNION ALL SELECT 'document_status', document_status FROM st UNION ALL SELECT 'extract_status', extract_status FROM st UNION ALL SELECT 'blocking_reason', coalesce(blocking_reason, '-') FROM st) SELECT dimension, value, count(*) AS n, count(*) / (SELECT count(*) FROM st) AS share FROM u GROUP BY ALL", *FOUR)
def strict_yield(t: Load) -> DataFrame:
    return workflow.strict_yield(_status(t))


@query("writer_plan", """WITH q AS (SELECT *, CASE WHEN lower(url) LIKE '%.pdf' THEN 3 WHEN contains(lower(url), 'info') THEN 2 ELSE 1 END AS r FROM site), h AS (SELECT entity_id, max(r) AS best, arg_min(site_id, r::BIGINT * 1000000000 + site_id) AS worst FROM q GROUP BY 1)
SELECT c.entity_id, 'https://a.example.com/x.pdf' AS url, CASE WHEN best IS NULL THEN 'add' WHEN best < 3 THEN 'upgrade' ELSE 'noop' END AS action, CASE WHEN best < 3 THEN worst END AS replaces FROM entity c LEFT JOIN h USING (entity_id)""", "entity", "site")
def writer_plan(t: Load) -> DataFrame:
    return workflow.writer_plan(t("site"), t("entity").select("entity_id", F.lit("https://a.example.com/x.pdf").alias("url")))


@query("inferred_sites", "SELECT entity_id, 'https://' || lower(replace(owner, ' ', '')) || '.example.com' AS url, 'owner_pattern' AS method FROM entity WHERE active AND entity_id NOT IN (SELECT entity_id FROM site)", "entity", "site")
def inferred_sites(t: Load) -> DataFrame:
    domains = t("entity").select("owner").distinct().withColumn("domain", F.concat(F.lit("https://"), F.lower(F.replace("owner", F.lit(" "), F.lit(""))), F.lit(".example.com")))
    return workflow.inferred_sites(t("entity"), t("site"), domains)


@query("merged_proposals", "SELECT c_custkey AS entity_id, 'old' AS kind FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'new' FROM customer WHERE c_custkey % 2 <> 0 AND c_custkey % 3 = 0")
def merged_proposals(t: Load) -> DataFrame:
    c = t("customer").select(F.col("c_custkey").alias("entity_id"))
    return workflow.with_new(c.filter("entity_id % 2 = 0").withColumn("kind", F.lit("old")), c.filter("entity_id % 3 = 0").withColumn("kind", F.lit("new")), ["entity_id"])


@query("refused_aliases", "SELECT entity_id, alias FROM (SELECT s_suppkey AS entity_id, 'Supplier#' || lpad((s_suppkey % 70)::VARCHAR, 9, '0') AS alias FROM supplier) p WHERE EXISTS (SELECT 1 FROM supplier s WHERE s.s_name = p.alias AND s.s_suppkey <> p.entity_id)")
def refused_aliases(t: Load) -> DataFrame:
    s = t("supplier").select(F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("name"))
    p = s.select("entity_id", F.concat(F.lit("Supplier#"), F.lpad((F.col("entity_id") % 70).cast("string"), 9, "0")).alias("alias"))
    return workflow.approved_aliases(p, p.filter("false"), s)[1]


@query("comparison_run", COMPARE_SQL + "SELECT count(*) AS rows, count(*) FILTER (status = 'match') AS matches FROM labelled", "reviewed", "external")
def comparison_run(t: Load) -> DataFrame:
    header, _ = workflow.comparison_run(diff.compare_external(t("reviewed"), t("external")), b"file", "system")
    return header.select("rows", "matches")
