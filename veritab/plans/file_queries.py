"""Queries of readers, sinks and streams: tables are written to the shared folder in a source's format and read back."""

from __future__ import annotations

import csv
import io
import json
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from veritab.operators import export, ingest, records
from veritab.plans.registry import Load, query
from veritab.plans.text_queries import by_case
from veritab.sources import files
from veritab.streaming import queues
from veritab.streaming.state import checkpoint_dir


def _place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}-{name}"


def _csv(rows: list, encoding: str) -> bytes:
    out = io.StringIO()
    csv.writer(out).writerows(rows)
    return out.getvalue().encode(encoding)


@query("code_list_rows", "SELECT 'H' || s_suppkey AS code, s_name || '専門学校' AS name FROM supplier WHERE s_suppkey % 3 <> 0 AND s_suppkey % 5 <> 0")
def code_list_rows(t: Load) -> DataFrame:
    """SRC-05: suppliers as a list of codes in cp932."""
    s = t("supplier")
    path = _place(s.sparkSession, "codes.csv")
    rows = [[f"H{r.s_suppkey}", "H1(専修)" if r.s_suppkey % 3 else "B1", "01(北海道)", r.s_name + "専門学校", "東京都", "" if r.s_suppkey % 5 else "2020"] for r in s.orderBy("s_suppkey").collect()]
    export.write_bytes(s.sparkSession, path, _csv([["学校コード", "種別", "都道府県", "名称", "住所", "廃止日"], *rows], "cp932"))
    return files.code_list(s.sparkSession, path).select("code", "name")


EXTERNAL_SQL = "SELECT n_nationkey AS id, n_name || '校' AS name, f AS file FROM nation, unnest(['a', 'b', 'c']) AS x(f) WHERE n_nationkey % 3 = (CASE f WHEN 'a' THEN 0 WHEN 'b' THEN 1 ELSE 2 END)"


@query("external_files", EXTERNAL_SQL)
def external_files(t: Load) -> DataFrame:
    """SRC-09, SRC-10, SRC-11: a third of the nations in each of UTF-8 with a mark, cp932, and the first sheet of a workbook."""
    n = t("nation")
    spark, rows = n.sparkSession, [(r.n_nationkey, r.n_name + "校") for r in n.orderBy("n_nationkey").collect()]
    part = lambda k: [r for r in rows if r[0] % 3 == k]
    contents = {"a.csv": _csv([("id", "名称"), *part(0)], "utf-8-sig"), "b.csv": _csv([("id", "名称"), *part(1)], "cp932"), "c.xlsx": export.workbook({"One": (["id", "名称"], part(2)), "Two": (["id"], [[-1]])})}
    out = None
    for name, content in contents.items():
        path = _place(spark, name)
        export.write_bytes(spark, path, content)
        one = files.tabular(spark, path).select(F.col("cells")["id"].cast("long").alias("id"), F.col("cells")["名称"].alias("name"), F.lit(name[0]).alias("file"))
        out = one if out is None else out.unionByName(one)
    return out


@query("target_institutions", "SELECT 'H' || s_suppkey AS code, s_name AS name FROM supplier WHERE s_suppkey % 2 = 0")
def target_institutions(t: Load) -> DataFrame:
    """SRC-06."""
    s = t("supplier")
    path = _place(s.sparkSession, "targets.xlsx")
    rows = [[f"H{r.s_suppkey}", r.s_name, "東京都", "専門学校" if r.s_suppkey % 2 == 0 else "大学"] for r in s.orderBy("s_suppkey").collect()]
    export.write_bytes(s.sparkSession, path, export.workbook({"一覧": (["title"], [["x"], ["y"], ["コード", "名称", "都道府県", "種別"], *rows])}))
    return files.target_institutions(s.sparkSession, path).select("code", "name")


MASTER_SQL = """WITH e AS (SELECT s_suppkey AS k, s_name AS name FROM supplier), p AS (SELECT unnest([2024, 2025]) AS period)
SELECT 'status' AS sheet, name, period::INT AS period, CASE (k + period) % 3 WHEN 0 THEN 'collected' WHEN 1 THEN 'stale' ELSE 'pending' END AS text, NULL::BIGINT AS value FROM e, p
UNION ALL SELECT 'support', name, 2025, NULL, k FROM e WHERE k % 2 = 0 UNION ALL SELECT 'unit', name, period::INT, 'u' || k, k * 10 + period FROM e, p WHERE NOT (k % 4 = 0 AND period = 2024)"""


@query("master_round_trip", MASTER_SQL)
def master_round_trip(t: Load) -> DataFrame:
    """SNK-01, SRC-01: a master workbook of suppliers written and read again."""
    s = t("supplier").select(F.col("s_suppkey").alias("entity_id"), F.lit("ASIA").alias("region"), F.lit("o").alias("owner"), F.col("s_name").alias("name"))
    spark = s.sparkSession
    per = s.select("entity_id", F.explode(F.array(F.lit(2024), F.lit(2025))).alias("period"))
    k = F.col("entity_id")
    word = F.when((k + F.col("period")) % 3 == 0, "〇").when((k + F.col("period")) % 3 == 1, "△（前年）").otherwise("?")
    status = per.select("entity_id", "period", word.alias("status"), F.lit(True).alias("is_current"))
    fact = per.filter(~((k % 4 == 0) & (F.col("period") == 2024))).select("entity_id", F.concat(F.lit("u"), k.cast("string")).alias("unit_id"), "period", (k * 10 + F.col("period")).alias("capacity"), F.lit(None).cast("long").alias("enrollment"), F.lit(True).alias("is_current"))
    support = s.filter("entity_id % 2 = 0").select("entity_id", F.lit(2025).alias("period"), F.col("entity_id").alias("total"))
    path = _place(spark, "master.xlsx")
    export.write_workbook(path, export.master_sheets(s, status, fact, support, None, [2024, 2025], ["capacity", "enrollment"]))
    back = files.master_workbook(spark, path)
    none = F.lit(None)
    out = back["status"].select(F.lit("status").alias("sheet"), "name", "period", F.col("status").alias("text"), none.cast("long").alias("value"))
    out = out.unionByName(back["support"].select(F.lit("support").alias("sheet"), "name", "period", none.cast("string").alias("text"), F.col("total").alias("value")))
    return out.unionByName(back["unit"].select(F.lit("unit").alias("sheet"), "name", "period", F.col("unit").alias("text"), F.col("capacity").alias("value")))


@query("template_columns", "SELECT unnest([2, 4]) AS col, unnest([2024, 2025]) AS period, 3::BIGINT AS header_row, 1 AS name_col")
def template_columns(t: Load) -> DataFrame:
    """SRC-30."""
    spark = t("region").sparkSession
    path = _place(spark, "template.xlsx")
    export.write_bytes(spark, path, export.workbook({"様式": (["2023年の様式"], [["記入例"], ["No", "学校名", "2024年度", "備考", "2025"], [1, "甲", 2, None, 3]])}))
    return files.template_schema(files.spreadsheet(spark, path)).select(F.col("col").cast("int").alias("col"), "period", "header_row", F.col("name_col").cast("int").alias("name_col"))


@query("gap_report", "SELECT s_suppkey AS row_id, s_name AS name, CASE WHEN s_suppkey % 5 = 0 THEN 'entity_missing' ELSE 'no_rows_for_period' END AS gap_reason FROM supplier WHERE s_suppkey % 5 = 0 OR s_suppkey % 2 = 1")
def gap_report(t: Load) -> DataFrame:
    """SNK-02, SNK-03, SNK-04, SNK-05: a template's gaps as CSV, read again; its filled rows as a workbook."""
    s = t("supplier").select(F.col("s_suppkey").alias("row_id"), F.col("s_name").alias("name"))
    spark = s.sparkSession
    matches = s.filter("row_id % 5 <> 0").select("row_id", F.col("row_id").alias("entity_id"))
    sums = s.filter("row_id % 2 = 0").select(F.col("row_id").alias("entity_id"), F.col("row_id").alias("capacity"))
    filled, gaps = export.overlay(s, matches, sums, ["capacity"])
    export.write_workbook(_place(spark, "filled.xlsx"), {"様式": filled.orderBy("row_id")})
    path = _place(spark, "gaps")
    export.write_csv(gaps, path, ["gap_reason", "name", "row_id"])
    return spark.read.schema("row_id long, name string, gap_reason string").option("header", True).csv(path)


@query("archived_members", "SELECT 'a' || n_nationkey || '.pdf' AS member, n_name AS content FROM nation WHERE n_nationkey % 2 = 0")
def archived_members(t: Load) -> DataFrame:
    """SRC-17."""
    n = t("nation")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for r in n.orderBy("n_nationkey").collect():
            z.writestr(f"a{r.n_nationkey}.{'pdf' if r.n_nationkey % 2 == 0 else 'txt'}", r.n_name)
    path = _place(n.sparkSession, "a.zip")
    export.write_bytes(n.sparkSession, path, out.getvalue())
    return files.zip_members(n.sparkSession, path).select("member", F.col("content").cast("string").alias("content"))


TSV_SQL = "SELECT l_orderkey AS doc, l_linenumber::INT AS line_no, 'w' || min(l_partkey) || ' x' AS text, ((min(l_partkey) % 90) - 0.5)::DOUBLE AS mean FROM lineitem GROUP BY 1, 2"


@query("recognised_lines", TSV_SQL)
def recognised_lines(t: Load) -> DataFrame:
    """SRC-15: each order as one page of tab-separated words, two on a line, with a bad row and one of another level."""
    word = lambda n, text, conf: F.concat_ws("\t", F.lit("5\t1\t1\t1"), F.col("l_linenumber").cast("string"), F.lit(f"{n}\t0\t0\t0\t0"), conf, text)
    lines = F.concat_ws("\n", word(1, F.concat(F.lit("w"), F.col("l_partkey").cast("string")), (F.col("l_partkey") % 90).cast("string")), word(2, F.lit("x"), (F.col("l_partkey") % 90 - 1).cast("string")))
    one = t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    rows = one.groupBy(F.col("l_orderkey").alias("doc")).agg(F.concat(F.lit("level\tpage\n4\t1\t1\t1\t1\t0\t0\t0\t0\t0\t-1\t\n5\tx\t1\t1\t9\t1\t0\t0\t0\t0\t50\tbad\n"), F.array_join(F.collect_list(lines), "\n")).alias("tsv"))
    out = files.ocr_words(rows, "tsv")
    return out.select("doc", "line_no", "text", F.aggregate("confidences", F.lit(0.0), lambda a, c: a + c / 2).alias("mean"))


@query("evidence_files", "SELECT entity_id, reason, count(*) AS n FROM evidence GROUP BY 1, 2", "evidence")
def evidence_files(t: Load) -> DataFrame:
    """SNK-06, SRC-18: the evidence log appended in two parts, a malformed line among them, and read again."""
    e = t("evidence").select("entity_id", F.col("url").alias("pdf_url"), "reason", "pdf_type", F.create_map(F.lit("k"), F.lit("v")).alias("extra"), F.col("position"))
    path = _place(e.sparkSession, "evidence")
    for half in (0, 1):
        export.append_jsonl(e.filter(F.col("position") % 2 == half).drop("position"), path)
    t("region").select(F.lit('{"entity_id": 1, "reason"').alias("value")).write.mode("append").text(path)
    return files.evidence_log(e.sparkSession, path).groupBy("entity_id", "reason").agg(F.count("*").alias("n"))


@query("prediction_files", "SELECT 'e' || o_orderkey AS entry_id, o_orderstatus AS outcome FROM orders WHERE o_orderkey % 4 <> 0")
def prediction_files(t: Load) -> DataFrame:
    """SRC-20: every fourth line is malformed."""
    o = t("orders")
    path = _place(o.sparkSession, "predictions")
    line = F.to_json(F.struct(F.concat(F.lit("e"), F.col("o_orderkey").cast("string")).alias("entry_id"), F.col("o_orderstatus").alias("outcome")))
    o.select(F.when(F.col("o_orderkey") % 4 == 0, "{not json").otherwise(line).alias("value")).write.text(path)
    return files.predictions(o.sparkSession, path).select("entry_id", "outcome")


@query("gold_files", "SELECT s_name AS doc, p::INT AS pos, 'u' || s_suppkey || p AS name, (s_suppkey * 10 + p)::INT AS capacity FROM supplier, unnest([0, 1]) AS x(p)")
def gold_files(t: Load) -> DataFrame:
    """SRC-21: an annotation of two units for each supplier."""
    s = t("supplier")
    path = _place(s.sparkSession, "annotations")
    k = F.col("s_suppkey")
    unit = lambda p: F.struct(F.concat(F.lit("u"), k.cast("string"), F.lit(str(p))).alias("name"), (k * 10 + p).alias("capacity"))
    s.select(F.to_json(F.struct(F.col("s_name").alias("source_pdf"), F.lit("n").alias("school_name"), F.array(unit(0), unit(1)).alias("departments"))).alias("value")).write.text(path)
    return files.annotations(s.sparkSession, path, multi_line=False).select("doc", "pos", "name", "capacity")


@query("manifest_errors", "SELECT 's' || s_suppkey AS entity_key, CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'no authority basis;nobody has confirmed it;no evidence' ELSE 'nobody has confirmed it;no evidence' END AS errors FROM supplier")
def manifest_errors(t: Load) -> DataFrame:
    """SRC-22."""
    s = t("supplier")
    path = _place(s.sparkSession, "manifest.json")
    basis = ({"source_type": "x", "confirmed_by": "me", "evidence": [{"kind": "url", "value": "u"}]}, None, {"source_type": "x", "evidence": []})
    schools = [{"school_key": f"s{r.s_suppkey}", "school_name": r.s_name, "fiscal_year": 2026, "authority_basis": basis[r.s_suppkey % 3]} for r in s.orderBy("s_suppkey").collect()]
    export.write_bytes(s.sparkSession, path, json.dumps({"manifest_version": 1, "schools": schools}).encode())
    return files.manifest(s.sparkSession, path).select("entity_key", F.array_join("errors", ";").alias("errors"))


@query("sitemap_urls", "SELECT page_id, 0 AS position, url FROM pages UNION ALL SELECT page_id, 1, url || '/s.xml' FROM pages")
def sitemap_urls(t: Load) -> DataFrame:
    """SRC-26."""
    xml = F.concat(F.lit("<urlset><url><LOC> "), "url", F.lit(" </LOC></url></urlset>\nSitemap: "), "url", F.lit("/s.xml\n"))
    return files.sitemap_locations(t("pages").select("page_id", xml.alias("xml")))


INDEX_SQL = """WITH p AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/]+)', 1) AS o FROM pages)
SELECT page_id, '甲学校' AS name, o || '/a.pdf' AS href FROM p UNION ALL SELECT page_id, '乙大学', o || '/free.pdf' FROM p UNION ALL SELECT page_id, '丁学院', o || '/new.pdf' FROM p"""


@query("index_pages", INDEX_SQL)
def index_pages(t: Load) -> DataFrame:
    """SRC-23, SRC-24, JOIN-27: a table with and one without an address in each page, one of withdrawn names, and free links."""
    o = F.regexp_extract("url", "^([a-z]+://[^/]+)", 1)
    html = F.lit(
        "<p>intro</p><table><tr><th>No</th><th>学校名</th></tr><tr><td>1</td><td><a href='/a.pdf'>甲学校</a></td></tr><tr><td>1</td><td><a href='/a.pdf'>甲学校</a></td></tr><tr><td>2</td><td>乙大学</td></tr></table>"
        "<table><tr><th>名称</th><th>取消年月日</th></tr><tr><td>丙学校</td><td>2024</td></tr></table>"
    )
    pages = t("pages").select("page_id", "url", F.concat("html", html).alias("html"), o.alias("o"))
    # the page's own markup has no table, and its own links name no institution
    cells = files.html_tables(pages)
    links = pages.select("page_id", F.explode(F.array(*[F.struct(F.lit(n).alias("text"), F.concat("o", F.lit(h)).alias("href")) for n, h in (("乙大学", "/free.pdf"), ("丙 学校", "/gone.pdf"), ("丁学院", "/new.pdf"), ("地図", "/map"))])).alias("l")).select("page_id", "l.*")
    return files.index_rows(cells, links)


@query("outbox_log", "SELECT 'a' || c_custkey AS action_id, count(*) AS n FROM customer GROUP BY 1")
def outbox_log(t: Load) -> DataFrame:
    """SNK-07: actions flushed three times, some twice in one flush; each is in the log once."""
    c = t("customer").select(F.concat(F.lit("a"), F.col("c_custkey").cast("string")).alias("action_id"), "c_custkey")
    path = _place(c.sparkSession, "outbox")
    actions = c.select("action_id")
    export.flush_outbox(actions.join(c.filter("c_custkey % 2 = 0").select("action_id"), "action_id", "left_semi").unionByName(c.filter("c_custkey % 4 = 0").select("action_id")), path)
    export.flush_outbox(actions, path)
    export.flush_outbox(actions, path)
    return c.sparkSession.read.schema("action_id string").json(path).groupBy("action_id").agg(F.count("*").alias("n"))


@query("outbox_stream", "SELECT 'a' || c_custkey AS action_id, count(*) AS n FROM customer GROUP BY 1")
def outbox_stream(t: Load) -> DataFrame:
    """SNK-07: actions as files of a stream in three flushes, half of them twice; each is in the log once."""
    c = t("customer").select(F.concat(F.lit("a"), F.col("c_custkey").cast("string")).alias("action_id"), "c_custkey")
    spark = c.sparkSession
    source, path, progress = (_place(spark, n) for n in ("actions", "outbox", "progress"))
    for part in ("c_custkey % 2 = 0", "c_custkey % 3 <> 0", "true"):
        c.filter(part).select("action_id").write.mode("append").parquet(source)
        queues.outbox_stream(spark.readStream.schema("action_id string").parquet(source), path, progress)
    return spark.read.schema("action_id string").json(path).groupBy("action_id").agg(F.count("*").alias("n"))


# --- ingest and streams ------------------------------------------------------------------------------------------

#: A document of each order for its customer; units are its lines.
INGEST_SQL = """WITH d AS (SELECT o_orderkey AS document_id, o_custkey AS entity_id, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE year(o_orderdate) END AS period, o_orderkey % 7 = 0 AS foreign_name FROM orders),
good AS (SELECT * FROM d WHERE NOT foreign_name AND period IS NOT NULL), newest AS (SELECT entity_id, period, max(document_id) AS document_id FROM good GROUP BY ALL),
u AS (SELECT DISTINCT n.document_id, l_linenumber, l_linenumber IN (2, 3) AS blank FROM newest n JOIN lineitem ON l_orderkey = n.document_id),
per AS (SELECT document_id, count(*) AS units, count(*) FILTER (NOT blank) AS written FROM u WHERE l_linenumber <> 4 GROUP BY 1)
SELECT d.document_id, CASE WHEN foreign_name THEN 'entity_mismatch' WHEN d.period IS NULL THEN 'period_unknown' WHEN n.document_id IS NULL THEN 'superseded' WHEN p.units IS NULL THEN 'no_units' WHEN p.written = 0 THEN 'review_pending' ELSE 'ingested' END AS status,
  CASE WHEN foreign_name OR d.period IS NULL OR n.document_id IS NULL THEN 0 ELSE coalesce(p.written, 0) END AS written FROM d LEFT JOIN newest n ON d.document_id = n.document_id LEFT JOIN per p ON d.document_id = p.document_id"""


def _parsed(t: Load) -> tuple[DataFrame, ...]:
    name = F.concat(F.lit("Customer Institute "), F.col("o_custkey").cast("string"))
    documents = t("orders").select(F.col("o_orderkey").alias("document_id"), F.col("o_custkey").alias("entity_id"), F.when(F.col("o_orderkey") % 7 == 0, "Other").otherwise(name).alias("parsed_name"), F.when(F.col("o_orderkey") % 11 != 0, F.year("o_orderdate")).alias("period"))
    line = F.col("l_linenumber")
    # line 2 tells nothing but its enrolment and line 3 lacks one figure, so both call for review; line 4 has no enrolment
    full = lambda c: F.when(line != 2, c).cast("long")
    units = t("lineitem").select(
        F.col("l_orderkey").alias("document_id"), F.concat(F.lit("unit"), line.cast("string")).alias("unit"), F.when(line != 3, full(F.col("l_quantity"))).alias("capacity"), F.when(line != 4, F.lit(40)).cast("long").alias("enrollment"),
        full(F.lit(10)).alias("graduates"), full(F.lit(0)).alias("dropouts"),
    )
    support = t("orders").select(F.col("o_orderkey").alias("document_id"), *[F.lit(n).cast("long").alias(c) for c, n in zip(ingest.SUPPORT, (1, 2, 3, None), strict=True)])
    names = t("customer").select(F.col("c_custkey").alias("entity_id"), F.concat(F.lit("customer institute"), F.col("c_custkey").cast("string")).alias("name"))
    return documents, units, support, names


def _ingested(t: Load) -> ingest.Ingested:
    documents, units, support, names = _parsed(t)
    nothing = documents.filter("false").select("entity_id", F.lit("").alias("unit"), "period", F.lit(1).alias("revision"), *[F.lit(None).cast("long").alias(m) for m in ingest.MEASURES])
    recipients = documents.filter("false").select("entity_id", "period", F.lit(1).alias("revision"), *[F.lit(None).cast("long").alias(m) for m in ingest.SUPPORT])
    return ingest.ingest(documents, units, support, names, nothing, recipients, 2026)


@query("ingest_states", INGEST_SQL)
def ingest_states(t: Load) -> DataFrame:
    """UPD-01: the state that each document ends in."""
    return _ingested(t).states


@query("ingest_support", "SELECT o_custkey AS entity_id, year(o_orderdate) AS period, max(o_orderkey) AS document_id, 1 AS revision FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 GROUP BY 1, 2")
def ingest_support(t: Load) -> DataFrame:
    """UPD-01: the support rows that are appended."""
    return _ingested(t).support.select("entity_id", "period", "document_id", F.col("revision").cast("int").alias("revision"))


QUEUE_SQL = """SELECT event_id AS document_id, CASE WHEN event_type = 'error' THEN 'parse_failed' ELSE 'ingested' END AS status, CASE WHEN event_type = 'error' THEN 'ValueError: no such page ' || event_id END AS error FROM events"""


@query("document_queue", QUEUE_SQL)
def document_queue(t: Load) -> DataFrame:
    """STM-01, STM-03, STM-04: events as documents, claimed by a stream, each parsed on its own: those that fail leave the
    others ingested; those that time out are taken up by a second run; a third finds nothing new."""
    events = t("events")
    spark = events.sparkSession
    source, told, progress = (_place(spark, n) for n in ("documents", "states", "progress"))
    text = F.concat_ws(" ", F.col("event_type"), F.col("event_id").cast("string"))
    events.select(F.col("event_id").alias("document_id"), text.alias("text")).write.parquet(source)

    def parse(text: str, late: bool = True) -> str:
        kind, number = text.split()
        if kind == "error":
            raise ValueError(f"no such page {number}")
        if late and int(number) % 97 == 0:
            raise TimeoutError("too slow")
        return kind

    schema = "document_id long, text string"
    for _ in range(2):
        queues.process_documents(spark.readStream.schema(schema).parquet(source), lambda batch: queues.outcomes(batch, parse, "text"), told, progress)
    for run in (1, 2):
        queues.retry(spark.read.schema(schema).parquet(source), lambda rows: queues.outcomes(rows, lambda x: parse(x, False), "text"), told, run)
    return queues.latest_states(queues.read_states(spark, told))


@query("queue_writes", "SELECT event_id AS document_id, 0 AS run FROM events UNION ALL SELECT event_id, 1 FROM events WHERE event_id % 97 = 0 AND event_type <> 'error'")
def queue_writes(t: Load) -> DataFrame:
    """STM-01: every write of a state: each document's once, also where the stream's batch is run again after a crash, and
    one more of those that timed out."""
    events = t("events")
    spark = events.sparkSession
    source, told, progress = (_place(spark, n) for n in ("documents", "states", "progress"))
    events.select(F.col("event_id").alias("document_id"), "event_type").write.parquet(source)
    late = F.when((F.col("document_id") % 97 == 0) & (F.col("event_type") != "error"), "transient_error").otherwise("ingested")

    def crashes(batch: DataFrame, number: int) -> None:
        queues.written_batch(batch.select("document_id", late.alias("status"), F.lit(None).cast("string").alias("error")), told, number)
        raise RuntimeError("lost before the commit")

    stream = lambda: spark.readStream.schema("document_id long, event_type string").parquet(source)
    try:
        queues.process_new(stream(), crashes, progress)
    except StreamingQueryException:
        pass
    queues.process_documents(stream(), lambda batch: batch.select("document_id", late.alias("status")), told, progress)
    queues.retry(spark.read.schema("document_id long, event_type string").parquet(source), lambda rows: rows.select("document_id", F.lit("ingested").alias("status")), told, 1)
    return queues.read_states(spark, told).select("document_id", "run")


@query("retried_documents", "SELECT n_nationkey AS document_id, 'transient_error' AS status, 'OSError: gone' AS error FROM nation")
def retried_documents(t: Load) -> DataFrame:
    """STM-01: documents that could not be read stay to be taken up again."""
    n = t("nation").select(F.col("n_nationkey").alias("document_id"))
    spark = n.sparkSession
    source, told, progress = (_place(spark, x) for x in ("documents", "states", "progress"))
    n.write.parquet(source)

    def fails(_: int) -> str:
        raise OSError("gone")

    queues.process_documents(spark.readStream.schema("document_id long").parquet(source), lambda batch: queues.outcomes(batch, fails, "document_id"), told, progress)
    table = queues.read_states(spark, told)
    return queues.failed(table).join(queues.retried(n, table), "document_id", "left_semi")


@query("sheet_statuses", "SELECT c_custkey AS id, (2024 + y)::INT AS period, CASE (c_custkey + y) % 3 WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE 3 END::BIGINT AS capacity FROM customer, unnest([0, 1]) AS x(y) WHERE (c_custkey + y) % 3 <> 1")
def sheet_statuses(t: Load) -> DataFrame:
    """SRC-03: blocks of one column for each of two periods."""
    cell = lambda y: F.when((F.col("c_custkey") + y) % 3 == 0, "1").when((F.col("c_custkey") + y) % 3 == 1, "-").otherwise("3.7")
    sheet = t("customer").select(F.col("c_custkey").alias("id"), cell(0).alias("c0"), cell(1).alias("c1"))
    return records.period_blocks(sheet, ["id"], {2024: 0, 2025: 1}, ["capacity"])


@query("intake_errors", "SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'name is empty;file type is not accepted' WHEN 2 THEN 'period is out of range' ELSE 'page address is no URL' END AS errors FROM customer")
def intake_errors(t: Load) -> DataFrame:
    """FLT-15."""
    key = "c_custkey"
    e = records.intake_errors(by_case(key, "n", " ", "n", "n"), by_case(key, 2025, 2025, 1990, 2025), by_case(key, None, None, None, "ftp://x"), by_case(key, "a.pdf", "a.exe", "b.ZIP", "c.csv"), 2026)
    return t("customer").select(F.col(key).alias("id"), F.array_join(e, ";").alias("errors"))
