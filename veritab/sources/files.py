"""Readers.  Schemas are given, never inferred, and bad rows do not end a job."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import islice
from typing import IO
from urllib.parse import urljoin
from xml.etree import ElementTree
from zipfile import ZipFile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def code_list(spark: SparkSession, path: str, kind: str = "H1") -> DataFrame:
    """SRC-05: a national code list in cp932 (which Spark's CSV reader does not know): rows of a kind that have no
    abolition date.  Columns by place: code, type, region, name, address, abolition date."""
    rows = csv_cells(spark, path)
    named = rows.filter("row > 0").select(*[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(("code", "type_code", "region", "name", "address", "ended"))])
    return named.filter(F.col("type_code").contains(kind) & (F.coalesce("ended", F.lit("")) == ""))


def csv_text(content: bytes) -> str:
    """A CSV file's text: UTF-8 with or without mark, or else cp932."""
    try:
        return content.decode("utf-8-sig")
    except UnicodeDecodeError:
        return content.decode("cp932", "replace")


def csv_cells(spark: SparkSession, path: str) -> DataFrame:
    """(path, row, cells) of CSV files by place, the header being row 0."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                rows = list(csv.reader(io.StringIO(csv_text(content))))
                yield pd.DataFrame({"path": p, "row": range(len(rows)), "cells": rows}, columns=["path", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(work, "path string, row long, cells array<string>")


def csv_with_fallback(spark: SparkSession, path: str) -> DataFrame:
    """SRC-09, SRC-11: (path, row, cells) of CSV files by their headers; the encoding is decided by file."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                rows = list(csv.DictReader(io.StringIO(csv_text(content))))
                yield pd.DataFrame({"path": p, "row": range(len(rows)), "cells": [{k: v for k, v in r.items() if k} for r in rows]}, columns=["path", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(work, "path string, row long, cells map<string,string>")


def _elements(file: IO[bytes], parent: str, name: str) -> Iterator[ElementTree.Element]:
    """The elements of a name in an element, one by one; each is dropped before the next is read."""
    held = None
    for event, x in ElementTree.iterparse(file, ("start", "end")):
        if event == "start" and x.tag == f"{_MAIN}{parent}":
            held = x
        elif event == "end" and x.tag == f"{_MAIN}{name}":
            yield x
            if held is not None:
                held.clear()


#: Rows of a sheet, and pages, that a worker holds at once.
SHEET_BATCH, PAGE_BATCH = 2_000, 256


def sheet_rows(content: bytes, sheet: str | None = None) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row from 1, cells) of a spreadsheet file, by the standard library; cells are text."""
    with ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            with z.open("xl/sharedStrings.xml") as f:
                shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in _elements(f, "sst", "si")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            if sheet is not None and s.get("name") != sheet:
                continue
            target = targets[s.get(f"{_REL}id")].lstrip("/")
            sheet_file = z.open(target if target.startswith("xl/") else f"xl/{target}")
            for n, row in enumerate(_elements(sheet_file, "sheetData", "row"), 1):
                cells: list[str | None] = []
                for c in row.iter(f"{_MAIN}c"):
                    place = re.match("[A-Z]+", c.get("r") or "")
                    at = len(cells)
                    if place:
                        at = 0
                        for letter in place[0]:
                            at = at * 26 + ord(letter) - 64
                        at -= 1
                    cells += [None] * (at + 1 - len(cells))
                    value, text = c.find(f"{_MAIN}v"), c.find(f"{_MAIN}is")
                    if text is not None:
                        cells[at] = "".join(t.text or "" for t in text.iter(f"{_MAIN}t"))
                    elif value is not None:
                        cells[at] = shared[int(value.text)] if c.get("t") == "s" else value.text
                yield s.get("name"), int(row.get("r") or n), cells


def _some(rows: Iterator, n: int) -> Iterator[list]:
    while some := list(islice(rows, n)):
        yield some


def spreadsheet(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """(path, sheet, position, row, cells) of spreadsheet files; position is the sheet's in its file, and one file is one
    task's work."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                turn: dict[str, int] = {}
                for rows in _some(sheet_rows(content, sheet), SHEET_BATCH):
                    position = [turn.setdefault(r[0], len(turn)) for r in rows]
                    yield pd.DataFrame({"path": p, "sheet": [r[0] for r in rows], "position": position, "row": [r[1] for r in rows], "cells": [r[2] for r in rows]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(work, "path string, sheet string, position int, row long, cells array<string>")


def tabular(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10, SRC-11: (path, row, cells by header) of an external file by its suffix: CSV, or a spreadsheet's first sheet
    with its headers in row 1; other suffixes are an error."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        return csv_with_fallback(spark, path)
    if suffix not in ("xlsx", "xlsm"):
        raise ValueError(f"neither CSV nor a spreadsheet: {path}")
    cells = spreadsheet(spark, path)
    first = cells.groupBy("path").agg(F.min_by("sheet", "position").alias("sheet"))
    sheet = cells.join(F.broadcast(first), ["path", "sheet"])
    head = sheet.filter("row = 1").select("path", F.col("cells").alias("names"))
    named = sheet.filter("row > 1").join(F.broadcast(head), "path")
    pairs = F.filter(F.arrays_zip("names", "cells"), lambda x: x["names"].isNotNull())
    return named.select("path", (F.col("row") - 2).alias("row"), F.map_from_entries(F.transform(pairs, lambda x: F.struct(x["names"], x["cells"]))).alias("cells"))


def target_institutions(spark: SparkSession, path: str, kind: str = "専門学校", first_row: int = 5) -> DataFrame:
    """SRC-06: (code, name, region, kind) of a workbook of target institutions, whose rows begin at first_row; those of a
    kind that have a name."""
    rows = spreadsheet(spark, path).filter(F.col("row") >= first_row)
    named = rows.select(*[F.trim(F.get("cells", F.lit(i))).alias(n) for i, n in enumerate(("code", "name", "region", "kind"))])
    return named.filter((F.col("kind") == kind) & (F.coalesce("name", F.lit("")) != ""))


#: Sheets of a master workbook in the order of import; a fourth one is derived from the third and skipped.
MASTER_SHEETS = ("status", "support", "unit")


def master_workbook(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """SRC-01: the sheets of a master workbook as rows: status (region, owner, name, period, status), support (name,
    period, total; the first row of a name and period, bad periods left out) and unit (name, unit, period, measures).

    Headers stand in row 1.  Status and unit sheets have a column, or one for each measure, of each period; their headers
    are `2025` and `capacity_2025`.
    """
    from veritab.operators.records import status_of_text
    from veritab.operators.revision import first_by

    cells = spreadsheet(spark, path).filter(F.col("sheet").isin(*MASTER_SHEETS))
    head = cells.filter("row = 1").select("path", "sheet", F.col("cells").alias("names"))
    rows = cells.filter("row > 1").join(F.broadcast(head), ["path", "sheet"]).select("sheet", "row", F.col("cells"), F.posexplode("names").alias("col", "header"))
    at = lambda i: F.get("cells", F.lit(i))
    value = F.get("cells", F.col("col"))
    status = rows.filter((F.col("sheet") == "status") & F.col("header").rlike(r"^20\d{2}$")).select(at(0).alias("region"), at(1).alias("owner"), at(2).alias("name"), F.col("header").cast("int").alias("period"), status_of_text(value).alias("status"))
    support = cells.filter("sheet = 'support' AND row > 1").select("row", F.get("cells", F.lit(0)).alias("name"), F.get("cells", F.lit(1)).try_cast("int").alias("period"), F.get("cells", F.lit(2)).try_cast("long").alias("total")).filter("period IS NOT NULL")
    measure = F.regexp_extract("header", r"^([a-z_]+)_20\d{2}$", 1)
    unit = rows.filter((F.col("sheet") == "unit") & (measure != "")).select(at(0).alias("name"), at(1).alias("unit"), F.regexp_extract("header", r"_(20\d{2})$", 1).cast("int").alias("period"), measure.alias("measure"), value.try_cast("long").alias("value"))
    wide = unit.filter("value IS NOT NULL").groupBy("name", "unit", "period").agg(*[F.max(F.when(F.col("measure") == m, F.col("value"))).alias(m) for m in ("capacity", "enrollment")])
    return {"status": status, "support": first_by(support, ["name", "period"], [F.col("row")]).drop("row"), "unit": wide}


def template_schema(cells: DataFrame, name_words: str = "学校名|名称", most: int = 10) -> DataFrame:
    """SRC-30: by sheet of a template's (sheet, row, cells): the first of its first rows that has a name column, that
    column, and the columns of years, as (sheet, header_row, name_col, col, period)."""
    spread = cells.filter(F.col("row") <= most).select("sheet", "row", F.posexplode("cells").alias("col", "value"))
    named = spread.filter(F.coalesce("value", F.lit("")).rlike(name_words)).groupBy("sheet").agg(F.min(F.struct("row", "col")).alias("at")).select("sheet", F.col("at.row").alias("header_row"), F.col("at.col").alias("name_col"))
    years = spread.withColumn("period", F.regexp_extract(F.coalesce("value", F.lit("")), r"(20\d{2})", 1).try_cast("int")).filter("period IS NOT NULL")
    return years.join(named, "sheet").filter("row = header_row").select("sheet", "header_row", "name_col", "col", "period")


def zip_members(spark: SparkSession, path: str, suffix: str = ".pdf") -> DataFrame:
    """SRC-17: (path, member, content) of archives' members with a suffix; a file that is no archive has none."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with ZipFile(io.BytesIO(content)) as z:
                        found = [(p, n, z.read(n)) for n in z.namelist() if n.lower().endswith(suffix) and not n.startswith("__MACOSX")]
                except Exception:  # noqa: BLE001  a broken archive is data, not a fault of the job
                    found = []
                yield pd.DataFrame(found, columns=["path", "member", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(work, "path string, member string, content binary")


def ocr_words(rows: DataFrame, text: str = "tsv") -> DataFrame:
    """SRC-15: recognised words of tab-separated OCR output, by page, block, paragraph and line: text and confidences.

    Only level 5 counts, rows with bad numbers are dropped, a missing confidence is -1.
    """
    lines = rows.select(*[c for c in rows.columns if c != text], F.posexplode(F.split(text, "\n")).alias("pos", "line")).filter("pos > 0")
    f = F.split("line", "\t")
    number = lambda i: F.get(f, F.lit(i)).try_cast("int")
    words = lines.select(
        *[c for c in rows.columns if c != text], "pos", number(0).alias("level"), number(1).alias("page"), number(2).alias("block"), number(3).alias("par"), number(4).alias("line_no"),
        F.coalesce(F.get(f, F.lit(10)).try_cast("double"), F.lit(-1.0)).alias("conf"), F.get(f, F.lit(11)).alias("word"),
    ).filter("level = 5 AND page IS NOT NULL AND line_no IS NOT NULL AND trim(coalesce(word, '')) <> ''")
    keys = [c for c in rows.columns if c != text]
    grouped = words.groupBy(*keys, "page", "block", "par", "line_no").agg(F.sort_array(F.collect_list(F.struct("pos", "word", "conf"))).alias("w"))
    return grouped.select(*keys, "page", "block", "par", "line_no", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("text"), F.transform("w", lambda x: x["conf"]).alias("confidences"))


EVIDENCE = "entity_id long, pdf_url string, page_url string, anchor_text string, pattern_type string, score double, reason string, pdf_type string, extra map<string,string>, ts string"


def evidence_log(spark: SparkSession, path: str) -> DataFrame:
    """SRC-18: an evidence log; malformed lines are skipped."""
    return spark.read.schema(EVIDENCE).option("mode", "DROPMALFORMED").json(path)


ENTRY = (
    "schema_version string, entry_id string, school struct<school_id: long, school_name: string, prefecture: string, corporation_name: string>, target_fiscal_year int, outcome string, "
    "expected_result struct<school_url: string, disclosure_url: string, pdf_url: string, pdf_type: string, fiscal_year: int, pattern_type: string, strict_target_year_success: boolean>"
)
PREDICTION = "entry_id string, outcome string, pdf_url string, fiscal_year int, strict_target_year_success boolean, pattern_type string"
ANNOTATION = (
    "school_name string, school_type string, operator_name string, fiscal_year string, source_pdf string, departments array<struct<name: string, course_name: string, duration_years: double, "
    "day_or_evening: string, capacity: int, enrollment: int, intl_students: int, graduates: int, advanced: int, employed: int, other: int, prev_enrollment: int, dropouts: int, dropout_rate: double>>"
)
MANIFEST = (
    "manifest_version int, corporation_name string, fiscal_year int, source_page_url string, schools array<struct<school_key: string, campus_key: string, school_name: string, prefecture: string, "
    "fiscal_year: int, pdf_paths: array<string>, pdf_url: string, authority_basis: struct<source_type: string, confirmed_by: string, confirmed_at: string, evidence: array<struct<kind: string, value: string>>>>>"
)


def gold_entries(spark: SparkSession, path: str) -> DataFrame:
    """SRC-19: entries of a discovery gold set, one file each."""
    e = spark.read.schema(ENTRY).option("multiLine", True).json(path)
    return e.select("entry_id", F.col("school.school_id").alias("entity_id"), F.col("school.school_name").alias("name"), F.col("school.prefecture").alias("region"), F.col("target_fiscal_year").alias("period"), "outcome", F.col("expected_result.pdf_url").alias("url"))


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """SRC-20."""
    return spark.read.schema(PREDICTION).option("mode", "DROPMALFORMED").json(path)


def annotations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """SRC-21: one row for each unit of the annotated documents, with its place; a file is one document, or a line is."""
    a = spark.read.schema(ANNOTATION).option("multiLine", multi_line).json(path)
    return a.select(F.col("source_pdf").alias("doc"), F.col("school_name").alias("entity_name"), F.posexplode("departments").alias("pos", "u")).select("doc", "entity_name", "pos", "u.*")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """SRC-22: entities of a pinned manifest, with what is wrong with the authority that they rest on."""
    from veritab.functions.states import errors

    m = spark.read.schema(MANIFEST).option("multiLine", True).json(path).select(F.explode("schools").alias("s")).select("s.*")
    basis = F.col("authority_basis")
    wrong = errors((basis.isNull(), "no authority basis"), (basis["confirmed_by"].isNull(), "nobody has confirmed it"), (F.coalesce(F.size(basis["evidence"]), F.lit(0)) <= 0, "no evidence"))
    return m.select(F.col("school_key").alias("entity_key"), F.col("school_name").alias("name"), F.col("fiscal_year").alias("period"), wrong.alias("errors"))


def url_rows(df: DataFrame, required: tuple[str, ...] = ("name", "url")) -> DataFrame:
    """SRC-16, UPD-20, SRC-27..29: rows of a URL list with all their errors; blank rows are left out."""
    from veritab.functions.states import errors

    blank = F.lit(True)
    for c in df.columns:
        blank = blank & (F.trim(F.coalesce(F.col(c), F.lit(""))) == "")
    checks = [(F.trim(F.coalesce(F.col(c), F.lit(""))) == "", f"{c} is empty") for c in required if c in df.columns]
    return df.filter(~blank).withColumn("errors", errors(*checks, (~F.coalesce(F.col("url"), F.lit("")).rlike("^https?://"), "url is no address")))


def url_import(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """UPD-20: the rows of a URL list that can be imported, and the others with their errors."""
    rows = url_rows(df)
    return rows.filter(F.size("errors") == 0).drop("errors"), rows.filter(F.size("errors") > 0)


def owner_domains(df: DataFrame) -> DataFrame:
    """SRC-28: (owner, domain, errors) of a list of owners' domains: a domain is a host, or an address whose host is
    taken; each owner's first row counts, later ones are errors."""
    from pyspark.sql import Window

    from veritab.functions.states import errors
    from veritab.functions.urls import host

    given = F.lower(F.trim(F.coalesce("domain", F.lit(""))))
    domain = F.when(given.rlike("^https?://"), host(given)).otherwise(given)
    turn = F.row_number().over(Window.partitionBy("owner").orderBy("row"))
    rows = df.withColumns({"domain": domain, "_n": turn})
    wrong = errors((F.trim(F.coalesce("owner", F.lit(""))) == "", "owner is empty"), (~F.col("domain").rlike(r"^[a-z0-9-]+(\.[a-z0-9-]+)+$"), "domain is no host"), (F.col("_n") > 1, "owner is listed before"))
    return rows.select("row", "owner", "domain", wrong.alias("errors"))


def region_coverage(df: DataFrame, regions: DataFrame) -> DataFrame:
    """SRC-29: (region, url, expected, errors) of a list of regions' index pages: the region must be known, the address
    one, and the expected count a number that is not negative."""
    from veritab.functions.states import errors

    known = regions.select("region", F.lit(True).alias("_known")).distinct()
    rows = df.join(known, "region", "left").withColumn("_n", F.col("expected").try_cast("int"))
    wrong = errors((F.col("_known").isNull(), "unknown region"), (~F.coalesce("url", F.lit("")).rlike("^https?://"), "url is no address"), (F.col("_n").isNull() | (F.col("_n") < 0), "expected is no count"))
    return rows.select("row", "region", "url", F.col("_n").alias("expected"), wrong.alias("errors"))


class _Table(HTMLParser):
    """Cells and anchors of the tables of a page."""

    def __init__(self, base: str):
        super().__init__()
        self.base, self.rows, self.row, self.cell, self.href, self.header, self.table = base, [], None, None, None, False, 0

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.table += 1
        elif tag == "tr":
            self.row = []
        elif tag in ("td", "th") and self.row is not None:
            self.cell, self.href, self.header = "", None, tag == "th"
        elif tag == "a" and self.cell is not None:
            self.href = self.href or dict(attrs).get("href")

    def handle_data(self, data):
        if self.cell is not None:
            self.cell += data

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            self.row.append((" ".join(self.cell.split()), urljoin(self.base, self.href) if self.href else None, self.header))
            self.cell = None
        elif tag == "tr" and self.row is not None:
            self.rows.append((self.table, self.row))
            self.row = None


def few_at_once(pages: DataFrame) -> DataFrame:
    """pages, which workers get PAGE_BATCH at a time: what they hold does not grow with a part of the table.  The size is a
    setting of the session, which is read when a job runs, so it stays set."""
    pages.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(PAGE_BATCH))
    return pages


def html_tables(pages: DataFrame) -> DataFrame:
    """SRC-23, SRC-24: (page_id, tab, row, col, text, href, is_header) of the table cells of (page_id, url, html)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page, url, html in zip(batch["page_id"], batch["url"], batch["html"], strict=True):
                t = _Table(url or "")
                t.feed(html or "")
                out += [(page, tab, r, c, *cell) for r, (tab, row) in enumerate(t.rows) for c, cell in enumerate(row)]
            yield pd.DataFrame(out, columns=["page_id", "tab", "row", "col", "text", "href", "is_header"])

    return few_at_once(pages).select("page_id", "url", "html").mapInPandas(work, "page_id long, tab int, row int, col int, text string, href string, is_header boolean")


# Headers of tables of withdrawn institutions, of columns of names, and what names end in.
WITHDRAWN = "根拠規定|取消"
NAME_HEADERS = "名|name|title"
NAMED_LIKE = "(学校|大学|学院|学園)$"


def index_rows(cells: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """JOIN-27, SRC-23: an index's rows as (page_id, name, href), each pair once: the name in the column whose header
    says so, the first anchor of the row.

    Tables of withdrawn institutions give no rows, and free links (page_id, text, href) to what they name none either;
    other free links that name an institution fill in an address that is missing, or are rows of their own.
    """
    key = lambda c: F.regexp_replace(c, r"(?U)\s+", "")
    heads = cells.filter("is_header").groupBy("page_id", "tab").agg(F.min(F.when(F.lower("text").rlike(NAME_HEADERS), F.col("col"))).alias("name_col"), F.bool_or(F.col("text").rlike(WITHDRAWN)).alias("withdrawn"))
    rows = cells.filter(~F.col("is_header")).join(heads, ["page_id", "tab"], "left").withColumns({"name_col": F.coalesce("name_col", F.lit(0)), "withdrawn": F.coalesce("withdrawn", F.lit(False))})
    listed = rows.filter(~F.col("withdrawn")).groupBy("page_id", "row").agg(F.max(F.when(F.col("col") == F.col("name_col"), F.col("text"))).alias("name"), F.min_by("href", F.when(F.col("href").isNotNull(), F.col("col"))).alias("href"))
    listed = listed.filter("name IS NOT NULL AND name <> ''").select("page_id", "name", "href").distinct()
    if links is None:
        return listed
    gone = rows.filter(F.col("withdrawn") & F.col("text").rlike(NAMED_LIKE)).select("page_id", key(F.col("text")).alias("k")).distinct()
    free = links.filter(F.col("text").rlike(NAMED_LIKE)).select("page_id", "text", "href", key(F.col("text")).alias("k")).join(gone, ["page_id", "k"], "left_anti")
    free = free.groupBy("page_id", "k").agg(F.min("text").alias("text"), F.min("href").alias("free_href"))
    both = listed.withColumn("k", key(F.col("name"))).join(free, ["page_id", "k"], "full_outer")
    return both.select("page_id", F.coalesce("name", "text").alias("name"), F.coalesce("href", "free_href").alias("href")).distinct()


def sitemap_locations(df: DataFrame, xml: str = "xml") -> DataFrame:
    """SRC-26: addresses in sitemaps and robots files, in order."""
    found = F.concat(F.regexp_extract_all(xml, F.lit(r"(?is)<loc>\s*([^<]+?)\s*</loc>"), 1), F.regexp_extract_all(xml, F.lit(r"(?im)^\s*Sitemap:\s*(\S+)"), 1))
    return df.select(*[c for c in df.columns if c != xml], F.posexplode(found).alias("position", "url"))
