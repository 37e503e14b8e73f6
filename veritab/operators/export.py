"""Pivots and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from io import BytesIO
from xml.sax.saxutils import escape
from zipfile import ZIP_DEFLATED, ZipFile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def status_pivot(entities: DataFrame, status: DataFrame, periods: Sequence[int]) -> DataFrame:
    """AGG-17: every entity with its current status in each period; the list of periods is given, so one pass is enough."""
    cells = [F.max(F.when(F.col("period") == p, F.col("status"))).alias(f"status_{p}") for p in periods]
    wide = status.filter("is_current").groupBy("entity_id").agg(*cells)
    return entities.join(wide, "entity_id", "left")


def measure_pivot(fact: DataFrame, periods: Sequence[int], measures: Sequence[str]) -> DataFrame:
    """SNK-01: units with each measure of each period side by side."""
    cells = [F.max(F.when(F.col("period") == p, F.col(m))).alias(f"{m}_{p}") for p in periods for m in measures]
    return fact.filter("is_current").groupBy("entity_id", "unit_id").agg(*cells)


def rolled_up(fact: DataFrame, period: int, measures: Sequence[str]) -> DataFrame:
    """AGG-15, T13: sums by entity, without the confidence filter: null only where all parts are."""
    return fact.filter(F.col("is_current") & (F.col("period") == period)).groupBy("entity_id").agg(*[F.sum(m).alias(m) for m in measures])


def previous_ratio(fact: DataFrame, measure: str) -> DataFrame:
    """WIN-19: each row's measure over the previous period's; null where that is null, 0 or not the period before."""
    w = Window.partitionBy("unit_id").orderBy("period")
    before = F.when(F.lag("period").over(w) == F.col("period") - 1, F.lag(measure).over(w))
    return fact.filter("is_current").select("unit_id", "period", F.try_divide(F.col(measure).cast("double"), F.nullif(before, F.lit(0)).cast("double")).alias("ratio"))


def overlay(template: DataFrame, matches: DataFrame, sums: DataFrame, measures: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """SNK-02, SORT-12: template rows with their entity's sums, and the rows that stay empty, sorted."""
    joined = template.join(matches, "row_id", "left").join(sums, "entity_id", "left")
    empty = F.coalesce(*measures).isNull()
    gaps = joined.filter(empty).select("row_id", "name", F.when(F.col("entity_id").isNull(), "entity_missing").otherwise("no_rows_for_period").alias("gap_reason"))
    return joined.select("row_id", "name", "entity_id", *measures), gaps.orderBy("gap_reason", "name", "row_id")


def write_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """SNK-03, SNK-04, SNK-05, SNK-10: CSV with a header; in one file if an order is asked for."""
    out = df.coalesce(1).sortWithinPartitions(*order) if order else df
    out.write.csv(path, header=True)


def append_jsonl(df: DataFrame, path: str) -> None:
    """SNK-06: rows appended to an evidence log."""
    df.write.mode("append").json(path)


def flush_outbox(actions: DataFrame, path: str, key: str = "action_id") -> int:
    """SNK-07: actions that the log does not hold yet, each once; returns how many were written.

    Running it again writes nothing: what the log holds is read first.
    """
    spark = actions.sparkSession
    new = actions.dropDuplicates([key])
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
        new = new.join(spark.read.schema(actions.schema).json(path).select(key).distinct(), key, "left_anti")
    new = new.cache()
    n = new.count()
    if n:
        new.write.mode("append").json(path)
    new.unpersist()
    return n


def content_addressed(df: DataFrame, payload: Column) -> DataFrame:
    """SNK-08: rows with the path that their content has; the writer uses mode("error"), so nothing is written twice."""
    digest = F.sha2(payload.cast("binary"), 256)
    return df.withColumns({"sha256": digest, "path": F.concat_ws("/", F.substring(digest, 1, 2), digest)})


def copied(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """SNK-09, SRC-27: source rows whose key the target lacks."""
    return source.join(target.select(*key).distinct(), list(key), "left_anti")


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file in any store that Spark knows; what was there is replaced."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


#: Rows of a sheet, which its format limits.
SHEET_ROWS = 1_048_575


def write_workbook(path: str, sheets: dict[str, DataFrame]) -> None:
    """SNK-01, SNK-02: DataFrames as the sheets of one file, in their own order.  A sheet of more rows than the format
    has is an error, never cut."""
    filled = {}
    for name, df in sheets.items():
        rows = df.limit(SHEET_ROWS + 1).collect()
        if len(rows) > SHEET_ROWS:
            raise ValueError(f"sheet {name} has more rows than a workbook holds")
        filled[name] = (df.columns, [list(r) for r in rows])
    write_bytes(next(iter(sheets.values())).sparkSession, path, workbook(filled))


def master_sheets(entity: DataFrame, status: DataFrame, fact: DataFrame, support: DataFrame, excluded: DataFrame | None, periods: Sequence[int], measures: Sequence[str]) -> dict[str, DataFrame]:
    """SNK-01: a master workbook's sheets: status by period, support, measures of units by period, the same for the last
    period alone, and, if given, rows that were left out."""
    names = entity.select("entity_id", "region", "owner", "name")
    states = status_pivot(names, status, periods).select("region", "owner", "name", *[F.col(f"status_{p}").alias(str(p)) for p in periods]).orderBy("region", "name")
    wide = names.select("entity_id", "name").join(measure_pivot(fact, periods, measures), "entity_id")
    units = wide.select("name", F.col("unit_id").cast("string").alias("unit"), *[f"{m}_{p}" for p in periods for m in measures]).orderBy("name", "unit")
    last = units.select("name", "unit", *[f"{m}_{periods[-1]}" for m in measures])
    given = support.join(names.select("entity_id", "name"), "entity_id").select("name", "period", "total").orderBy("name", "period")
    return {"status": states, "support": given, "unit": units, "extract": last} | ({"excluded": excluded} if excluded is not None else {})


def workbook(sheets: dict[str, tuple[Sequence[str], Sequence[Sequence[object]]]]) -> bytes:
    """SNK-01: a spreadsheet file of sheets given as headers and rows, for exports of a few thousand rows."""

    def cell(value: object, ref: str) -> str:
        if value is None:
            return ""
        if isinstance(value, bool) or not isinstance(value, int | float):
            return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'
        return f'<c r="{ref}"><v>{value}</v></c>'

    def letters(n: int) -> str:
        out = ""
        while n >= 0:
            out, n = chr(65 + n % 26) + out, n // 26 - 1
        return out

    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    out = BytesIO()
    with ZipFile(out, "w", ZIP_DEFLATED) as z:
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr(
            "[Content_Types].xml",
            f'<?xml version="1.0"?><Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{parts}</Types>',
        )
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        names = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="{package}/relationships">{links}</Relationships>')
        for i, (header, rows) in enumerate(sheets.values(), 1):
            lines = [f'<row r="{r}">' + "".join(cell(v, f"{letters(c)}{r}") for c, v in enumerate(row)) + "</row>" for r, row in enumerate([header, *rows], 1)]
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<?xml version="1.0"?><worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
    return out.getvalue()
