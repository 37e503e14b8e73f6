"""Coverage, gaps, readiness and counters.

Facts about an entity are flags, made by one aggregation over its sites, documents and rows each (bool_or with partial
aggregation on the map side); entities then carry their flags to the counts.  Inputs:

entity(entity_id, name, owner, region, entity_type, active); site(site_id, entity_id, url, method, http_status,
verified); document(document_id, entity_id, period, status, doc_class); fact(unit_id, entity_id, document_id, period,
capacity, enrollment, confidence, is_current).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions import states
from veritab.functions.numbers import CUTOFFS
from veritab.streaming.state import stored

UNKNOWN_REGION = "(unknown)"
TOTAL = "__total__"


def exportable(confidence: Column, least: float = CUTOFFS[1]) -> Column:
    """FLT-02, T12: no confidence, or enough of it."""
    return confidence.isNull() | (confidence >= least)


def valid_unit(name: Column, enrollment: Column, period: Column) -> Column:
    """FLT-03: what may become a fact row."""
    return enrollment.isNotNull() & (F.length(F.trim(name)) >= 2) & period.isNotNull()


def eligible(status: Column, doc_class: Column, path: Column) -> Column:
    """FLT-04: documents that an ingest run takes up."""
    open_status = status.isNull() | status.isin("pending", "transient_error", "ocr_pending", "in_progress")
    return path.isNotNull() & open_status & ~F.coalesce(doc_class == "non_target", F.lit(False))


def is_ingested_target() -> Column:
    return F.coalesce((F.col("doc_class") == "target") & (F.col("status") == "ingested"), F.lit(False))


def site_flags(site: DataFrame) -> DataFrame:
    crawlable = F.col("http_status").isNull() | (F.col("http_status") == 200)
    return site.groupBy("entity_id").agg(
        F.bool_or("verified").alias("verified_url"),
        F.bool_or(crawlable).alias("crawlable"),
        F.bool_or(crawlable & (F.col("method") == "region_index")).alias("region_site"),
        F.bool_or(crawlable & (F.col("method") == "operator_manual")).alias("operator_site"),
    )


def document_flags(document: DataFrame, period: int) -> DataFrame:
    """CLS-03, CLS-05: flags over an entity's documents, and the best evidence of the period."""
    target, here = is_ingested_target(), F.coalesce(F.col("period") == period, F.lit(False))
    image = F.coalesce(F.col("doc_class") == "image_only", F.lit(False))
    evidence = states.period_evidence(F.lit(None).cast("int"), F.col("period"), F.lit(False), period)
    evidence = F.when(F.col("doc_class") == "target", evidence)
    out = document.withColumn("_e", evidence).groupBy("entity_id").agg(
        F.bool_or(target).alias("any_target"),
        F.bool_or(target & here).alias("current_target"),
        F.bool_or(F.coalesce(F.col("status") == "ingested", F.lit(False)) & here).alias("current_document"),
        F.bool_or(F.coalesce((F.col("status") == "ingested") & (F.col("doc_class") != "target"), F.lit(False))).alias("other_ingested"),
        F.bool_or(here & (target | (image & F.col("status").isin("ingested", "review_pending")))).alias("confirmed"),
        F.bool_or(here & image & F.col("status").isin("ocr_pending", "parse_failed")).alias("image_current"),
        F.bool_or(F.col("status") == "ocr_pending").alias("any_ocr"),
        F.bool_or(F.col("status") == "parse_failed").alias("any_failed"),
        F.bool_or(target & (F.col("period") < period)).alias("stale"),
        F.collect_set("status").alias("statuses"),
        F.max_by(F.col("_e.level"), F.col("_e.rank")).alias("best_level"),
        F.bool_or(F.col("_e.level") == "conflict").alias("any_conflict"),
    )
    return out


def with_rows(fact: DataFrame, period: int) -> DataFrame:
    """Entities with current rows of a period that have a capacity."""
    return fact.filter((F.col("period") == period) & F.col("is_current") & F.col("capacity").isNotNull()).select("entity_id").distinct()


def _flagged(entity: DataFrame, site: DataFrame, document: DataFrame, fact: DataFrame, period: int) -> DataFrame:
    out = entity.filter("active").join(site_flags(site).withColumn("has_url", F.lit(True)), "entity_id", "left")
    out = out.join(document_flags(document, period).withColumn("has_document", F.lit(True)), "entity_id", "left")
    out = out.join(with_rows(fact, period).withColumn("extracted", F.lit(True)), "entity_id", "left")
    names = ("has_url", "verified_url", "has_document", "any_target", "current_target", "current_document", "extracted")
    return out.withColumns({n: F.coalesce(n, F.lit(False)) for n in names})


def coverage(entity: DataFrame, site: DataFrame, document: DataFrame, fact: DataFrame, period: int) -> DataFrame:
    """AGG-01: entities by region with each flag, and a total row, by one rollup."""
    f = _flagged(entity, site, document, fact, period).withColumn("region", F.coalesce("region", F.lit(UNKNOWN_REGION)))
    counts = {
        "with_url": "has_url", "with_verified_url": "verified_url", "with_any_document": "has_document", "with_target_any_period": "any_target",
        "with_target_this_period": "current_target", "with_document_this_period": "current_document", "with_rows_this_period": "extracted",
    }
    out = f.rollup("region").agg(F.count("*").alias("entities"), *[F.count_if(F.col(c)).alias(n) for n, c in counts.items()])
    return out.withColumn("region", F.coalesce("region", F.lit(TOTAL)))


def export_readiness(entity: DataFrame, site: DataFrame, document: DataFrame, fact: DataFrame, period: int) -> DataFrame:
    """AGG-02, JOIN-22: one row of counters; stale fallbacks are entities whose only targets are older."""
    f = _flagged(entity, site, document, fact, period)
    stale = F.coalesce("stale", F.lit(False)) & ~F.col("current_target")
    rows = fact.filter((F.col("period") == period) & F.col("is_current")).join(entity.filter("active"), "entity_id", "left_semi").agg(F.count("*").alias("target_rows"))
    out = f.agg(
        F.count("*").alias("entities"), F.count_if("has_url").alias("with_url"), F.count_if(~F.col("has_url")).alias("without_url"), F.count_if("current_target").alias("target_documents"),
        F.count_if(stale).alias("stale_fallbacks"), F.count_if(~F.col("current_target")).alias("missing_target"), F.count_if("extracted").alias("extracted"),
    )
    # one row each
    return out.join(rows, F.lit(True), "left")


def outliers(fact: DataFrame, period: int, threshold: float = 50.0) -> DataFrame:
    """AGG-03: units whose enrolment changed by at least the threshold against the period before; largest first.

    Units without a positive or negative previous value are skipped.
    """
    rows = fact.filter("is_current AND enrollment IS NOT NULL")
    now = rows.filter(F.col("period") == period).select("unit_id", "entity_id", F.col("enrollment").alias("current_value"))
    before = rows.filter((F.col("period") == period - 1) & (F.col("enrollment") != 0)).select("unit_id", F.col("enrollment").alias("previous_value"))
    delta = (F.col("current_value") - F.col("previous_value")) / F.col("previous_value") * 100
    return now.join(before, "unit_id").withColumn("delta", delta).filter(F.abs("delta") >= threshold).withColumn("delta_pct", F.round("delta", 1)).drop("delta").orderBy(F.abs("delta_pct").desc(), "unit_id")


def extraction_stats(document: DataFrame, fact: DataFrame, period: int) -> DataFrame:
    """AGG-03: one row: documents ingested, those with rows, current rows, and how many have which measure."""
    docs = document.filter((F.col("period") == period) & (F.col("status") == "ingested"))
    used = fact.select("document_id").distinct().withColumn("used", F.lit(True))
    d = docs.join(used, "document_id", "left").agg(F.count("*").alias("documents"), F.count_if("used").alias("documents_with_rows"))
    r = fact.filter((F.col("period") == period) & F.col("is_current")).agg(F.count("*").alias("rows"), F.count("capacity").alias("rows_with_capacity"), F.count("enrollment").alias("rows_with_enrollment"))
    return d.join(r, F.lit(True), "left")


def gaps_no_site(entity: DataFrame, site: DataFrame) -> DataFrame:
    """AGG-05, AGG-43: active entities without a site, by region."""
    return entity.filter("active").join(site.select("entity_id"), "entity_id", "left_anti").groupBy("region").agg(F.count("*").alias("n")).withColumn("reason", F.lit("no_site"))


def gaps_documents(entity: DataFrame, site: DataFrame, document: DataFrame, period: int) -> DataFrame:
    """AGG-06, AGG-07: (entity_id, reason) of active entities without a valid document of the period."""
    out = entity.filter("active").select("entity_id").join(document_flags(document, period).withColumn("has_document", F.lit(True)), "entity_id", "left")
    out = out.join(site.select("entity_id").distinct().withColumn("has_site", F.lit(True)), "entity_id", "left")
    reason = F.when(F.col("has_document").isNull(), F.when(F.col("has_site"), "site_known_no_document").otherwise("no_site_no_document"))
    return out.select("entity_id", reason.otherwise(states.document_gap(F.col("current_target"), F.col("any_target"), F.col("other_ingested"), F.col("statuses"))).alias("reason")).filter("reason IS NOT NULL")


def gaps_rows(document: DataFrame, fact: DataFrame, period: int) -> DataFrame:
    """AGG-08: documents that were ingested without leaving rows."""
    docs = document.filter((F.col("period") == period) & (F.col("status") == "ingested"))
    return docs.join(fact.filter("document_id IS NOT NULL").select("document_id"), "document_id", "left_anti").select("document_id", "entity_id", F.lit("ingested_no_rows").alias("reason"))


def by_reason(gaps: DataFrame) -> DataFrame:
    """AGG-04, AGG-09: gaps by reason."""
    return gaps.groupBy("reason").agg(F.count("*").alias("n"))


def status_rows(entity: DataFrame, site: DataFrame, document: DataFrame, fact: DataFrame, period: int, buckets: DataFrame | None = None) -> DataFrame:
    """UPD-12, CLS-03..08, WIN-09: one status row for each active entity, worked out anew.

    buckets (entity_id, bucket), if given, explain entities without documents.  A document's status comes first, then
    what evidence says, then the comparison with the period before.
    """
    f = entity.filter("active").select("entity_id", "region").join(site_flags(site), "entity_id", "left").join(document_flags(document, period).withColumn("has_document", F.lit(True)), "entity_id", "left")
    rows = fact.filter((F.col("period") == period) & F.col("is_current") & F.col("capacity").isNotNull() & exportable(F.col("confidence")))
    f = f.join(rows.select("entity_id").distinct().withColumn("has_rows", F.lit(True)), "entity_id", "left").join(yoy_status(fact, period), "entity_id", "left")
    f = f.join(buckets, "entity_id", "left") if buckets is not None else f.withColumn("bucket", F.lit(None).cast("string"))
    no = lambda c: F.coalesce(F.col(c), F.lit(False))
    f = f.withColumn("url_status", states.url_status(no("crawlable"), no("region_site"), no("operator_site")))
    known = states.document_status(no("confirmed"), no("image_current"), no("any_ocr"), no("stale"), no("has_document"))
    told = (
        F.when(F.col("bucket") == "publication_lag_or_old_target_pdf", "publication_lag")
        .when(F.col("bucket") == "target_form_without_year_evidence", "target_year_unverified")
        .when(F.col("bucket") == "tls_certificate_verify_failed", "site_error")
    )
    f = f.withColumn("document_status", F.when(known == "none", F.coalesce(told, known)).otherwise(known))
    f = f.withColumn("extract_status", states.extract_status(no("has_rows"), no("any_ocr"), no("any_failed")))
    f = f.withColumn("yoy_status", F.coalesce("yoy_status", F.lit("unchecked")))
    level = states.evidence_level(F.col("best_level"), no("any_conflict"), F.col("document_status"))
    level = F.when(F.col("document_status").isin("publication_lag", "target_year_unverified"), F.col("document_status")).when(F.col("document_status") == "site_error", "tls_certificate_verify_failed").otherwise(level)
    level = F.when((F.col("yoy_status") == "partial_diff") & ~level.isin("conflict", "operator_override"), "prev_year_diff").otherwise(level)
    f = f.withColumn("evidence_level", level)
    ready = (F.col("document_status") == "confirmed_target") & (F.col("extract_status") == "parsed") & F.col("evidence_level").isin("pdf_text", "prev_year_diff", "operator_override") & (F.col("yoy_status") != "identical_to_prev_period")
    f = f.withColumn("ready", ready)
    reason = states.blocking_reason(F.col("url_status"), F.col("document_status"), F.col("extract_status"), F.col("ready"))
    return f.select("entity_id", "region", "url_status", "document_status", "extract_status", "yoy_status", "evidence_level", "ready", reason.alias("blocking_reason"))


#: Parts of a written status table; a refresh rewrites those that hold an entity that was touched.
STATUS_PARTS = 64


def _parted(rows: DataFrame, parts: int) -> DataFrame:
    return rows.withColumn("part", F.pmod(F.xxhash64("entity_id"), F.lit(parts)).cast("int"))


def build_status(path: str, entity: DataFrame, site: DataFrame, document: DataFrame, fact: DataFrame, period: int, parts: int = STATUS_PARTS) -> None:
    """UPD-12: the status rows of all entities as a table in so many parts by entity; what was there is replaced."""
    _parted(status_rows(entity, site, document, fact, period), parts).repartition("part").write.mode("overwrite").partitionBy("part").parquet(path)


def refresh_status(path: str, touched: DataFrame, entity: DataFrame, site: DataFrame, document: DataFrame, fact: DataFrame, period: int, parts: int = STATUS_PARTS) -> int:
    """UPD-12: the table brought up to date for the touched entities (entity_id) only; returns how many parts were written.

    touched: entities of which a row of any input was added, changed or taken away since the last run, each any number of
    times.  Their rows are worked out anew from their own inputs; the other rows of their parts are kept, and all other
    parts are not read.  Entities that are no longer active leave the table.  What is written is staged first, so a run
    that fails leaves the table as it was, and a run again gives the same.
    """
    spark = touched.sparkSession
    ids = stored(touched.select("entity_id").filter("entity_id IS NOT NULL").distinct(), "touched")
    hit = [r["part"] for r in _parted(ids, parts).select("part").distinct().collect()]
    if not hit:
        return 0
    mine = lambda df: df.join(ids, "entity_id", "left_semi")
    new = _parted(status_rows(mine(entity), mine(site), mine(document), mine(fact), period), parts)
    kept = spark.read.schema(new.schema).parquet(path).filter(F.col("part").isin(hit)).join(ids, "entity_id", "left_anti")
    staged = stored(new.unionByName(kept), "status")
    staged.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    # a part that lost its last row is not among those written
    left = {r["part"] for r in staged.select("part").distinct().collect()}
    for part in set(hit) - left:
        there = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part={part}")
        there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)
    return len(hit)


def yoy_status(fact: DataFrame, period: int, measures: Sequence[str] = ("capacity", "enrollment")) -> DataFrame:
    """WIN-09: by entity: unchecked, new_entity, partial_diff or identical_to_prev_period, over all units' measures."""
    rows = fact.filter(F.col("is_current") & F.col("period").isin(period, period - 1))

    def side(p: int, name: str) -> DataFrame:
        return rows.filter(F.col("period") == p).select("entity_id", "unit_id", F.struct(*measures).alias(name))

    both = side(period, "now").join(side(period - 1, "before"), ["entity_id", "unit_id"], "full_outer")
    same = F.col("now").isNotNull() & F.col("before").isNotNull() & F.col("now").eqNullSafe(F.col("before"))
    out = both.groupBy("entity_id").agg(F.bool_or(F.col("now").isNotNull()).alias("n"), F.bool_or(F.col("before").isNotNull()).alias("b"), F.bool_and(same).alias("s"))
    status = F.when(~F.col("n"), "unchecked").when(~F.col("b"), "new_entity").when(F.col("s"), "identical_to_prev_period").otherwise("partial_diff")
    return out.select("entity_id", status.alias("yoy_status"))


def status_counts(status: DataFrame) -> DataFrame:
    """AGG-11: one row of counters over status rows."""
    d, x = F.col("document_status"), F.col("extract_status")
    return status.agg(
        F.count("*").alias("total"), F.count_if("ready").alias("ready"), F.count_if(d == "confirmed_target").alias("confirmed_target"),
        F.count_if((d == "confirmed_target") & (x == "parsed")).alias("confirmed_target_parsed"), F.count_if((d == "confirmed_target") & F.col("ready")).alias("confirmed_target_ready"),
        F.count_if(d == "image_pending").alias("image_pending"), F.count_if(d == "rejected_stale").alias("rejected_stale"), F.count_if(d == "discovered").alias("discovered"),
        F.count_if(d == "none").alias("none"), F.count_if(x == "parse_failed").alias("parse_failed"),
    )


def readiness(status: DataFrame, target_min: float = 0.60, manual_max: float = 0.30) -> DataFrame:
    """AGG-10: rates against thresholds; slack on the manual side only."""
    c = status_counts(status)
    rate = lambda n: F.when(F.col("total") > 0, F.col(n) / F.col("total")).otherwise(0.0)
    reviewable = F.when(F.col("total") > 0, (F.col("confirmed_target") + F.col("image_pending")) / F.col("total")).otherwise(0.0)
    manual = F.when(F.col("total") > 0, 1.0 - reviewable).otherwise(0.0)
    out = c.select("total", rate("confirmed_target_parsed").alias("target_rate"), rate("confirmed_target_ready").alias("ready_rate"), manual.alias("manual_rate"))
    return out.withColumns({"target_passed": F.col("target_rate") >= target_min, "ready_passed": F.col("ready_rate") >= target_min, "manual_passed": F.col("manual_rate") <= manual_max + 1e-9})


def excluded_entities(status: DataFrame) -> DataFrame:
    """JOIN-13: entities whose latest current status is excluded; (entity_id, period, status, is_current)."""
    last = status.filter("is_current").groupBy("entity_id").agg(F.max_by("status", "period").alias("status"))
    return last.filter("status = 'excluded'").select("entity_id")


def pick_documents(document: DataFrame, period: int) -> DataFrame:
    """WIN-07: the document that a task sends its operator to, by max_by over a four-part key."""
    year = F.when(F.col("period") == period, 3).when(F.col("period") < period, 2).when(F.col("period").isNull(), 1).otherwise(0)
    state = F.when(F.col("status") == "ingested", 3).when(F.col("status").isin("review_pending", "parse_failed", "ocr_pending"), 2).otherwise(1)
    key = F.struct(year.alias("y"), F.coalesce("period", F.lit(0)).alias("p"), state.alias("s"), F.col("document_id").alias("i"))
    return document.groupBy("entity_id").agg(F.max_by("document_id", key).alias("document_id"))


def pick_sites(site: DataFrame) -> DataFrame:
    """WIN-08: the newest site that can serve again, else the newest."""
    lasting = (F.col("http_status").isNull() | (F.col("http_status") == 200)) & ~F.lower("url").endswith(".pdf")
    return site.groupBy("entity_id").agg(F.max_by("site_id", F.struct(lasting.cast("int").alias("l"), F.col("site_id").alias("i"))).alias("site_id"))


def task_list(status: DataFrame, entity: DataFrame, document: DataFrame, site: DataFrame, period: int, limit: int = 500) -> DataFrame:
    """JOIN-19, SORT-02, CLS-09: open tasks first, with the picked document and site; a top-k."""
    s = site.select("site_id", "url")
    out = status.join(entity.select("entity_id", "name"), "entity_id").join(pick_documents(document, period), "entity_id", "left")
    out = out.join(pick_sites(site).join(s, "site_id"), "entity_id", "left")
    out = out.withColumn("next_action", states.next_action(F.col("blocking_reason"), F.coalesce(F.lower("url").endswith(".pdf"), F.lit(False))))
    return out.orderBy("ready", F.col("blocking_reason").asc_nulls_last(), "region", "entity_id").limit(limit)


def task_summary(status: DataFrame) -> DataFrame:
    """AGG-12, AGG-45, SNK-10: tasks by status."""
    return status.groupBy("url_status", "document_status", "extract_status", F.coalesce("blocking_reason", F.lit("")).alias("blocking_reason")).agg(F.count("*").alias("n"))


def queue_depth(document: DataFrame, known: Sequence[str]) -> DataFrame:
    """AGG-29: one row: documents by known status, everything else under other."""
    s = F.coalesce("status", F.lit("pending"))
    return document.agg(*[F.count_if(s == k).alias(k) for k in known], F.count_if(~s.isin(*known)).alias("other"))


def pipeline_stats(document: DataFrame) -> DataFrame:
    """AGG-25, AGG-46: documents by status, by class and by period, in one pass with grouping sets."""
    cols = ["status", "doc_class", "period"]
    d = document.select(*[F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(c) for c in cols])
    out = d.groupingSets([["status"], ["doc_class"], ["period"]], *cols).agg(F.count("*").alias("n"))
    kind = F.when(F.col("status").isNotNull(), "status").when(F.col("doc_class").isNotNull(), "doc_class").otherwise("period")
    return out.select(kind.alias("kind"), F.coalesce(*cols).alias("value"), "n")


def quality_warnings(fact: DataFrame) -> DataFrame:
    """AGG-16: counters of current rows that need a look before export."""
    c = F.col("confidence")
    return fact.filter("is_current").agg(
        F.count_if(c.isNull()).alias("no_confidence"), F.count_if(c < CUTOFFS[1]).alias("below_review"), F.count_if((c >= CUTOFFS[1]) & (c < CUTOFFS[0])).alias("flagged"), F.count_if(F.col("capacity").isNull()).alias("no_capacity"),
    )


def exclusions(units: DataFrame, supports: DataFrame, least: float = CUTOFFS[1]) -> DataFrame:
    """SET-01, AGG-51: rows of both fact tables that confidence keeps out of the export."""
    def low(df: DataFrame, kind: str) -> DataFrame:
        return df.filter(F.col("is_current") & (F.col("confidence") < least)).select(F.lit(kind).alias("kind"), "entity_id", "period", "confidence")

    return low(units, "unit").unionByName(low(supports, "support"), allowMissingColumns=True)


def rows_by_document_status(document: DataFrame, fact: DataFrame) -> DataFrame:
    """AGG-50: fact rows by their document's status: distinct documents, rows, rows with confidence, mean, rounded."""
    j = document.select("document_id", "status").join(fact.select("document_id", "confidence"), "document_id", "left")
    return j.groupBy("status").agg(F.count_distinct("document_id").alias("documents"), F.count_if(F.col("confidence").isNotNull()).alias("scored_rows"), F.round(F.avg("confidence"), 3).alias("mean_confidence"))


def hosts(site: DataFrame, entity_flag: DataFrame) -> DataFrame:
    """AGG-47, AGG-48: entities of a kind by the host of their sites, each once for a host."""
    from veritab.functions.urls import host

    return site.join(entity_flag.select("entity_id"), "entity_id", "left_semi").groupBy(host(F.col("url")).alias("host")).agg(F.count_distinct("entity_id").alias("entities"))


def owners_without_url(entity: DataFrame, site: DataFrame, samples: int = 3) -> DataFrame:
    """AGG-49, AGG-42: owners by their entities without a site, with regions and the first names as samples."""
    missing = entity.filter("active").join(site.select("entity_id"), "entity_id", "left_anti")
    n = F.row_number().over(Window.partitionBy("owner").orderBy("name"))
    few = missing.withColumn("_n", n)
    return few.groupBy("owner").agg(
        F.count("*").alias("entities"), F.array_join(F.sort_array(F.collect_set("region")), ",").alias("regions"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("_n") <= samples, F.col("name")))), ",").alias("samples"),
    )


def top_n(rows: DataFrame, by: str, n: int) -> DataFrame:
    """SORT-11, AGG-18: the n most frequent values, ties by value."""
    return rows.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), by).limit(n)


def snapshot_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """AGG-34: metric by metric, what changed; a missing metric counts as 0."""
    j = before.select("metric", F.col("value").alias("b")).join(after.select("metric", F.col("value").alias("a")), "metric", "full_outer")
    return j.select("metric", (F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0))).alias("delta"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """AGG-36: rows by table."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def yield_bound(processed: Column, successes: Column, total: Column, required: float) -> dict[str, Column]:
    """AGG-33: the yield in percent that is certain, the most that is still possible, and whether that meets the
    requirement; nothing is certain or possible of nothing."""
    possible = F.coalesce(F.try_divide((successes + F.greatest(F.lit(0), total - processed)) * 100.0, total), F.lit(0.0))
    return {"certain": F.coalesce(F.try_divide(successes * 100.0, total), F.lit(0.0)), "possible": possible, "reachable": (total > 0) & (possible >= required)}
