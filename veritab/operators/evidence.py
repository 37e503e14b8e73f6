"""Evidence logs: one row for each thing that a crawl saw, classified by entity, rolled up, and turned into plans.

evidence: entity_id, position, reason, pdf_type, pattern, url, text, target_period, error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions import states, urls

# Fixed values.
NOT_ACTIONABLE = ("candidate_budget_dropped", "candidate_entity_mismatch")
FORM_WORDS = ("確認申請", "申請書", "様式第2号", "様式2")
SYSTEM_WORDS = ("修学支援", "修学の支援", "高等教育", "無償化", "shugakushien", "syugakushien", "hutankeigen")
BUCKET_PRIORITY = (
    "target_form_without_year_evidence", "publication_lag_or_old_target_pdf", "entity_identity_mismatch", "mixed_with_site_fetch_error", "site_fetch_error_only",
    "tls_certificate_verify_failed", "non_target_candidates_only", "no_pdf_candidates", "no_evidence",
)
OUTCOMES = ("accepted_target_pdf", "publication_lag_latest_public", "needs_operator_review", "site_fetch_error", "no_target_candidate_found")
REASON_PRIORITY = ("accepted_downloaded", "pdf_entity_mismatch", "target_fiscal_year_not_detected", "fiscal_year_mismatch:", "no_candidates_found", "discovery_error")


def _any(text: Column, words: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return hit


def actionable(rows: DataFrame) -> DataFrame:
    """FLT-14."""
    return rows.filter(~F.coalesce(F.col("reason").isin(*NOT_ACTIONABLE), F.lit(False)))


def with_flags(rows: DataFrame) -> DataFrame:
    """What each evidence row says for CLS-02."""
    reason, text = F.coalesce("reason", F.lit("")), F.lower(F.concat_ws(" ", "text", "url"))
    years = F.transform(F.regexp_extract_all(text, F.lit(r"(?<!\d)(20\d{2})(?=\s*年度|/|[^/\s]*\.pdf\b)"), 1), lambda y: y.try_cast("int"))
    stale_hint = F.exists(years, lambda y: (y >= F.col("target_period") - 8) & (y < F.col("target_period")))
    form = (_any(text, SYSTEM_WORDS) & _any(text, FORM_WORDS)) | (text.contains("機関要件") & _any(text, FORM_WORDS))
    old = reason.startswith("fiscal_year_mismatch:")
    image = F.coalesce(F.col("pdf_type") == "image_only", F.lit(False))
    tls = F.lower(F.concat_ws(" ", reason, "error")).rlike("certificate[_ ]verify[_ ]failed")
    return rows.withColumns(
        {
            "accepted": reason == "accepted_downloaded",
            "mismatch": reason == "pdf_entity_mismatch",
            "yearless": (reason == "target_fiscal_year_not_detected") & ~F.coalesce(stale_hint, F.lit(False)),
            "old_year": old & (F.coalesce(F.col("pdf_type") == "target", F.lit(False)) | (image & form)),
            "image_form": image & form,
            "no_candidates": reason == "no_candidates_found",
            "is_error": reason == "discovery_error",
            "is_tls": tls,
        }
    )


FLAGS = ("accepted", "mismatch", "yearless", "old_year", "image_form", "no_candidates")


def bucket_aggregates() -> list[Column]:
    out = [F.bool_or(f).alias(f) for f in FLAGS]
    return [*out, F.bool_and("is_error").alias("all_errors"), F.bool_or("is_error").alias("any_errors"), F.bool_or("is_tls").alias("any_tls"), F.count("*").alias("rows")]


def bucket_column() -> Column:
    return states.evidence_bucket({**{f: F.col(f) for f in (*FLAGS, "all_errors", "any_errors", "any_tls")}, "any_rows": F.col("rows") > 0})


def buckets(rows: DataFrame) -> DataFrame:
    """CLS-02, STM-05: each entity's bucket and rows; the same aggregation serves batch and stream."""
    return with_flags(actionable(rows)).groupBy("entity_id").agg(*bucket_aggregates()).select("entity_id", bucket_column().alias("bucket"), "rows")


def rollup(rows: DataFrame, n: int) -> DataFrame:
    """AGG-18: the n most frequent reasons, types, patterns and hosts, ties by value, in one pass over the rows."""
    kinds = {"reason": F.coalesce("reason", F.lit("")), "pdf_type": F.coalesce("pdf_type", F.lit("null")), "pattern": F.coalesce("pattern", F.lit("")), "host": urls.host(F.col("url"))}
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds.items()])).alias("x")).select("x.*")
    counted = long.groupBy("kind", "value").agg(F.count("*").alias("n"))
    w = Window.partitionBy("kind").orderBy(F.col("n").desc(), "value")
    return counted.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def _reason_rank() -> Column:
    out = F.lit(len(REASON_PRIORITY))
    for i, r in reversed(list(enumerate(REASON_PRIORITY))):
        out = F.when(F.coalesce(F.col("reason"), F.lit("")).startswith(r), i).otherwise(out)
    return out


def representatives(rows: DataFrame, n: int) -> DataFrame:
    """WIN-21, WIN-15: the n most telling rows of each entity, by priority, then place in the log."""
    w = Window.partitionBy("entity_id").orderBy(_reason_rank(), "position")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def batch_plan(rows: DataFrame, limit: int) -> DataFrame:
    """WIN-22: entities not accepted, the most promising first: bucket, actionable rows, rows, id."""
    order = F.lit(len(BUCKET_PRIORITY))
    for i, b in reversed(list(enumerate(BUCKET_PRIORITY))):
        order = F.when(F.col("bucket") == b, i).otherwise(order)
    every = rows.groupBy("entity_id").agg(F.count("*").alias("candidates"))
    out = every.join(buckets(rows), "entity_id", "left").withColumns({"bucket": F.coalesce("bucket", F.lit("no_evidence")), "rows": F.coalesce("rows", F.lit(0))})
    return out.filter("bucket <> 'accepted_target_pdf'").orderBy(order, F.col("rows").desc(), F.col("candidates").desc(), "entity_id").limit(limit)


def plan_coverage(outcomes: DataFrame, plan: DataFrame) -> DataFrame:
    """SET-05: entities that outcomes lack, have too many of, or have without being planned."""
    counted = outcomes.groupBy("entity_id").agg(F.count("*").alias("n"))
    j = plan.select("entity_id", F.lit(True).alias("planned")).join(counted, "entity_id", "full_outer")
    problem = F.when(F.col("n").isNull(), "missing").when(F.col("planned").isNull(), "extra").when(F.col("n") > 1, "duplicate")
    return j.select("entity_id", problem.alias("problem")).filter("problem IS NOT NULL")


def packet(rows: DataFrame, sites: DataFrame, entity_id: int, n: int = 5) -> DataFrame:
    """AGG-52: one entity's bucket, sites and telling rows."""
    mine = rows.filter(F.col("entity_id") == entity_id)
    seen = sites.filter(F.col("entity_id") == entity_id).agg(F.sort_array(F.collect_list("url")).alias("sites"))
    told = representatives(mine, n).agg(F.sort_array(F.collect_list(F.struct("rank", "reason", "url"))).alias("evidence"))
    return buckets(mine).join(seen, F.lit(True), "left").join(told, F.lit(True), "left")


def predictions(rows: DataFrame) -> DataFrame:
    """CLS-17, WIN-10, JOIN-12: each entity's best predicted outcome by priority, ties to the first in the log."""
    outcome = states.predicted_outcome(F.col("reason"), F.col("pdf_type"))
    rank = F.lit(len(OUTCOMES))
    for i, name in reversed(list(enumerate(OUTCOMES))):
        rank = F.when(outcome == name, i).otherwise(rank)
    best = rows.withColumns({"outcome": outcome, "_rank": rank}).filter("outcome IS NOT NULL").groupBy("entity_id").agg(F.min_by(F.struct("outcome", "url"), F.struct("_rank", "position")).alias("b"))
    return best.select("entity_id", "b.outcome", "b.url")
