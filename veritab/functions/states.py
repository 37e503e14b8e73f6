"""Classifiers and state functions: ordered rules as column expressions.

Rules over all of an entity's rows take flags that an aggregation has made (see operators.report); the order of the
rules is what matters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritab.functions.text import folded

# Fixed values.
TARGET_MARKERS = ("様式第2号", "機関要件", "修学支援", "生徒総定員", "学科名")
VOCATIONAL_MARKERS = ("職業実践専門課程等の基本情報", "職業実践専門課程の基本情報", "別紙様式4")
BLOCK_MARKERS = ("access denied", "you have been blocked", "captcha", "perimeterx", "imperva incapsula")
BLOCK_CODES = (403, 418, 429, 503)
EVIDENCE_RANK = {"none": 0, "url_hint": 1, "conflict": 2, "pdf_text": 3, "prev_year_diff": 4, "operator_override": 5}
TRUST_TIERS = {
    "national_index": "t0_national", "region_index": "t1_authority_index", "authority_index": "t1_authority_index", "official_site": "t2_official_site",
    "domain_override": "t3_operator_approved", "seed_csv": "t3_operator_approved", "operator_manual": "t3_operator_approved",
    "owner_pattern": "t4_search_candidate", "web_search": "t4_search_candidate", "external_search": "t4_search_candidate", "site_map": "t4_search_candidate",
}
GAP_REASONS = (
    ("ocr_pending", "ocr_pending_only"), ("in_progress", "in_progress_only"), ("entity_mismatch", "mismatch_only"), ("transient_error", "transient_error_only"),
    ("permanent_error", "permanent_error_only"), ("parse_failed", "parse_failed_only"), ("no_file", "no_file_only"), ("support_only", "support_only"),
    ("non_target", "non_target_only"), ("pending", "in_progress_only"),
)


def _count(text: Column, words: tuple[str, ...]) -> Column:
    return sum((text.contains(w).cast("int") for w in words), F.lit(0))


def text_class(c: Column, markers: tuple[str, ...] = TARGET_MARKERS, vocational: tuple[str, ...] = VOCATIONAL_MARKERS, fold: bool = True) -> Column:
    """CLS-01: target, non_target or image_only by a document's text."""
    text = folded(c) if fold else F.coalesce(c, F.lit(""))
    blank = F.regexp_replace(text, r"(?U)\s+", "") == ""
    return F.when(blank, "image_only").when(_count(text, vocational) > 0, "non_target").when(_count(text, markers) >= 2, "target").when(c.contains("(cid:"), "image_only").otherwise("non_target")


def evidence_bucket(f: dict[str, Column]) -> Column:
    """CLS-02: an entity's bucket by flags over its evidence rows, in order.

    f: any_rows, accepted, mismatch, yearless, old_year, image_form, no_candidates, all_errors, any_errors, any_tls.
    """
    return (
        F.when(~f["any_rows"], "no_evidence")
        .when(f["accepted"], "accepted_target_pdf")
        .when(f["mismatch"], "entity_identity_mismatch")
        .when(f["yearless"], "target_form_without_year_evidence")
        .when(f["old_year"], "publication_lag_or_old_target_pdf")
        .when(f["image_form"], "target_form_without_year_evidence")
        .when(f["no_candidates"], "no_pdf_candidates")
        .when(f["all_errors"] & f["any_tls"], "tls_certificate_verify_failed")
        .when(f["all_errors"], "site_fetch_error_only")
        .when(f["any_errors"], "mixed_with_site_fetch_error")
        .otherwise("non_target_candidates_only")
    )


def period_evidence(override: Column, parsed: Column, url_hit: Column, target: int) -> Column:
    """CLS-03: the strongest evidence of a document's period: level, rank and the period it tells."""

    def level(name: str, period: Column) -> Column:
        return F.struct(F.lit(name).alias("level"), F.lit(EVIDENCE_RANK[name]).alias("rank"), period.cast("int").alias("period"))

    return (
        F.when(override == target, level("operator_override", override))
        .when(override.isNotNull(), level("conflict", override))
        .when(parsed == target, level("pdf_text", parsed))
        .when(parsed.isNotNull(), level("conflict", parsed))
        .when(url_hit, level("url_hint", F.lit(target)))
        .otherwise(level("none", F.lit(None)))
    )


def url_status(any_crawlable: Column, any_region: Column, any_operator: Column) -> Column:
    """CLS-04."""
    return F.when(~any_crawlable, "no_url").when(any_region, "region_url").when(any_operator, "operator_url").otherwise("unknown")


def document_status(confirmed: Column, image_current: Column, any_ocr: Column, stale: Column, any_docs: Column) -> Column:
    """CLS-05."""
    return F.when(confirmed, "confirmed_target").when(image_current | any_ocr, "image_pending").when(stale, "rejected_stale").when(any_docs, "discovered").otherwise("none")


def extract_status(has_rows: Column, any_ocr: Column, any_failed: Column) -> Column:
    """CLS-06."""
    return F.when(has_rows, "parsed").when(any_ocr, "ocr_pending").when(any_failed, "parse_failed").otherwise("none")


def evidence_level(best: Column, any_conflict: Column, status: Column) -> Column:
    """CLS-07: the best level, but a conflict where only stale documents stand."""
    return F.when(best.isNull(), "none").when((status == "rejected_stale") & any_conflict, "conflict").otherwise(best)


def blocking_reason(url: Column, document: Column, extract: Column, ready: Column) -> Column:
    """CLS-08: why an entity is not ready; null if it is."""
    return (
        F.when(ready, None)
        .when((document == "none") & (url == "no_url"), "no_url")
        .when(document == "none", "no_target_pdf")
        .when(document == "publication_lag", "publication_lag_latest_public")
        .when(document == "target_year_unverified", "target_year_unverified")
        .when(document == "site_error", "tls_certificate_verify_failed")
        .when(document == "rejected_stale", "stale_pdf_only")
        .when(document == "image_pending", "ocr_pending")
        .when(extract == "parse_failed", "parse_failed")
        .when(extract == "none", "not_extracted")
        .otherwise("review_required")
    )


def next_action(reason: Column, site_is_document: Column) -> Column:
    """CLS-09: what an operator does next; a direct document link is no lasting entry point."""
    by_reason = (
        F.when(reason.isNull(), "export")
        .when(reason == "no_url", "add_url")
        .when(reason == "no_target_pdf", "find_document")
        .when(reason.isin("publication_lag_latest_public", "stale_pdf_only"), "await_publication")
        .when(reason.isin("target_year_unverified", "not_extracted", "review_required"), "check_document")
        .when(reason == "tls_certificate_verify_failed", "check_certificate")
        .when(reason == "ocr_pending", "recognise_or_enter")
        .when(reason == "parse_failed", "enter")
        .when(reason == "dept_change_review", "check_unit_changes")
        .otherwise("check")
    )
    return F.when(site_is_document & reason.isin("no_target_pdf", "publication_lag_latest_public", "stale_pdf_only"), "add_url").otherwise(by_reason)


def truth_label(status: Column) -> Column:
    """CLS-10: TRUE for a match, FALSE for a difference, blank for what cannot be compared."""
    return F.when(status == "match", "TRUE").when(status.isin("value_mismatch", "missing_in_primary", "missing_in_external"), "FALSE").otherwise("")


def gap_diagnosis(has_entity: Column, ambiguous: Column, has_units: Column, has_unit: Column, has_document: Column, has_rows: Column) -> Column:
    """CLS-12: why a template row has no value."""
    return (
        F.when(ambiguous, "ambiguous_entity")
        .when(~has_entity, "entity_missing")
        .when(~has_units, F.when(has_document, "no_units_parsed").otherwise("no_document"))
        .when(~has_unit, "unit_unmatched")
        .when(~has_rows, F.when(has_document, "no_rows_for_period").otherwise("no_document_for_period"))
    )


def trust_tier(method: Column) -> Column:
    """CLS-13: unknown methods are untrusted."""
    out = F.lit("t5_untrusted")
    for name, tier in TRUST_TIERS.items():
        out = F.when(method == name, tier).otherwise(out)
    return out


def lane(kind: Column) -> Column:
    """CLS-14."""
    return F.when(kind == "text", "text_extraction").when(kind == "image", "ocr").otherwise("manual_review")


def alias_class(matches: Column, same_stem: Column) -> Column:
    """CLS-15, CLS-16: how sure a proposal is by how many candidates it has."""
    return F.when(matches == 0, "no_candidate").when((matches == 1) & same_stem, "auto_alias").when(matches == 1, "review_alias").otherwise("ambiguous")


def predicted_outcome(reason: Column, document_class: Column) -> Column:
    """CLS-17: the outcome that an evidence row predicts; null if it says nothing."""
    return (
        F.when(reason == "accepted_downloaded", "accepted_target_pdf")
        .when(reason.startswith("fiscal_year_mismatch:") & F.coalesce(document_class == "image_only", F.lit(False)), "needs_operator_review")
        .when(reason.startswith("fiscal_year_mismatch:"), "publication_lag_latest_public")
        .when(reason == "target_fiscal_year_not_detected", "needs_operator_review")
        .when(reason.isin("no_candidates_found", "all_negative_score", "classified_non_target", "pre_filtered_non_target_hint"), "no_target_candidate_found")
        .when((reason == "discovery_error") | reason.startswith("http_error:"), "site_fetch_error")
    )


def low_risk_expansion(parsed: Column, target: Column, extra: tuple[str, ...] = ("専門学校", "学校")) -> Column:
    """CLS-18: whether one name is the other plus a harmless ending."""
    rest = F.substring(parsed, F.length(target) + 1, F.length(parsed))
    return parsed.startswith(target) & rest.isin(*extra)


def errors(*checks: tuple[Column, str]) -> Column:
    """CLS-19, CLS-20, FLT-15, FLT-16: the messages of all checks that fail, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), message) for bad, message in checks]))


def blocked(code: Column, body: Column) -> Column:
    """CLS-21: whether a response tells that the crawler is locked out."""
    low = F.lower(F.coalesce(body, F.lit("")))
    return F.coalesce(code.isin(*BLOCK_CODES), F.lit(False)) | (_count(low, BLOCK_MARKERS) > 0)


def document_gap(current: Column, any_target: Column, other_ingested: Column, statuses: Column) -> Column:
    """AGG-07: the reason why an entity with documents has no valid one of the period; null if it has."""
    out = F.when(current, None).when(any_target, "stale_pdf_only").when(other_ingested, "non_target_only")
    for status, reason in GAP_REASONS:
        out = out.when(F.array_contains(statuses, status), reason)
    return out.otherwise("other_only")
