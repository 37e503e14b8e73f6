"""Ingest of parsed documents as one transform: identity, period, gate, revisions, carry-forward, document states."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.functions import numbers
from veritab.functions.text import name_variant
from veritab.operators import revision
from veritab.operators.report import valid_unit
from veritab.operators.workflow import identity_matches
from veritab.streaming.state import stored

MEASURES = ("capacity", "enrollment", "graduates", "dropouts")
UNIT = ("entity_id", "unit", "period")
SUPPORT = ("first_half_total", "second_half_total", "annual_total", "grand_total")


@dataclass(frozen=True)
class Ingested:
    """facts and support: rows to append; states: the state that each document ends in, with its rows written."""

    facts: DataFrame
    support: DataFrame
    states: DataFrame


def judged(documents: DataFrame, names: DataFrame, target: int) -> DataFrame:
    """Documents with problem: the parsed name is none of the entity's, or the period is unknown or too late; null if
    they may be ingested.

    documents: document_id, entity_id, parsed_name, period; names: entity_id, name, any number for each entity.
    """
    known = names.select("entity_id", name_variant(F.col("name")).alias("n")).groupBy("entity_id").agg(F.collect_set("n").alias("names"))
    told = documents.select("document_id", "entity_id", "period", name_variant(F.col("parsed_name")).alias("parsed")).join(known, "entity_id", "left")
    same = F.coalesce(identity_matches(F.col("parsed"), F.col("names")), F.lit(False))
    late = F.col("period").isNull() | (F.col("period") > target + 1)
    return told.withColumn("problem", F.when(~same, "entity_mismatch").when(late, "period_unknown")).drop("parsed", "names")


def _new_revisions(rows: DataFrame, existing: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The rows that differ from the current revision, with what they lack carried forward and the next number."""
    now = revision.current(existing, key).select(*key, *fields)
    merged = revision.carried(now, rows, key, fields).join(rows.select(*key, "document_id"), list(key))
    fresh = revision.changed(now, merged, key, fields)
    return revision.appended(existing.select(*key, "revision"), fresh, key, ["document_id"])


def ingest(documents: DataFrame, units: DataFrame, support: DataFrame, names: DataFrame, facts: DataFrame, recipients: DataFrame, target: int) -> Ingested:
    """UPD-01: parsed documents into fact and support revisions.

    documents as in judged; units: document_id, unit and MEASURES; support: document_id and SUPPORT; facts: UNIT,
    revision and MEASURES; recipients: entity_id, period, revision and SUPPORT.  Of several documents of one entity and
    period the last is taken, the others are superseded; of several rows of one unit that of the largest measures.  A unit whose confidence calls for review is not written; a
    document none of whose units is written is review_pending, and one whose rows say nothing new is unchanged.
    Verdicts, scored units and new facts are tables in the shared folder, as states rest on all of them.
    """
    checked = stored(judged(documents, names, target), "judged")
    good = checked.filter("problem IS NULL")
    last = good.groupBy("entity_id", "period").agg(F.max("document_id").alias("document_id"))
    one = units.groupBy("document_id", "unit").agg(F.max(F.struct(*MEASURES)).alias("m")).select("document_id", "unit", "m.*")
    rows = last.join(one, "document_id").filter(valid_unit(F.col("unit"), F.col("enrollment"), F.col("period")))
    prior = revision.current(facts, UNIT).select(*UNIT, F.col("enrollment").alias("prior"))
    required = [F.col(m) for m in MEASURES]
    b = numbers.breakdown(numbers.extraction_factor(required), required, F.col("enrollment"), F.col("prior"), "pdf_parse")
    scored = rows.join(prior, list(UNIT), "left").withColumn("confidence", F.round(b["composite"], 9)).withColumn("verdict", numbers.verdict(F.col("confidence")))
    scored = stored(scored, "scored")
    writable = scored.filter(F.col("verdict").isin("auto", "auto_flag")).select(*UNIT, "document_id", *MEASURES, "confidence", "verdict")
    new_facts = stored(_new_revisions(writable.drop("confidence", "verdict"), facts, UNIT, MEASURES).join(writable.select(*UNIT, "confidence", "verdict"), list(UNIT)), "facts")
    new_support = _new_revisions(last.join(support, "document_id"), recipients, ("entity_id", "period"), SUPPORT)
    per = scored.groupBy("document_id").agg(F.count("*").alias("units"))
    may = writable.groupBy("document_id").agg(F.count("*").alias("writable"))
    done = new_facts.groupBy("document_id").agg(F.count("*").alias("written"))
    newest = last.select("document_id", F.lit(True).alias("newest"))
    every = checked.join(newest, "document_id", "left").join(per, "document_id", "left").join(may, "document_id", "left").join(done, "document_id", "left")
    state = (
        F.when(F.col("problem").isNotNull(), F.col("problem")).when(F.col("newest").isNull(), "superseded").when(F.col("units").isNull(), "no_units").when(F.col("writable").isNull(), "review_pending")
        .when(F.col("written").isNull(), "unchanged").otherwise("ingested")
    )
    return Ingested(new_facts, new_support, every.select("document_id", state.alias("status"), F.coalesce("written", F.lit(0)).alias("written")))
