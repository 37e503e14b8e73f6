"""Evaluation against gold sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions.numbers import evaluated_equal
from veritab.functions.text import squeezed


def matched_units(gold: DataFrame, parsed: DataFrame) -> DataFrame:
    """JOIN-10: (doc_id, gold_pos, parsed_pos): greedy one-to-one matches inside each document.

    gold: doc_id, gold_pos, name, shift, years; parsed: doc_id, parsed_pos and the same.  In gold order, each unit takes
    the first free parsed one whose name holds or is held by its own, with equal shift and years if there is one, else
    by name only; parsed units that share a place are taken together.  Empty and null names match nothing; an empty table gives no rows.
    """
    unit = lambda rows, place, side: rows.select("doc_id", F.col(place), squeezed(F.col("name")).alias(f"{side}_key"), F.col("shift").alias(f"{side}_shift"), F.col("years").alias(f"{side}_years"))
    g, p = unit(gold, "gold_pos", "g").filter("g_key <> ''"), unit(parsed, "parsed_pos", "p").filter("p_key <> ''")
    held = F.col("g_key").contains(F.col("p_key")) | F.col("p_key").contains(F.col("g_key"))
    other = ~(F.col("g_shift").eqNullSafe(F.col("p_shift")) & F.col("g_years").eqNullSafe(F.col("p_years")))
    # units that share a place are told apart by what they say, and equal ones by a number
    said = ["gold_pos", "g_key", "g_shift", "g_years"]
    g = g.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id", *said).orderBy("doc_id"))).withColumn("unit", F.struct(*said, "_n"))
    edges = g.join(p, "doc_id").filter(held).select("doc_id", "unit", "parsed_pos", F.struct(other.alias("other"), "parsed_pos").alias("choice")).distinct()
    return greedy_matches(edges, ["doc_id"], "unit", "parsed_pos", "choice").select("doc_id", F.col("unit.gold_pos").alias("gold_pos"), "parsed_pos")


def greedy_matches(edges: DataFrame, group: Sequence[str], left: str, right: str, choice: str) -> DataFrame:
    """(group, left, right) of the sequential greedy matching: lefts in their order take their least choice that is free.

    In rounds: an edge is taken if it is its left's least choice among what is left, and its left is the first of all
    that could still take its right; no earlier one can then take it.  The first left of every group is settled in each
    round, and most are at once, so there are as many rounds as lefts wait for each other in one group.
    """
    from veritab.streaming.state import stored

    open_edges, taken = stored(edges.select(*group, left, right, choice), "edges"), None
    while open_edges.limit(1).count():
        by_left, by_right = Window.partitionBy(*group, left), Window.partitionBy(*group, right)
        settled = open_edges.withColumns({"_least": F.min(choice).over(by_left), "_first": F.min(left).over(by_right)}).filter((F.col("_least") == F.col(choice)) & (F.col("_first") == F.col(left)))
        settled = stored(settled.select(*group, left, right), "matches")
        taken = settled if taken is None else taken.unionByName(settled)
        for side in (left, right):
            open_edges = open_edges.join(settled.select(*group, side), [*group, side], "left_anti")
        open_edges = stored(open_edges, "edges")
    return open_edges.select(*group, left, right) if taken is None else taken


def field_accuracy(gold: DataFrame, parsed: DataFrame, key: Sequence[str], fields: Sequence[str], tolerance: float = 0.01) -> DataFrame:
    """AGG-20, NUM-18: by field: how many gold values there are and the share that the parsed value equals."""
    g = gold.select(*key, *[F.col(f).cast("double").alias(f) for f in fields]).unpivot(list(key), list(fields), "field", "gold")
    p = parsed.select(*key, *[F.col(f).cast("double").alias(f) for f in fields]).unpivot(list(key), list(fields), "field", "parsed")
    j = g.filter("gold IS NOT NULL").join(p, [*key, "field"], "left")
    return j.groupBy("field").agg(F.count("*").alias("n"), F.avg(evaluated_equal(F.col("gold"), F.col("parsed"), tolerance).cast("double")).alias("accuracy"))


def recall_precision(gold: DataFrame, parsed: DataFrame, key: Sequence[str]) -> DataFrame:
    """AGG-20: one row: recall and precision of keys."""
    j = gold.select(*key).distinct().withColumn("g", F.lit(1)).join(parsed.select(*key).distinct().withColumn("p", F.lit(1)), list(key), "full_outer")
    both, g, p = F.count_if(F.col("g").isNotNull() & F.col("p").isNotNull()), F.count("g"), F.count("p")
    return j.agg(g.alias("gold"), p.alias("parsed"), F.coalesce(F.try_divide(both, g), F.lit(0.0)).alias("recall"), F.coalesce(F.try_divide(both, p), F.lit(0.0)).alias("precision"))


def compared_predictions(gold: DataFrame, predicted: DataFrame, fields: Sequence[str]) -> DataFrame:
    """JOIN-11: by entry: ok, missing or unexpected, or the fields that differ."""
    j = gold.alias("g").join(predicted.alias("p"), "entry_id", "full_outer")
    wrong = F.array_compact(F.array(*[F.when(~F.col(f"g.{f}").eqNullSafe(F.col(f"p.{f}")), F.lit(f)) for f in fields]))
    there, told = F.col(f"g.{fields[0]}").isNotNull(), F.col(f"p.{fields[0]}").isNotNull()
    verdict = F.when(~told, "missing").when(~there, "unexpected").when(F.size(wrong) == 0, "ok").otherwise("mismatch")
    return j.select("entry_id", verdict.alias("verdict"), F.when(there & told, F.array_join(wrong, ",")).otherwise("").alias("fields"))


def gold_summary(entries: DataFrame) -> DataFrame:
    """AGG-19: entries by outcome, with the periods that they cover."""
    return entries.groupBy("outcome").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set(F.col("period").cast("string"))), ",").alias("periods"))


def entry_errors(entries: DataFrame, outcomes: Sequence[str]) -> DataFrame:
    """CLS-19, SRC-19: entries with what is wrong with them; duplicates of an id are told on every row."""
    from veritab.functions.states import errors

    n = F.count("*").over(Window.partitionBy("entry_id"))
    found = errors(
        (F.col("entry_id").isNull() | (F.col("entry_id") == ""), "no id"),
        (F.col("_n") > 1, "duplicate id"),
        (~F.coalesce(F.col("outcome"), F.lit("")).isin(*outcomes), "unknown outcome"),
        ((F.col("outcome") == "accepted") & F.col("url").isNull(), "accepted without an address"),
    )
    return entries.withColumn("_n", n).select("entry_id", found.alias("errors")).filter(F.size("errors") > 0)
