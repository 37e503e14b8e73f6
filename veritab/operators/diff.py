"""Keyed comparisons of two sources.

All count the rows of a key on each side before anything else: a key with more than one row on a side is ambiguous and
is reported, never resolved by picking a row.  Both sides are aggregated by key before the full-outer join, so the join
is one row against one row and a hot key cannot multiply.  Keys may hold nulls, which are equal to each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions import states
from veritab.functions.numbers import values_equal, within
from veritab.functions.text import granularity_collision, join_key, join_key_label
from veritab.streaming.state import stored

FIVE = ("exact_match", "value_mismatch", "missing_actual", "unexpected_actual", "ambiguous_key")
SEVEN_EXTERNAL = ("match", "value_mismatch", "missing_in_primary", "missing_in_external", "ambiguous_key_not_comparable", "needs_review_not_comparable", "excluded_not_comparable")
SEVEN_MASTER = ("match", "value_mismatch", "missing_in_extraction", "missing_in_master", "ambiguous_key", "needs_review_not_comparable", "excluded_not_comparable")


def _by_key(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(f"{side}_rows"), F.first("value").alias(f"{side}_value"))


def _null_safe(a: str, b: str, keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def five_way(expected: DataFrame, actual: DataFrame, keys: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """JOIN-01, SET-02: one row for each key of either side: category, expected_value, actual_value.

    Values are numbers and compared within the tolerance; null equals null.  An ambiguous key shows no values.
    """
    e, a = _by_key(expected, keys, "expected").alias("e"), _by_key(actual, keys, "actual").alias("a")
    joined = e.join(a, _null_safe("e", "a", keys), "full_outer")
    ne, na = F.coalesce("expected_rows", F.lit(0)), F.coalesce("actual_rows", F.lit(0))
    category = (
        F.when((ne > 1) | (na > 1), "ambiguous_key")
        .when(na == 0, "missing_actual")
        .when(ne == 0, "unexpected_actual")
        .when(within(F.col("expected_value"), F.col("actual_value"), tolerance), "exact_match")
        .otherwise("value_mismatch")
    )
    shown = [F.when(category != "ambiguous_key", F.col(c)).alias(c) for c in ("expected_value", "actual_value")]
    return joined.select(*[F.when(ne > 0, F.col(f"e.{k}")).otherwise(F.col(f"a.{k}")).alias(k) for k in keys], category.alias("category"), *shown)


def summary(rows: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """AGG-13, AGG-14: rows by category, 0 for categories that do not occur."""
    spark = rows.sparkSession
    every = spark.createDataFrame([(n,) for n in names], f"{column} string")
    counted = rows.groupBy(column).agg(F.count("*").alias("n"))
    return F.broadcast(every).join(counted, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def gate(rows: DataFrame, scope: Sequence[str], gate_metrics: Sequence[str], reconcile_metrics: Sequence[str]) -> DataFrame:
    """CLS-11: by scope: pass, pass_with_reconciliation or fail, and how many entries speak against it.

    Gate metrics must match exactly and no key may be ambiguous; other differences of reconcile metrics are told.
    """
    off = F.col("category") != "exact_match"
    fails = (F.col("category") == "ambiguous_key") | (F.col("metric").isin(*gate_metrics) & off)
    told = ~fails & F.col("metric").isin(*reconcile_metrics) & off
    out = rows.groupBy(*scope).agg(F.count_if(fails).alias("gate_failures"), F.count_if(told).alias("reconciliations"))
    status = F.when(F.col("gate_failures") > 0, "fail").when(F.col("reconciliations") > 0, "pass_with_reconciliation").otherwise("pass")
    return out.withColumn("status", status)


def reconciliation_report(rows: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Value mismatches of reconcile metrics with both values and their difference; never resolved on its own."""
    hit = rows.filter(F.col("metric").isin(*metrics) & (F.col("category") == "value_mismatch"))
    return hit.withColumns({"delta": F.col("actual_value") - F.col("expected_value"), "classification": F.lit("cross_source_delta"), "operator_decision": F.lit("needs_owner_decision")})


def _categories(rows: DataFrame, scope: Sequence[str], side: str) -> DataFrame:
    return rows.groupBy(*scope, "unit").agg(F.sort_array(F.collect_set(F.coalesce("category", F.lit("")))).alias(f"{side}_categories"))


def align_categories(expected: DataFrame, actual: DataFrame, scope: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """JOIN-04: both sides with aligned, `*|unit` where a unit has at most one category on each side in its scope, else
    `category|unit`; and the units whose categories differ across the sides.
    """
    on = [*scope, "unit"]
    e, a = _categories(expected, scope, "expected"), _categories(actual, scope, "actual")
    both = e.join(a, on, "full_outer").withColumns({s: F.coalesce(s, F.array().cast("array<string>")) for s in ("expected_categories", "actual_categories")})
    folds = (F.size("expected_categories") <= 1) & (F.size("actual_categories") <= 1)
    both = both.withColumn("folds", folds)

    def rewrite(rows: DataFrame) -> DataFrame:
        out = rows.join(both.select(*on, "folds"), on, "left")
        return out.withColumn("aligned", F.concat_ws("|", F.when(F.col("folds"), "*").otherwise(F.coalesce("category", F.lit(""))), "unit")).drop("folds")

    one = folds & (F.size("expected_categories") == 1) & (F.size("actual_categories") == 1)
    delta = both.filter(one & (F.get("expected_categories", F.lit(0)) != F.get("actual_categories", F.lit(0))))
    delta = delta.select(*on, F.get("expected_categories", F.lit(0)).alias("expected_category"), F.get("actual_categories", F.lit(0)).alias("actual_category"))
    return rewrite(expected), rewrite(actual), delta


def key_collisions(rows: DataFrame, scope: Sequence[str], side: str) -> DataFrame:
    """AGG-22: units with more than one category in a scope, on one side."""
    found = _categories(rows, scope, "side").filter(F.size("side_categories") > 1)
    return found.select(*scope, "unit", F.array_join("side_categories", ",").alias("categories"), F.lit(side).alias("side"))


PAYLOAD = ("review_id", "review_status", "final_value", "reviewed_unit", "source_row", "value", "other_unit")


#: What rows of two sides are joined by: the key's text, behind its hash, by which rows sort fast.
KEY = ["h", "k"]


def _both_sides(reviewed: DataFrame, other: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides under one another, with their key and its label; and the ambiguous keys, with how many rows
    each side has.

    Names are folded once, into a table in the shared folder.  Keys are counted with partial sums, so no key's rows are
    ever gathered.
    """
    wanted = reviewed.filter(F.col("metric").isNotNull() & (F.col("metric") != "") & F.col("unit").isNotNull() & (F.col("unit") != ""))
    key = join_key(F.col("entity"), F.col("category"), F.col("unit"), F.col("period"), F.col("metric"))
    none = lambda kind: F.lit(None).cast(kind)
    ours = wanted.select(F.lit(True).alias("ours"), key.alias("key"), F.col("review_id").cast("long").alias("review_id"), "review_status", "final_value", F.col("unit").alias("reviewed_unit"), none("long").alias("source_row"), none("string").alias("value"), none("string").alias("other_unit"))
    source = F.col("source_row").cast("long") if "source_row" in other.columns else none("long")
    theirs = other.select(F.lit(False).alias("ours"), key.alias("key"), none("long").alias("review_id"), none("string").alias("review_status"), none("string").alias("final_value"), none("string").alias("reviewed_unit"), source.alias("source_row"), "value", F.col("unit").alias("other_unit"))
    rows = ours.unionByName(theirs)
    # nulls and bars inside a part must not make two keys one
    parts = [F.coalesce(F.col(f"key.{n}").cast("string"), F.lit("\u0000")) for n in ("entity", "category", "unit", "period", "metric")]
    rows = rows.select(F.concat_ws("\u001f", *parts).alias("k"), join_key_label(F.col("key")).alias("key"), "ours", *PAYLOAD)
    rows = stored(rows.select(F.xxhash64("k").alias("h"), "*"), "both-sides")
    counts = rows.groupBy(*KEY).agg(F.count_if("ours").alias("reviewed_rows"), F.count_if(~F.col("ours")).alias("other_rows"))
    return rows, counts.filter((F.col("reviewed_rows") > 1) | (F.col("other_rows") > 1))


def _single(rows: DataFrame, ambiguous: DataFrame, status: Column) -> DataFrame:
    """One row for each key with one row on a side at most, with what both sides say, and its status: the sides without
    ambiguous keys are joined row against row."""
    clear = rows.join(ambiguous.select(*KEY), KEY, "left_anti")
    ours = clear.filter("ours").select(*KEY, "key", "review_id", "review_status", "final_value", "reviewed_unit")
    theirs = clear.filter(~F.col("ours")).select(*KEY, F.col("key").alias("other_key"), "source_row", "value", "other_unit", F.lit(1).alias("there"))
    paired = ours.withColumn("here", F.lit(1)).join(theirs, KEY, "full_outer").withColumns({"reviewed_rows": F.coalesce("here", F.lit(0)), "other_rows": F.coalesce("there", F.lit(0)), "key": F.coalesce("key", "other_key")})
    return paired.withColumns({"status": status, "reason": F.lit("")})


def _status(missing: str, missing_other: str, ambiguous: str) -> Column:
    return (
        F.when(F.col("reviewed_rows") == 0, missing)
        .when(F.col("review_status") == "excluded", "excluded_not_comparable")
        .when(F.col("final_value").isNull(), "needs_review_not_comparable")
        .when(F.col("other_rows") == 0, missing_other)
        .when(granularity_collision(F.col("reviewed_unit"), F.col("other_unit")), ambiguous)
        .when(values_equal(F.col("final_value"), F.col("value")), "match")
        .otherwise("value_mismatch")
    )


def _reason(first: str, second: str) -> Column:
    parts = [F.when(F.col(f"{s}_rows") > 1, F.concat(F.lit(f"duplicate {name} rows="), F.col(f"{s}_rows").cast("string"))) for s, name in (("reviewed", first), ("other", second))]
    return F.concat_ws("; ", *parts)


def compare_external(reviewed: DataFrame, external: DataFrame) -> DataFrame:
    """JOIN-02, FLT-09 upstream: reviewed rows against external ones, seven statuses.

    reviewed: entity, category, unit, period, metric, review_id, review_status, final_value; external: the same key
    columns, source_row, value.  An ambiguous key emits every candidate of both sides, each on its own row.
    """
    rows, ambiguous = _both_sides(reviewed, external)
    single = _single(rows, ambiguous, _status("missing_in_primary", "missing_in_external", "ambiguous_key_not_comparable"))
    many = rows.join(ambiguous, KEY).withColumns({"status": F.lit("ambiguous_key_not_comparable"), "reason": _reason("reviewed", "external")})
    shown = ["key", "review_id", "source_row", F.col("final_value").alias("primary_value"), F.col("value").alias("external_value"), "status", "reason"]
    return single.select(*shown).unionByName(many.select(*shown)).withColumn("result", states.truth_label(F.col("status")))


def diff_master(reviewed: DataFrame, master: DataFrame) -> DataFrame:
    """JOIN-03: reviewed rows against the master's, seven statuses.

    An ambiguous key emits the reviewed candidates if there are any, else the master's.
    """
    rows, ambiguous = _both_sides(reviewed, master)
    single = _single(rows, ambiguous, _status("missing_in_extraction", "missing_in_master", "ambiguous_key"))
    many = rows.join(ambiguous, KEY).withColumns({"status": F.lit("ambiguous_key"), "reason": _reason("reviewed", "master")})
    # of several candidates against one row of the master, each shows its value
    only = many.filter("not ours AND other_rows = 1").select(*KEY, F.col("value").alias("only_value"))
    ours = many.filter("ours").drop("value").join(only, KEY, "left").withColumnRenamed("only_value", "value")
    theirs = many.filter("reviewed_rows = 0")
    shown = ["key", "review_id", F.col("final_value").alias("extracted_value"), F.col("value").alias("expected_value"), "status", "reason"]
    return single.select(*shown).unionByName(ours.select(*shown)).unionByName(theirs.select(*shown))


def final_value(status: Column, extracted: Column, corrected: Column) -> Column:
    """FLT-09: the value that a review ends with."""
    return F.when(status == "accepted", extracted).when(status == "corrected", corrected)


def final_ready(status: Column, confidence: Column, least: float = 0.85) -> Column:
    """FLT-10: corrected, or accepted with enough confidence."""
    return F.coalesce((status == "corrected") | ((status == "accepted") & (confidence >= least)), F.lit(False))


def effective_value(outcome: Column, primary: Column, external: Column, corrected: Column) -> Column:
    """UPD-10: the value that a resolution settles on."""
    return F.when(outcome == "accept_primary", primary).when(outcome == "accept_external", external).when(outcome == "correct", corrected)


def resolution_errors(outcome: Column, corrected: Column, external: Column, reason: Column) -> Column:
    """UPD-09: what is wrong with a resolution: none may be written whose list is not empty."""
    return states.errors(
        (~outcome.isin("accept_primary", "accept_external", "correct", "unresolved"), "unknown outcome"),
        ((outcome == "correct") & corrected.isNull(), "a correction needs a value"),
        ((outcome != "correct") & corrected.isNotNull(), "only a correction has a value"),
        ((outcome == "accept_external") & external.isNull(), "no external value to accept"),
        (F.trim(F.coalesce(reason, F.lit(""))) == "", "a reason is needed"),
    )


def cells(rows: DataFrame, sheet: Column, row: Column, columns: Sequence[str]) -> DataFrame:
    """A table as (sheet, row, col, value) cells, for cell-by-cell comparison."""
    wide = rows.select(sheet.alias("sheet"), row.alias("row"), *[F.col(c).cast("string").alias(c) for c in columns])
    return wide.unpivot(["sheet", "row"], list(columns), "col", "value")


def cell_diff(new: DataFrame, old: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """AGG-39, NUM-06: cells of two tables that differ, with how."""
    from veritab.functions.numbers import difference_category

    joined = new.alias("n").join(old.alias("o"), ["sheet", "row", "col"], "full_outer")
    kind = difference_category(F.coalesce("n.value", F.lit("")), F.coalesce("o.value", F.lit("")), tolerance)
    return joined.select("sheet", "row", "col", F.col("n.value").alias("new_value"), F.col("o.value").alias("old_value"), kind.alias("kind")).filter("kind <> 'equal'")


def row_counts(new: DataFrame, old: DataFrame, sheet: str = "sheet") -> DataFrame:
    """AGG-38, SET-04: rows by sheet on both sides; a sheet that one side lacks has 0 there."""
    n, o = (df.groupBy(sheet).agg(F.count("*").alias(name)) for df, name in ((new, "new_rows"), (old, "old_rows")))
    return n.join(o, sheet, "full_outer").select(sheet, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("new_rows", "old_rows")])


def business_diff(new: DataFrame, old: DataFrame, keys: Sequence[str], fields: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """AGG-40: by business key and field: missing, extra and different cells; keys that differ in punctuation only are
    soft matches."""
    from veritab.functions.numbers import difference_category
    from veritab.functions.text import soft_key_part

    def long(df: DataFrame) -> DataFrame:
        return df.select(*keys, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(list(keys), list(fields), "field", "value")

    joined = long(new).withColumn("here", F.lit(True)).alias("n").join(long(old).withColumn("there", F.lit(True)).alias("o"), [*keys, "field"], "full_outer")
    kind = F.when(F.col("there").isNull(), "extra_row").when(F.col("here").isNull(), "missing_row").otherwise(difference_category(F.coalesce("n.value", F.lit("")), F.coalesce("o.value", F.lit("")), tolerance))
    rows = joined.select(*keys, "field", F.col("n.value").alias("new_value"), F.col("o.value").alias("old_value"), kind.alias("kind")).filter("kind <> 'equal'")
    soft = F.concat_ws("|", *[soft_key_part(F.col(k).cast("string")) for k in keys])
    extra = rows.filter("kind = 'extra_row'").select(soft.alias("soft")).distinct().withColumn("soft_match", F.lit(True))
    return rows.withColumn("soft", soft).join(extra, "soft", "left").withColumn("soft_match", (F.col("kind") == "missing_row") & F.coalesce("soft_match", F.lit(False))).drop("soft")


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-37, JOIN-24: keys that occur more than once, and how often."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
