"""Versioned rows: revision and currentness are derived by windows; nothing is updated in place."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.streaming.state import stored


def numbered(rows: DataFrame, key: Sequence[str], order: Sequence[str | Column], start: Column | None = None) -> DataFrame:
    """WIN-02, WIN-03: rows with revision (counted on from start) and is_current, which holds for the last one."""
    w = Window.partitionBy(*key)
    out = rows.withColumn("revision", F.row_number().over(w.orderBy(*order)) + (start if start is not None else F.lit(0)))
    return out.withColumn("is_current", F.col("revision") == F.max("revision").over(w))


def appended(existing: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WIN-02: new rows as revisions after the highest one of their key."""
    top = existing.groupBy(*key).agg(F.max("revision").alias("top"))
    return numbered(new.join(top, list(key), "left"), key, order, F.coalesce("top", F.lit(0))).drop("top")


def current(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """FLT-01: the row of the highest revision of each key."""
    w = Window.partitionBy(*key).orderBy(F.col("revision").desc())
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def latest(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WIN-04, WIN-05, WIN-06: the last row of each key by max_by over a struct: no sort, and partial on the map side."""
    columns = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_best"))
    return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in columns])


def first_by(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """WIN-07, WIN-08, WIN-13, WIN-14: the first row of each key in an order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def overlaid(records: DataFrame, decisions: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """JOIN-18: records with the latest decision's columns where there is one."""
    last = latest(decisions.select(*key, *order, *columns), key, order).select(*key, *[F.col(c).alias(f"_d_{c}") for c in columns])
    out = records.join(last, list(key), "left")
    return out.withColumns({c: F.coalesce(f"_d_{c}", c) if c in records.columns else F.col(f"_d_{c}") for c in columns}).drop(*[f"_d_{c}" for c in columns])


def carried(existing: DataFrame, new: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """UPD-02: new rows over current ones: what the new one lacks is carried forward."""
    joined = new.alias("n").join(existing.alias("c"), list(key), "left")
    return joined.select(*key, *[F.coalesce(F.col(f"n.{f}"), F.col(f"c.{f}")).alias(f) for f in fields])


def changed(existing: DataFrame, new: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """UPD-03: new rows that differ from the current one in a field; the others need no revision."""
    joined = new.alias("n").join(existing.select(*key, F.struct(*fields).alias("_old")).alias("c"), list(key), "left")
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f"n.{f}").eqNullSafe(F.col(f"_old.{f}"))
    return joined.filter(F.col("_old").isNull() | ~same).select(*[F.col(f"n.{c}").alias(c) if c not in key else F.col(c) for c in new.columns])


def overridden(facts: DataFrame, document: Column, target: int, reason: str) -> tuple[DataFrame, DataFrame]:
    """UPD-04: a document's current rows moved to a target period: the facts with the moved rows appended as the
    target's last revision, and the audit rows of what was demoted and added."""
    moved = facts.filter(document & F.col("is_current") & (F.col("period") != target))
    added = moved.withColumn("period", F.lit(target)).drop("revision", "is_current")
    rest = facts.join(moved.select("unit_id", "period", "revision"), ["unit_id", "period", "revision"], "left_anti").drop("is_current")
    appended_rows = appended(facts.select("unit_id", "period", "revision"), added, ["unit_id", "period"], ["unit_id"]).drop("is_current")
    demoted = moved.drop("is_current").withColumn("demoted", F.lit(True))
    every = rest.withColumn("demoted", F.lit(False)).unionByName(demoted).unionByName(appended_rows.withColumn("demoted", F.lit(False)))
    top = F.max(F.when(~F.col("demoted"), F.col("revision"))).over(Window.partitionBy("unit_id", "period"))
    result = every.withColumn("is_current", F.coalesce(~F.col("demoted") & (F.col("revision") == top), F.lit(False))).drop("demoted")
    audit = moved.select(F.lit("period_override").alias("action"), "unit_id", F.col("period").alias("old_value"), F.lit(target).alias("new_value"), F.lit(reason).alias("reason"))
    return result, audit


def without_voided(events: DataFrame, voids: DataFrame, key: str) -> DataFrame:
    """UPD-19: events that no void event names."""
    return events.join(voids.select(key).distinct(), key, "left_anti")


def kept_hashes(rows: DataFrame, digest: str, order: str, terminal: Column) -> DataFrame:
    """WIN-01: duplicates of a content hash: the lowest id is kept, others are demoted unless they are terminal."""
    n = F.row_number().over(Window.partitionBy(digest).orderBy(order))
    return rows.withColumn("verdict", F.when(n == 1, "keep").when(terminal, "leave").otherwise("demote"))


def twins(rows: DataFrame, digest: str, key: str, status: str) -> DataFrame:
    """JOIN-26: rows that share another row's content, with that twin's id and the status that they inherit."""
    w = Window.partitionBy(digest).orderBy(key)
    first = rows.select(digest, key, F.first(key).over(w).alias("twin_id"), F.first(status).over(w).alias("inherited_status"))
    return first.filter(F.col(key) != F.col("twin_id")).select(key, "twin_id", "inherited_status")


def merged_units(units: DataFrame, children: DataFrame, key: Sequence[str], child_key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """WIN-20: duplicate units by null-safe key: the lowest id survives; children are pointed at it, unless it has one
    of the same child key already, or an earlier duplicate does."""
    marked = [F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in key]
    survivors = units.withColumn("survivor_id", F.min("unit_id").over(Window.partitionBy(*marked)))
    moved = children.join(survivors.select("unit_id", "survivor_id"), "unit_id")
    n = F.row_number().over(Window.partitionBy("survivor_id", *child_key).orderBy((F.col("unit_id") != F.col("survivor_id")).cast("int"), "unit_id"))
    kept = moved.withColumn("_n", n).filter("_n = 1").drop("_n", "unit_id").withColumnRenamed("survivor_id", "unit_id")
    return survivors.filter("unit_id = survivor_id").drop("survivor_id"), kept


def filled(rows: DataFrame, partition: Sequence[str], order: Sequence[str], column: str) -> DataFrame:
    """WIN-16, WIN-17, WIN-24: gaps filled with the last value before them."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(column, F.last(column, ignorenulls=True).over(w))


def attached(rows: DataFrame, partition: Sequence[str], order: str, name: str, value: str, parts: int = 200) -> DataFrame:
    """WIN-24: records that take two rows, a name and, below it, a value: each name with the first value that follows it
    before the next name; names without one have none.

    Rows are parted by ranges and names counted there, so no task sees a whole partition; where a range goes on with a
    partition, of which there are fewer than parts, the names of the ranges before are added.
    """
    # ranges follow a sample, so they are kept as they fell; only what a range goes on with is passed along
    ranged = stored(rows.select(*partition, order, name, value).repartitionByRange(parts, *partition, order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*partition).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.groupBy(*partition, "_part").agg(F.count(name).alias("_n")).withColumn("_before", F.sum("_n").over(before)).filter("_before > 0")
    starts = counted.select(*[F.col(p).alias(f"_{p}") for p in partition], F.col("_part").alias("_at"), "_before")
    same = reduce(Column.__and__, [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in partition], F.col("_part") == F.col("_at"))
    w = Window.partitionBy(*partition, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    within = ranged.withColumn("_within", F.count(name).over(w))
    turn = within.join(F.broadcast(starts), same, "left").withColumn("_turn", F.col("_within") + F.coalesce("_before", F.lit(0))).filter("_turn > 0")
    out = turn.groupBy(*partition, "_turn").agg(F.max(name).alias(name), F.min(F.when(F.col(value).isNotNull(), F.struct(order, value))).alias("_v"), F.min(order).alias(order))
    return out.select(*partition, order, name, F.col(f"_v.{value}").alias(value))


def blocks(rows: DataFrame, partition: Sequence[str], order: str, gap: float) -> DataFrame:
    """WIN-18: runs of neighbours no further apart than gap, numbered from 0."""
    w = Window.partitionBy(*partition).orderBy(order)
    jump = F.when(F.col(order) - F.lag(order).over(w) > gap, 1).otherwise(0)
    return rows.withColumn("_jump", jump).withColumn("block", F.sum("_jump").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_jump")


def first_seen(rows: DataFrame, key: Sequence[str], position: str) -> DataFrame:
    """SRC-03, SRC-04, T23: of rows with the same key, the first in source order."""
    return first_by(rows, key, [F.col(position)])


def best_duplicate(rows: DataFrame, key: Sequence[str], preference: Sequence[str], position: str) -> DataFrame:
    """WIN-12: of duplicates, the most preferred, ties to the first; at the first one's place."""
    order = F.struct(*preference, (-F.col(position)).alias("_p"))
    columns = [c for c in rows.columns if c not in key and c != position]
    out = rows.groupBy(*key).agg(F.max_by(F.struct(*columns), order).alias("_best"), F.min(position).alias(position))
    return out.select(*key, *[F.col(f"_best.{c}").alias(c) for c in columns], position)
