"""Mixing sources to target weights by a time-varying curriculum (operator 10), with DataFrame operations only.

Every source has a target of words.  Over training time t from 0 to 1 its weight runs from (1 - slope) to (1 + slope)
times its mean, so the words asked of it until t are target * ((1 - slope) * t + slope * t * t).  A document's place in
its source's cumulated words gives, by the inverse of that demand, its position in training; sorting by position
interleaves the sources as the schedules say.

Prefix sums over a source do not pass through one task: documents fall into blocks by the hash of their id and text, the
blocks' sums are cumulated, and running sums are taken within (source, block).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.frames import WORD

#: Digits of the hash that tell the block: 3 hexadecimal ones, 4096 blocks.
BLOCK_DIGITS = 3
#: No document is taken more often.
PASSES = 2


def cycled(values: Sequence[float], rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (rank % len(values) + 1).cast("int"))


def row_hash(key: Column, text: Column) -> Column:
    """By id and text, so that rows of one id, null or not, scatter too."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def source_targets(sizes: DataFrame, weights: Sequence[int], slopes: Sequence[float], share: float) -> DataFrame:
    """source_key, source_size, target and slope of each source of (source_key, source, size).

    The targets share `share` of all words by weight, stop at PASSES times the source's size, and the excess is shared
    again by weight until none is above.  That is one level: a source gets least(its stop, level * weight), and with
    the sources in the order of stop / weight the level follows from running sums.  Single-partition windows here sort
    one row per source.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    by_stop = Window.orderBy(F.col("stop") / F.col("weight"), "source_key")
    whole = Window.partitionBy()
    rank = F.row_number().over(by_source) - 1
    ranked = sizes.groupBy("source_key", "source").agg(F.sum("size").alias("source_size")).select(
        "*", cycled(weights, rank).alias("weight"), cycled(slopes, rank).alias("slope"), (F.col("source_size") * PASSES).alias("stop")
    )
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    after = by_stop.rowsBetween(0, Window.unboundedFollowing)
    levels = ranked.select(
        "*",
        F.row_number().over(by_stop).alias("turn"),
        ((F.sum("source_size").over(whole) * share - F.coalesce(F.sum("stop").over(before), F.lit(0))) / F.sum("weight").over(after)).alias("level"),
    )
    level = F.min(F.when(F.col("level") <= F.col("stop") / F.col("weight"), F.struct("turn", "level"))).over(whole)["level"]
    target = F.least(F.col("stop").cast("double"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return levels.select("source_key", "source_size", "slope", target.alias("target"))


def inverse_demand(words: Column, target: Column, slope: Column) -> Column:
    """The time at which a source's schedule has asked for so many words."""
    u = F.least(F.lit(1.0), words / target)
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * u)
    return F.when(slope == 0, u).otherwise((root - (1 - slope)) / (2 * slope))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    slopes: Sequence[float] = (0.5, -0.5, 0.0),
    share: float = 1.5,
    whole: bool = False,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, passes (the words that each pass takes),
    positions (their places in training, null where a pass takes nothing), and the columns named in keep.

    Sources stand in code-point order, null last and as a source of its own; weights and slopes repeat over them.  A
    null text has no words; a source of no words has target 0.  Within a source documents are taken in the order of
    row_hash, pass after pass, until the target; the document at the target is cut there, or, with whole, taken fully if
    more than half of it lies before the target.  Rows equal in id and text are interchangeable.  An empty table gives no
    rows.
    """
    hashed = row_hash(F.col(key), F.col(text))
    sized = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null")).alias("source_key"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        hashed.alias("hash"),
        F.substring(hashed, 1, BLOCK_DIGITS).alias("block"),
        F.struct(*[F.col(c) for c in keep]).alias("kept") if keep else F.lit(0).alias("kept"),
    )
    blocks = sized.groupBy("source_key", "source", "block").agg(F.sum("size").alias("size"))
    earlier = Window.partitionBy("source_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("source_key", "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("block_start"))
    starts = starts.join(source_targets(blocks, weights, slopes, share), "source_key")
    running = Window.partitionBy("source_key", "block").orderBy("hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.join(starts, ["source_key", "block"]).withColumn("start", F.col("block_start") + F.coalesce(F.sum("size").over(running), F.lit(0)))

    def words(n: int) -> Column:
        left = F.floor("target") - (F.col("source_size") * n + F.col("start"))
        if whole:
            return F.when(left * 2 > F.col("size"), F.col("size")).otherwise(F.lit(0))
        return F.greatest(F.lit(0), F.least(F.col("size"), left))

    def position(n: int) -> Column:
        taken = F.col("passes")[n]
        middle = F.col("source_size") * n + F.col("start") + taken / 2
        return F.when(taken > 0, inverse_demand(middle, F.col("target"), F.col("slope")))

    out = placed.withColumn("passes", F.array(*[words(n) for n in range(PASSES)])).withColumn("positions", F.array(*[position(n) for n in range(PASSES)]))
    taken = sum((F.col("passes")[n] for n in range(1, PASSES)), F.col("passes")[0])
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "passes", "positions", *[F.col("kept")[c].alias(c) for c in keep])


def training_order(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The documents as they are trained on: whole, once for each pass that takes them, range-sorted by position."""
    # names of our own, so that no column of the documents clashes with what mix adds
    own = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(c).alias(name) for c, name in own.items()])
    mixed = mix(renamed, key=own[key], source=own[source], text=own[text], whole=True, keep=renamed.columns, **options)
    passes = mixed.select("*", F.explode(F.filter("positions", lambda p: p.isNotNull())).alias("position"))
    ordered = passes.orderBy("position", row_hash(F.col("doc_id"), F.col(own[text])))
    return ordered.select(*[F.col(name).alias(c) for c, name in own.items()])


#: The query op10 in DuckDB's SQL.
ORACLE = r"""
WITH doc AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || md5(coalesce(text, ''))) AS hash FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM doc GROUP BY source
), ranked AS (
  SELECT *, ([3, 1, 2])[rank % 3 + 1] AS weight, ([0.5, -0.5, 0.0])[rank % 3 + 1]::DOUBLE AS slope, source_size * 2 AS stop, sum(source_size) OVER () AS total FROM src
), levels AS (
  SELECT *, row_number() OVER o AS turn,
    (total::DOUBLE * 1.5 - coalesce(sum(stop) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM ranked WINDOW o AS (ORDER BY stop / weight, source)
), level AS (
  SELECT arg_min(level, turn) AS level FROM levels WHERE level <= stop / weight
), target AS (
  SELECT source, source_size, slope, least(stop::DOUBLE, coalesce((SELECT level FROM level), 'inf'::DOUBLE) * weight) AS target FROM levels
), placed AS (
  SELECT d.*, source_size, slope, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY hash, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM doc d JOIN target t ON d.source IS NOT DISTINCT FROM t.source
), passes AS (
  SELECT *, greatest(0, least(size, floor(target)::BIGINT - start)) AS a, greatest(0, least(size, floor(target)::BIGINT - source_size - start)) AS b FROM placed
), timed AS (
  SELECT *, least(1.0::DOUBLE, (start + a::DOUBLE / 2) / target) AS u FROM passes
)
SELECT doc_id, size, source_size, target, (a + b)::BIGINT AS taken,
  round(CASE WHEN a > 0 THEN CASE WHEN slope = 0 THEN u ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * u) - (1 - slope)) / (2 * slope) END END, 6) AS position
FROM timed
"""
