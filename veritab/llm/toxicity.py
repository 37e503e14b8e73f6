"""Toxicity by class-conditional Kneser-Ney models (operator 7).

Both classes model the characters of each word given up to ORDER - 1 characters before them, with marks at the word's
start and end.  Only the highest order is counted by class; what it discounts goes to lower orders that the classes
share, whose counts are Kneser-Ney continuations over both.  So a rare expression gets the same backoff from both
models, and only what a class says more often than the other tells them apart.  A document is judged by the
length-normalised difference of its two log-likelihoods: over all of it, over its most suspect passage, and over its
most suspect words; a logistic calibration on labelled rows turns these three into a score.  Lengths are counted in
units: a word, or, of a longer one, each run of UNIT characters, whose contexts reach back over the seam; so glued
words and scripts without spaces are judged whole.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain
from math import log
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm.frames import held, in_batches, remainder, texts_of
from veritab.llm.learning import class_weights, fit_logistic, labelled_sample, logistic

ORDER = 8
START, END = "\x02", "\x03"
#: Characters of a unit: longer words are several.
UNIT = 32
#: Distinct grams that a counting task holds before it passes them on.
COUNTED = 500_000
#: Units in a passage.
PASSAGE = 8
TOP = 3
#: By count: 0, 1, 2, more.
DISCOUNTS = (0.0, 1.0, 1.25, 1.5)


def grams(word: str) -> Iterator[str]:
    """The word's characters with their contexts: the last character of each string, after what precedes it."""
    marked = START + word + END
    return (marked[max(0, i + 1 - ORDER) : i + 1] for i in range(1, len(marked)))


def word_of(raw: bytes) -> str:
    return raw.decode("utf-8", "replace").lower().strip(".,;:!?\"'()[]") or raw.decode("utf-8", "replace")


def freed(counts: np.ndarray) -> np.ndarray:
    """What a class's counts give up to the backoff."""
    return np.array(DISCOUNTS)[np.minimum(counts, 3)]


def _sums(keys: pa.Array, **columns: np.ndarray) -> tuple[pa.Array, dict[str, np.ndarray]]:
    """The columns' sums by key."""
    table = pa.table({"key": keys, **columns}).group_by("key").aggregate([(c, "sum") for c in columns])
    return table["key"].combine_chunks(), {c: table[f"{c}_sum"].to_numpy() for c in columns}


def _places(keys: pa.Array, among: pa.Array) -> np.ndarray:
    """Where each key stands among distinct ones."""
    return pc.index_in(keys, value_set=among).to_numpy(zero_copy_only=False).astype(np.int64)


def shared_backoff(top: pa.Array, discount: float = 0.75) -> tuple[pa.Array, np.ndarray]:
    """The grams below the highest order, and the shared probability of each one's last character after the rest.

    A gram's count is the number of distinct longer grams that end in it, order by order.
    """
    level, found, counts = pc.unique(top), [], []
    while len(level := level.filter(pc.greater(pc.utf8_length(level), 1))):
        level, n = _sums(pc.utf8_slice_codeunits(level, 1), n=np.ones(len(level), np.int64))
        found.append(level)
        counts.append(n["n"])
    if not found:
        return pa.array([], pa.string()), np.zeros(0)
    grams, n = _sums(pa.concat_arrays(found), n=np.concatenate(counts))
    count = n["n"].astype(float)
    context, stats = _sums(pc.utf8_slice_codeunits(grams, 0, -1), total=count, kinds=np.ones(len(grams), np.int64))
    at = _places(pc.utf8_slice_codeunits(grams, 0, -1), context)
    total, kinds = stats["total"][at], stats["kinds"][at]
    alphabet = max(2, int((pc.utf8_length(grams).to_numpy(zero_copy_only=False) == 1).sum()) + 1)
    probability = np.maximum(count - discount, 0) / total
    share = discount * kinds / total
    length = pc.utf8_length(grams).to_numpy(zero_copy_only=False)
    for k in range(1, ORDER):
        here = np.flatnonzero(length == k)
        if k == 1:
            below = 1.0 / alphabet
        else:
            below = probability[_places(pc.utf8_slice_codeunits(grams.take(pa.array(here)), 1), grams)]
        probability[here] += share[here] * below
    return grams, probability


Tables = tuple[list[str], np.ndarray, list[str], np.ndarray]


def ratio_tables(grams: pa.Array, ordinary: np.ndarray, toxic: np.ndarray) -> Tables:
    """log P(character | toxic) - log P(character | ordinary): of grams, and of contexts for any other character.

    In a class, a count loses the first of DISCOUNTS after 0 if it is 1, the next if 2, the last if more.  What both
    classes say at most once is left to the backoff, like what they never say: those grams need no entry, and contexts
    in which both classes give up the same share need none either.
    """
    if not len(grams):
        return [], np.zeros(0), [], np.zeros(0)
    contexts = pc.utf8_slice_codeunits(grams, 0, -1)
    context, stats = _sums(contexts, o=ordinary, t=toxic, fo=freed(ordinary), ft=freed(toxic))
    with np.errstate(divide="ignore", invalid="ignore"):
        so, st = (np.where(stats[n] > 0, stats[f] / stats[n], 1.0) for n, f in (("o", "fo"), ("t", "ft")))
    differs = np.flatnonzero(so != st)
    lower, probability = shared_backoff(grams)
    own = np.flatnonzero(np.maximum(ordinary, toxic) > 1)
    kept = grams.take(pa.array(own))
    below = probability[_places(pc.utf8_slice_codeunits(kept, 1), lower)]
    at = _places(contexts.take(pa.array(own)), context)

    def p(count: np.ndarray, total: np.ndarray, share: np.ndarray) -> np.ndarray:
        return np.where(total[at] > 0, (count - freed(count)) / np.maximum(total[at], 1) + share[at] * below, below)

    ratio = np.log(p(toxic[own], stats["t"], st)) - np.log(p(ordinary[own], stats["o"], so))
    return kept.to_pylist(), ratio, context.take(pa.array(differs)).to_pylist(), np.log(st[differs]) - np.log(so[differs])


class WordDifferences(dict):
    """log P(word | toxic) - log P(word | ordinary) of words as they stand in texts, worked out when first met."""

    def __init__(self, tables: Tables, max_words: int = 300_000):
        grams, ratios, contexts, others = tables
        self.own = dict(zip(grams, ratios.tolist(), strict=True))
        self.others = dict(zip(contexts, others.tolist(), strict=True))
        self.max_words = max_words

    def difference(self, word: str) -> list[float]:
        """The differences of the word's units."""
        out = [0.0] * max(1, -(-len(word) // UNIT))
        for i, gram in enumerate(grams(word)):
            known = self.own.get(gram)
            # the mark at the end belongs to the last unit
            out[min(i // UNIT, len(out) - 1)] += self.others.get(gram[:-1], 0.0) if known is None else known
        return out

    def __missing__(self, raw: bytes) -> list[float]:
        value = self.difference(word_of(raw))
        # a word of a megabyte is not worth keeping
        if len(raw) <= 256:
            if len(self) >= self.max_words:
                self.clear()
            self[raw] = value
        return value


def evidence(text: bytes, differences: WordDifferences) -> tuple[float, float, float, float]:
    """Mean difference of a text's units, of its most suspect passage, and of its most suspect units; and the
    logarithm of its length, as the largest of more units is larger by chance."""
    words = text.split()
    if not words:
        return 0.0, 0.0, 0.0, 0.0
    d = np.fromiter(chain.from_iterable(map(differences.__getitem__, words)), np.float64)
    size = min(PASSAGE, len(d))
    sums = np.cumsum(np.concatenate([[0.0], d]))
    passage = (sums[size:] - sums[:-size]).max() / size
    top = np.partition(d, -TOP)[-TOP:] if len(d) > TOP else d
    return d.mean(), passage, top.mean(), log(len(d))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 4, held_out: int = 2, per_class: int = 4000) -> tuple[Tables, np.ndarray]:
    """The tables of both models and the calibration, from at most per_class rows of either class.

    Four fifths of the sample are counted; the others, whose words the counts have not seen, calibrate.
    """
    sample, sizes = labelled_sample(docs, labels, label, parts, held_out, per_class)
    sample = sample.withColumn("calibrates", F.crc32(F.concat(F.lit("c"), F.col("doc_id").cast("string"))) % 5 == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = (Counter(), Counter())
        for batch in batches:
            for t, c in zip(texts_of(batch.column("text")), batch.column("label").to_pylist(), strict=True):
                words[c].update(t.split())
        found: dict[str, list[int]] = defaultdict(lambda: [0, 0])

        def out() -> pa.RecordBatch:
            pairs = list(found.values())
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *[pa.array([p[c] for p in pairs], pa.int64()) for c in (0, 1)]], ["gram", "ordinary", "toxic"])

        for c in (0, 1):
            for raw, n in words[c].items():
                for gram in grams(word_of(raw)):
                    found[gram][c] += n
                    if len(found) >= COUNTED:
                        yield out()
                        found.clear()
        if found:
            yield out()

    counted = in_batches(sample.filter(~F.col("calibrates")), count, "gram string, ordinary long, toxic long")
    table = counted.groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")).toArrow().combine_chunks()
    tables = ratio_tables(table["gram"].combine_chunks(), table["ordinary"].to_numpy(), table["toxic"].to_numpy())
    del table
    shared = broadcast_tables(docs.sparkSession, tables)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differences = worker_differences(shared)
        for batch in batches:
            found = [evidence(t, differences) for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), *[pa.array([x[i] for x in found], pa.float64()) for i in range(4)]],
                ["doc_id", "label", "mean", "passage", "top", "length"],
            )

    seen = in_batches(sample.filter("calibrates"), measure, "doc_id long, label int, mean double, passage double, top double, length double").orderBy("doc_id", "label", "mean").toPandas()
    x, y = seen[["mean", "passage", "top", "length"]].to_numpy(float), seen["label"].to_numpy(int)
    if len(set(y.tolist())) < 2:
        share = sizes.get(1, 0) / max(1, sum(sizes.values()))
        return tables, np.array([0.0, 0.0, 0.0, 0.0, log((share + 1e-3) / (1 - share + 1e-3))])
    return tables, fit_logistic(x, y, class_weights(y, sizes), ridge=0.05)


def broadcast_tables(spark: SparkSession, tables: Tables) -> Broadcast:
    """The tables under a name of their own, by which workers keep them."""
    return spark.sparkContext.broadcast((uuid4().hex, tables))


def worker_differences(shared: Broadcast) -> WordDifferences:
    """One cache of words per Python worker."""
    name, tables = shared.value
    return held(f"differences {name}", lambda: WordDifferences(tables))


def score_toxicity(spark: SparkSession, docs: DataFrame, tables: Tables, calibration: np.ndarray, parts: int = 4, held_out: int = 2, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= threshold) of every row.

    Null and empty texts have no evidence either way and get the calibration's intercept.  Rows with null ids are scored
    and never held out; repeated rows are scored each; other columns take no part; an empty table gives no rows.
    """
    shared = broadcast_tables(spark, tables)
    columns = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id"), parts) == held_out).alias("held_out"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differences = worker_differences(shared)
        for batch in batches:
            found = np.array([evidence(t, differences) for t in texts_of(batch.column("text"))]).reshape(-1, 4)
            score = logistic(found, calibration)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return in_batches(columns, work, "doc_id long, held_out boolean, score double, predicted int")
