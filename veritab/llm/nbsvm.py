"""Quality classifier: naive Bayes support vectors (operator 2).

Features are n-gram indicators: words and pairs of words, and runs of up to three word shapes (case, marks at the end,
length, whether the word repeats the one before).  Each indicator is scaled by the log ratio of its counts in the two
classes, and a linear hinge-loss model is fitted on the scaled, length-normalised indicators by dual coordinate
descent.  Margins become scores by logistic calibration on rows left out of that fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm.frames import held, in_batches, remainder, texts_of
from veritab.llm.learning import class_weights, fit_logistic, labelled_sample, logistic

#: Indicators are hashed into this many.
BITS = 20
SHAPES = 256


def shape_of(word: bytes) -> int:
    """0 to 127: case, what the word ends in, and a class of length."""
    letters = word.decode("utf-8", "replace")
    case = 0 if letters.islower() else 1 if letters.istitle() else 2 if letters.isupper() else 3
    end = letters[-1]
    if end.isalnum():
        marks = 0
    else:
        run = len(letters) - len(letters.rstrip(end))
        marks = min(run, 3) if end in ".,;:!?" else 3 + min(run, 4)
    return case * 32 + marks * 4 + (0 if len(letters) < 2 else 1 if len(letters) < 6 else 2 if len(letters) < 14 else 3)


class Words(dict):
    """Of each word, its hash in the low 32 bits and its shape above."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = code = shape_of(word) << 32 | crc32(word)
        return code


def indicators(text: bytes) -> np.ndarray:
    """The distinct features of a whole text; of an empty one, none."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int32)
    codes = np.fromiter(map(held("word shapes", Words).__getitem__, words), np.int64, len(words))
    word = (codes & 0xFFFFFFFF).astype(np.uint64)
    shape = (codes >> 32).astype(np.uint64)
    shape[1:] += np.uint64(128) * (word[1:] == word[:-1])
    spread = np.uint64(0x9E3779B97F4A7C15)
    found = [word * spread]
    if len(words) > 1:
        found.append((word[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + word[1:]) * spread)
    runs = shape
    for n in range(3):
        if n:
            if len(runs) < 2:
                break
            runs = runs[:-1] * np.uint64(SHAPES) + shape[n:]
        found.append((runs + np.uint64((n + 1) << 40)) * np.uint64(0xD6E8FEB86659FD93))
    return np.unique((np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int32))


@dataclass
class Model:
    """weight: of each indicator, times its log-count ratio; square: that ratio squared."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    calibration: np.ndarray

    def margin(self, features: np.ndarray) -> float:
        norm = float(self.square[features].sum()) ** 0.5
        return (float(self.weight[features].sum()) / norm if norm > 0 else 0.0) + self.bias

    def score(self, margins: np.ndarray) -> np.ndarray:
        return logistic(margins[:, None], self.calibration)


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Minimise |w|^2 / 2 + sum of cost * hinge by one dual variable at a time, each between 0 and its cost."""
    rng = np.random.default_rng(seed)
    w, bias, dual = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    values = []
    for f in rows:
        v = scale[f]
        norm = float(np.sqrt((v * v).sum()))
        values.append(v / norm if norm > 0 else v)
    diagonal = np.array([float((v * v).sum()) + 1.0 for v in values])
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            f, v = rows[i], values[i]
            gradient = y[i] * (float(w[f] @ v) + bias) - 1.0
            new = min(max(dual[i] - gradient / diagonal[i], 0.0), cost[i])
            change = (new - dual[i]) * y[i]
            if change:
                w[f] += change * v
                bias += change
                largest = max(largest, abs(new - dual[i]))
                dual[i] = new
        if largest < 1e-3:
            break
    return w, bias


def fit(rows: list[np.ndarray], y: np.ndarray, sizes: dict[int, int], cost: float = 4.0, epochs: int = 20, seed: int = 7) -> Model:
    """y: 0 or 1.  Every fifth row is left out of the descent for calibration.  With one class only, or no rows, every
    score is that class's, or a half."""
    width = 1 << BITS
    if len(set(y.tolist())) < 2:
        sure = 0.0 if not len(y) else 4.0 if y[0] else -4.0
        return Model(np.zeros(width, np.float32), np.zeros(width, np.float32), 0.0, np.array([0.0, sure]))
    weight = class_weights(y, sizes)
    out = np.arange(len(y)) % 5 == 4
    if len(set(y[out].tolist())) < 2 or len(set(y[~out].tolist())) < 2:
        out[:] = False
    counts = np.ones((2, width))
    for f, c, use in zip(rows, y, ~out, strict=True):
        if use:
            counts[c, f] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratio[counts.sum(0) == 2] = 0.0
    use = np.flatnonzero(~out)
    w, bias = dual_coordinate_descent([rows[i] for i in use], ratio, np.where(y[use] == 1, 1.0, -1.0), cost * weight[use], epochs, seed)
    model = Model((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), bias, np.zeros(2))
    held = np.flatnonzero(out) if out.any() else use
    margins = np.array([model.margin(rows[i]) for i in held])
    model.calibration = fit_logistic(margins[:, None], y[held], weight[held], ridge=0.05)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 3, held_out: int = 1, per_class: int = 4000) -> Model:
    """A model from at most per_class rows of either class."""
    sample, sizes = labelled_sample(docs, labels, label, parts, held_out, per_class)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [indicators(t) for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "label", "features"]
            )

    got = in_batches(sample, work, "doc_id long, label int, features array<int>").toArrow().combine_chunks()
    ids, y = got["doc_id"].to_numpy(), got["label"].to_numpy()
    order = np.lexsort([y, ids, np.array([crc32(str(i).encode()) for i in ids], np.int64)]) if len(ids) else np.zeros(0, int)
    rows = [got["features"][int(i)].values.to_numpy() for i in order]
    return fit(rows, y[order].astype(int), sizes)


def worker_scores(shared, texts: list[bytes]) -> np.ndarray:
    model = Model(*shared.value)
    margins = np.array([model.margin(indicators(t)) for t in texts])
    return model.score(margins) if len(margins) else np.zeros(0)


def score_quality(spark: SparkSession, docs: DataFrame, model: Model, parts: int = 3, held_out: int = 1, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= threshold) of every row.

    A null text is an empty one, which has no indicators and gets the score of the bias alone.  Rows with null ids are
    scored and never held out; repeated rows are scored each.
    """
    shared = spark.sparkContext.broadcast((model.weight, model.square, model.bias, model.calibration))
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id"), parts) == held_out).alias("held_out"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = worker_scores(shared, texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return in_batches(columns, work, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""
    shared = spark.sparkContext.broadcast((model.weight, model.square, model.bias, model.calibration))
    place = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(worker_scores(shared, texts_of(batch.column(place))) >= threshold))

    return in_batches(docs, work, docs.schema)
