"""What the two classifiers share: a bounded sample of labelled rows, and the calibration of scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.frames import remainder


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, label) of at most per_class rows of either class, and how many rows each class has.

    Only labels of 0 or 1 count whose crc32(doc_id) modulo parts is not held_out.  The sample is that of the smallest
    hashes of doc_id, so reruns agree; its ids, of which there are at most twice per_class, are broadcast, and only the
    sample's texts are shuffled.  Of several rows under one id, however many, the text of the smallest hash is taken.
    """
    usable = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.filter(remainder(F.col("doc_id"), parts) != held_out)
    sizes = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = [usable.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    found = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1]).distinct()), "doc_id")
    one = found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    return one.select("doc_id", F.col("first.text").alias("text"), "label"), sizes


def class_weights(y: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Weights that give the sampled classes the shares that they have among all labelled rows."""
    n = np.bincount(y, minlength=2)
    weight = np.array([sizes.get(c, 0) / max(1, n[c]) for c in (0, 1)])
    return weight[y] * len(y) / max(1e-9, (weight * n).sum())


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights and, last, the intercept of a logistic regression by Newton's method on standardised columns."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    pull = np.full(len(w), ridge)
    pull[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(pull), z.T @ (weight * (p - y)) + pull * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.append(w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum())


def logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
