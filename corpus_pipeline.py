"""A training corpus from raw documents: classify, clean by rules, remove near duplicates, mix sources, encode."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm import bagminhash, byte_bpe, line_rules, mixing, nbsvm
from veritab.llm.frames import table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier takes for good; its labels are those of the raw documents."""
    return nbsvm.keep_good(spark, docs, nbsvm.train(docs, table(spark, sf_dir, "labels")))


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the quality rules, without the lines that fail them."""
    return line_rules.clean(docs).withColumn("n_chars", F.length("text").cast("long"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class, the document of the smallest id."""
    return bagminhash.first_of_groups(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as they are trained on, in that order: some not at all, some twice."""
    return mixing.training_order(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes.  Workers that served four stages before keep less."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, max_words=200_000, max_states=120_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("quality_rules", clean_lines),
    ("near_dedup", one_of_each),
    ("mix_sources", mixed),
    ("byte_bpe", encoded),
]

#: SQL can express neither the classifier nor the encoder; tests hold the stages against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each is written, and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
