"""The queries of this subpackage and the SQL to hold them against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm import bagminhash, byte_bpe, divergence, gated_lm, hnsw, line_rules, mixing, nbsvm, secret_scan, sharding, spelling, token_count, toxicity
from veritab.llm.frames import table


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability by a unigram base and by the recurrent model."""
    return gated_lm.score_documents(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return nbsvm.score_quality(spark, docs, nbsvm.train(docs, table(spark, sf_dir, "labels")))


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 of near equal sizes, equal texts together."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the word-piece vocabulary."""
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's figures and verdict by line-first cleaning."""
    return line_rules.judge_documents(table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate class by weighted Jaccard similarity of five-word windows."""
    return bagminhash.near_groups(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(spark, docs, *toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth one."""
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded by the byte-level vocabulary."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words in the mix, in the order of its first position in training."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    first = F.round(F.array_min("positions"), 6).alias("position")
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), first).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets; a source is an owner, and a repository is what a source holds in one language."""
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"), F.col("source"), F.struct("source", "lang"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source is from the others of its language, and by which terms."""
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the form and the root that it is a variant of."""
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over the documents table."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_shard": op3_shard,
    "op4_token_count": op4_token_count,
    "op5_quality_rules": op5_quality_rules,
    "op6_near_dedup": op6_near_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_ann_search": op8_ann_search,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_mix_sources": op10_mix_sources,
    "op11_secret_scan": op11_secret_scan,
    "op12_source_divergence": op12_source_divergence,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op5_quality_rules": line_rules.ORACLE,
    "op10_mix_sources": mixing.ORACLE,
    "op11_secret_scan": secret_scan.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
    "op13_spelling_variants": spelling.ORACLE,
}
