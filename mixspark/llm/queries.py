"""The registered queries of the training-data operators, whole tables each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixspark.llm import bpe, bytenet, linededup, neardup, packing, periodic, quality, shard, suffix, tokencount, topk, toxicity, trie
from mixspark.llm.common import documents
from mixspark.llm.oracles import ORACLES


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_roundtrip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ("n_tokens", "ids_sha256", "decoded_sha256"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.document_shards(documents(spark, sf_dir), 24)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 20, 20)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    machine = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.toxicity(docs, machine).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(documents(spark, sf_dir), "all", columns=("kept_sha256",))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_byte_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scorer = bytenet.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return bytenet.quality_scores(docs, scorer).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_report(periodic.looped(documents(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_minhash,
        op3_hilbert_shards,
        op4_line_dedup,
        op5_token_counts,
        op6_top_k,
        op7_quality,
        op8_packing,
        op9_toxicity,
        op10_suffix_dedup,
        op11_prefix_trie,
        op12_byte_quality,
        op13_periodic_runs,
    )
}

__all__ = ["ORACLES", "QUERIES"]
