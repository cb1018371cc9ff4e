"""Registered queries of the subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.llm import (
    ann, hyperminhash, langid, lexical, mixing, negatives, packing, pages, quality, scoring, simhash, substrings, suffixes)
from tunelake.llm.common import read
from tunelake.llm.oracle import ORACLE


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"), entropy_share=0.999, budget_ratio=1.25)
    return mixed.select("doc_id", "source", "mix_tokens", "mix_weight", "mix_epoch", "mix_block",
                        F.col("mix_rank.block").alias("mix_rank_block"),
                        F.col("mix_rank.doc").alias("mix_rank_doc"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op5_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents")).select(
        "doc_id", langid.is_held_out().alias("held_out"), "language.*")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf_dir, "documents")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "repeats.n_words", "repeats.n_removed",
        "repeats.kept_sha256")


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read(spark, sf_dir, "documents")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "repeats.n_bytes", "repeats.n_removed",
        "repeats.n_spans", "repeats.kept_sha256")


def op10_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(read(spark, sf_dir, "pages"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(read(spark, sf_dir, "documents"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.mine(vectors, F.col("id") % 100 == 0)


QUERIES = {
    "op1_neighbours": op1_neighbours, "op2_mixing": op2_mixing, "op3_quality": op3_quality,
    "op4_packing": op4_packing, "op5_scoring": op5_scoring, "op6_simhash": op6_simhash, "op7_langid": op7_langid, "op8_substrings": op8_substrings,
    "op9_suffixes": op9_suffixes, "op10_pages": op10_pages, "op11_lexical": op11_lexical,
    "op12_hyperminhash": op12_hyperminhash,
    "op13_negatives": op13_negatives,
}

__all__ = ["ORACLE", "QUERIES", "tokenizer_path"]
