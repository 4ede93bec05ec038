"""The registered queries of this subpackage: thin wrappers with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ball_kmeans, bpe, exact_dedup, fingerprints, language_id, minhash_dedup, packing, pq_dedup, quality, substring_dedup, toxicity, url_filter, whitening
from ._spark import held_out, table


def tokenizer_path() -> str:
    """The public byte-level BPE vocabulary file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()).withColumnRenamed("id", "doc_id")


def op2_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language_id.predict(docs, language_id.fit(docs, ~held_out()))
    return out.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score", "rejected")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path()).withColumnRenamed("id", "doc_id")


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest").withColumnRenamed("id", "doc_id")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removed_words(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_kmeans.cluster(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors)).withColumnRenamed("id", "vec_id")


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_pq_dedup": op2_pq_dedup,
    "op3_language_id": op3_language_id,
    "op4_bpe": op4_bpe,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_ball_kmeans": op11_ball_kmeans,
    "op12_whitening": op12_whitening,
    "op13_fingerprints": op13_fingerprints,
}
