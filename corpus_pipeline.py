"""The corpus pipeline: five stages, each one operator over all rows that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read again as the next one's docs. In every stage a null text
counts as empty, an empty table gives an empty table, texts of any length are
taken whole, and columns beyond those of ``documents`` are dropped; what rows
that repeat an id or have none come to is said at each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import exact_dedup, minhash_dedup, packing, substring_dedup, toxicity
from waymark.llm._spark import removed, shared_folder, ship, table
from waymark.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go, with all rows of their ids; rows without an id stay."""
    ship(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, with the largest doc_id; of those that repeat it the one whose other columns come first. A null id is less than any."""
    return exact_dedup.exact_dedup(docs, keep="largest").select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest doc_id stays; rows that repeat an id are judged each by its own text, those without one stay."""
    ship(spark)
    return minhash_dedup.near_dedup(docs).select(*COLUMNS)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages are cut out of all but their first place; no row goes. Rows that repeat an id, or have none, are one document."""
    ship(spark)
    kept = substring_dedup.remaining_texts(docs, carry=["doc_id", "lang", "source"])
    return kept.select("carried.doc_id", F.col("kept_text").alias("text"), "carried.lang", "carried.source", F.length("kept_text").cast("long").alias("n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a sequence of 1024 tokens; every row is packed by itself, its id repeated or null as it is."""
    ship(spark)
    return packing.pack(docs, tokenizer_path()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("minhash_dedup", near_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

#: The toxicity model and the tokenizer are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two of them is written to the shared folder until it has been read."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/waymark-pipeline-{uuid.uuid4().hex}"
    before = None
    for i, (name, stage) in enumerate(STAGES[:-1]):
        at = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
        if before:
            removed(spark, before)
        before = at
    out = STAGES[-1][1](spark, docs, sf_dir)  # its pieces come from checkpoints, not from what was read
    removed(spark, folder)
    return out
