"""The corpus pipeline: stages applied to `documents`, each reading what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netforensics.llm import minhash_join, packing, quality_rules, suffix_dedup, weak_quality
from netforensics.llm.common import shared_folder, tokenizer_path


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality rules or the verdict on its host reject."""
    return quality_rules.keep_good(docs)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the weakly supervised classifier rejects."""
    return weak_quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return minhash_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages out of the texts; n_chars follows."""
    return suffix_dedup.remove_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of the remaining texts."""
    return packing.pack(docs, tokenizer_path(), words_kept=150_000)


STAGES = [
    ("quality_rules", apply_rules),
    ("quality_classifier", classify_quality),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("best_fit_packing", pack_sequences),
]

# Tokenizing and the iterative stages can't be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to the documents of `sf_dir`; every stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
