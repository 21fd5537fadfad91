"""Corpus pipeline over `documents`: quality rules, toxicity, near-duplicate
join, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written to
the shared folder and read again as the next stage's `docs`.  All but the last
return the columns of `documents`.  An empty table passes through every stage;
null texts fail the quality rules like empty ones.  `n_chars` follows the text
where a stage shortens it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import ngram_join, packing, quality, suffix_dedup, toxicity
from tidewater.llm.common import saved

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and resemble their language."""
    return quality.keep_good(docs)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; trained on the given `labels`."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.keep_civil(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.keep_one(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long strings that occur more than once."""
    out = suffix_dedup.remove_repeats(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality", quality_rules),
    ("toxicity", civil),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("packing", packed),
]

ORACLE_SQL = None  # learning, linking and tokenizing are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
