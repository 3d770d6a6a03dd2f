"""A corpus pipeline over the documents table: drop bad and toxic texts, thin copies and passages, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chartloom.llm import linear, packing, quality, simhash, suffix, toxicity
from chartloom.llm.queries import vocabulary
from chartloom.session import scratch_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier, learned from the stage's labelled documents, rejects."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return linear.keep(docs, quality.scorer(spark, model), lambda score: score >= quality.THRESHOLD)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the toxicity classifier, learned from the stage's labelled documents, rejects."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return linear.keep(docs, toxicity.scorer(spark, model), lambda score: score < toxicity.THRESHOLD)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least doc_id of each near-duplicate group."""
    return simhash.keep_first(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take passages out that an earlier document has; n_chars follows the text that is left."""
    return suffix.thin(docs, stored=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2,048 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_filter),
    ("toxicity", toxicity_filter),
    ("simhash", simhash_dedup),
    ("passages", passage_dedup),
    ("packing", pack),
]

# Trained models, links and suffix sorting have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
