"""The corpus pipeline: documents go through the stages in order, each stage works on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from slotweave.llm import near_duplicates, packing, pii, quality_model, toxicity_model
from slotweave.llm.shared import shared_path


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects (score below 0.5)."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_model.fit(docs, labels, metadata=("n_chars",))
    return quality_model.score(docs, model, reject_below=0.5)


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop the documents that the toxicity classifier rejects (score of 0.3 and more)."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity_model.score(docs, toxicity_model.fit(docs, labels), reject_from=0.3)


def keep_one_copy(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep the document with the smallest id of each class of near copies."""
    return near_duplicates.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Put the kind in brackets in the place of personal data; ``n_chars`` follows the new text."""
    return pii.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("toxicity", drop_toxic),
    ("near-duplicates", keep_one_copy),
    ("personal data", redact),
    ("packing", pack),
]
#: Classifiers and the tokenizer are beyond SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet to the shared folder and read again."""
    folder = shared_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
