"""Corpus pipeline: quality classifier, near-dedup, personal data, source mixing, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a DataFrame, which is
written as Parquet and reread as the next stage's docs. All but the last return the columns of documents.

Defined results of every stage: an empty table gives no rows; other columns than those of documents are left out, so none
can clash; equal rows and rows that share an id, or have none, are documents of their own. The classifier and the redaction
treat equal texts alike; the near-dedup keeps one of a group, equal rows included; the mix takes each row as often as its
source's target has room for it; null texts score as empty ones, are nobody's copy and are never taken by the mix, as texts
without words are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratile.llm import mixing, near_dups, pieces, pii, quality
from stratile.llm._store import shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose whole text scores as good (label 1) stay; the model learns from the labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.quality_scores(docs.select(*COLUMNS), quality.fit(docs, labels))
    return scored.filter(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id (null ids last); texts without words stay."""
    return near_dups.deduplicated(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found personal data is replaced by its kind in brackets; n_chars follows the text."""
    clean = pii.redacted(docs.select(*COLUMNS), pii.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: once or twice, or not at all."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, decoded_ok of every row."""
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("minhash near-dedup", minhash_near_dedup),
    ("personal data", personal_data),
    ("source mixing", source_mixing),
    ("sentencepiece", sentencepiece),
]

#: A trained classifier and a tokenizer can't be expressed in SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
