"""Registered queries of the training-data operators, one per operator, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import html, language, media, mixing, near_dups, pieces, pii, quality, tokens, vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(_table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.section_token_counts(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted_languages(_table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.duplicate_groups(_table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.contract(_table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.contract(_table(spark, sf_dir, "documents"))


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(_table(spark, sf_dir, "documents"))


def op10_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vector_groups(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_sentencepiece, op2_html_extraction, op3_token_counts, op4_quality_classifier, op5_language_id, op6_near_duplicates, op7_personal_data, op8_source_mixing, op9_media_columns, op10_embedding_duplicates)}

ORACLE_SQL: dict[str, str] = {"op8_source_mixing": mixing.ORACLE}
