"""Queries of the operators that learn from, or compare, the whole corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    katz,
    merkle,
    minhash,
    mixing,
    neighbours,
    prefix_join,
    spelling,
    toxicity,
)
from tidemark.llm.common import read


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), keep=["doc_id"]).report()


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, k=4, percent=80)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return toxicity.toxicity_report(docs, labels)


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return prefix_join.similar_documents(docs, k=3, percent=90)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(read(spark, sf_dir, "documents"))
