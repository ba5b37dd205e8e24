"""Queries of the operators that read each text by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, pii, secret_scan
from tidemark.llm.common import read, span_digest


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return span_digest(pii.find_personal_data(docs), "personal_data", pii.BASE)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return decontamination.contamination_report(docs, items)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return span_digest(secret_scan.find_secrets(docs), "secrets", secret_scan.BASE)
