"""The registered queries of this subpackage and the SQL to check them by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import queries_corpus, queries_files, queries_text, sql

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    return {
        "op1_mixing": queries_corpus.op1_mixing,
        "op2_token_files": queries_files.op2_token_files,
        "op3_neighbours": queries_corpus.op3_neighbours,
        "op4_language_model": queries_corpus.op4_language_model,
        "op5_personal_data": queries_text.op5_personal_data,
        "op6_near_duplicates": queries_corpus.op6_near_duplicates,
        "op7_decontamination": queries_text.op7_decontamination,
        "op8_toxicity": queries_corpus.op8_toxicity,
        "op9_archives": queries_files.op9_archives,
        "op10_secrets": queries_text.op10_secrets,
        "op11_similar_documents": queries_corpus.op11_similar_documents,
        "op12_spelling": queries_corpus.op12_spelling,
        "op13_manifest": queries_corpus.op13_manifest,
    }


def all_sql() -> dict[str, str]:
    return sql.all_sql()
