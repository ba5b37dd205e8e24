"""Queries of the operators that write files and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import archives, token_files
from tidemark.llm.common import read
from tidemark.sources.scratch import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoded(docs: DataFrame, keep: bool = True) -> DataFrame:
    """Per document, from token files written for the purpose; ``keep`` as there."""
    spark = docs.sparkSession
    path, stage = scratch_path(spark, "tokens"), scratch_path(spark, "token-stage")
    token_files.write_token_files(docs, path, tokenizer_path(), END_ID, stage, keep)
    return token_files.token_report(spark, path)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = scratch_path(spark, "archives")
    archives.write_arc(pages, f"{path}/arc", versions=(1, 2))
    archives.convert(spark, f"{path}/arc", f"{path}/warc")
    return archives.read_warc(spark, f"{path}/warc").select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        "refers_to",
    )
