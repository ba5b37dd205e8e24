"""The corpus pipeline: documents in, token ids out.

Each stage takes what the one before kept and is written as Parquet before the next reads it.
Toxic documents go, then all but one of each group of near copies, then documents that share
a passage with a benchmark item; the rest is mixed to target weights and encoded.
"""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, minhash, mixing, queries_files, toxicity
from tidemark.llm.common import in_small_batches, read
from tidemark.sources.scratch import staged

# Of texts that a Python task gets at a time. An executor's buffers for them stay with it, and
# those of all stages add up.
BATCH_BYTES = 2 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below 0.5. Null texts score like empty ones; repeated rows are judged
    each; without labels of both kinds all rows stay, or go, by the share of toxic ones."""
    docs = in_small_batches(docs, BATCH_BYTES)
    return toxicity.without_toxic(docs, read(docs.sparkSession, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more."""
    return minhash.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a window of any item. Null and empty texts, and an empty benchmark, have none."""
    docs = in_small_batches(docs, BATCH_BYTES)
    return decontamination.decontaminate(docs, read(docs.sparkSession, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mixture takes them, none to twice; a null source is one, too, and
    a null text has no words. An empty table gives an empty one."""
    return mixing.mix(docs).shuffled()


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per row of ``docs``, repeats included; a null or empty text is its end id alone.
    Workers have had other stages, so they keep no encoders."""
    return queries_files.encoded(in_small_batches(docs, BATCH_BYTES), keep=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

# Learned scores and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage kept goes once the next one has been written; the
    last one has read all it was given when it returns."""
    docs, given = read(spark, sf_dir, "documents"), ExitStack()
    for name, stage in STAGES[:-1]:
        with given, ExitStack() as kept:
            docs = kept.enter_context(staged(stage(spark, docs, sf_dir), f"pipeline-{name}"))
            given = kept.pop_all()
    with given:
        return STAGES[-1][1](spark, docs, sf_dir)
