"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes that end a word: space and the five controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]++"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def packed(docs: DataFrame, *apart: str) -> DataFrame:
    """Rows as the columns of ``apart`` and one struct, ``row``, of all others, so that no
    column can clash with those an operator makes. ``unpacked`` is the way back."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in apart]
    return docs.select(F.struct(F.lit(0).alias("none"), *others).alias("row"), *apart)


def unpacked(rows: DataFrame, columns: list[str], *apart: str) -> DataFrame:
    row = F.col("row")
    return rows.select(*(F.col(c) if c in apart else row[c].alias(c) for c in columns))


@contextmanager
def arrow_batches(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """Python tasks of jobs run within get smaller batches than the session's."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, most_bytes)
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def in_small_batches(docs: DataFrame, most_bytes: int) -> DataFrame:
    """The same rows in a session of their own, with the settings of theirs but smaller
    batches for Python tasks. What is derived from these rows runs in that session whenever
    its result is asked for, so nothing has to be written while a setting holds."""
    spark = docs.sparkSession
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set(BATCH_SETTING, most_bytes)
    # A union is of its first side's session.
    fields = (F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema)
    return own.range(0).where("false").select(*fields).union(docs)


def give_memory_back() -> None:
    """Hands what freed batches held back to the system: from Arrow's pool, and from the C
    library, which keeps it otherwise. A worker lives on for the tasks that come after."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def n_words(text: Column) -> Column:
    """Words in a text, 0 for none or null. One pass: each word becomes one letter,
    then the white space goes."""
    letters = F.translate(F.regexp_replace(text, WORD, "x"), SPACES, "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("long")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % n


def text_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased. bytes.split() and bytes.lower() know
    exactly the six ASCII spaces and the ASCII letters."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def span_digest(docs: DataFrame, spans: str, kinds: tuple[str, ...]) -> DataFrame:
    """doc_id, a count for each base kind, the hash of the base spans, and all spans."""
    found = F.col(spans)
    return docs.select(
        "doc_id",
        *(F.size(of_kinds(found, (k,))).cast("long").alias(f"n_{k}") for k in kinds),
        F.sha2(joined_spans(of_kinds(found, kinds)).cast("binary"), 256).alias("base_sha256"),
        joined_spans(found).alias("spans"),
    )
