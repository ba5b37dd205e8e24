"""Removal of documents that share passages with benchmark items.

Documents are read in shards of bounded size. Each shard becomes a suffix array of its
words, and every suffix of the test items is searched in it by bisection. The items are
sent to executors in blocks of about BLOCK_BYTES of text (or one longer item), never more
than one block at a time: each is a pass over the documents. Where there are several, a pass
keeps only which words of which texts were hit, and these are joined by the texts' digests.

Null and empty texts have no words and no hits; null or empty items have no windows.
Items without an id count as the item "". Rows that repeat are each judged. Columns
pass through; one named as the result is replaced.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import give_memory_back, packed, unpacked
from tidemark.llm.suffixes import Shard, TestSuffixes, words
from tidemark.sources.scratch import scratch_path, staged

WIDTH = 10
BLOCK_BYTES = 8 << 20
SHARD_WORDS = 1 << 20
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
HIT = "digest string, marks binary, items array<string>"
N_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MATCH = "item string, item_word long, length long, doc_id {}, doc_word long"


def _block_count(benchmark: DataFrame) -> int:
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // BLOCK_BYTES))


def _blocks(benchmark: DataFrame, width: int, n: int) -> Iterator[TestSuffixes]:
    """The test items' suffixes in ``n`` blocks, one at a time."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text"
    )
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    with staged(dealt, "items", "block") as parts:
        for i in range(n):
            some = parts.where(F.col("block") == i).select("item_id", "text")
            yield TestSuffixes(map(tuple, some.toLocalIterator()), width)


def _shards(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of whole documents, about SHARD_WORDS of them, and the first one's place."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(words(text.as_py()))
        size += len(held[-1])
        if size >= SHARD_WORDS:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def _search(tests: TestSuffixes, texts: pa.Array) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Per document: which of its words are hit, and the items that hit them, sorted as text."""
    for _, documents in _shards(texts):
        shard = Shard([tests.word_ids(d) for d in documents], tests)
        covered, doc, item = shard.hits()
        items: list[set[str]] = [set() for _ in documents]
        for d, i in zip(doc.tolist(), item.tolist(), strict=True):
            items[d].add(tests.names[i])
        for begin, size, names in zip(shard.begins.tolist(), shard.sizes.tolist(), items):
            yield covered[begin : begin + size], sorted(names)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, out: str = "contamination", width: int = WIDTH
) -> DataFrame:
    """Adds n_words, n_hit (words inside a window of some item) and the ids of the items
    with such windows, sorted as text, as a struct. Several blocks of items are searched
    before this returns, one is when the result is asked for."""
    n = _block_count(benchmark)
    source = docs.select(*(f"`{c}`" for c in docs.columns if c != out))
    if n > 1:
        return _with_hits(source, _hits(source, _blocks(benchmark, width, n)), out)
    (tests,) = _blocks(benchmark, width, n)
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(tests))
    at = source.columns.index("text")
    kind = pa.struct(
        [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string()))]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = pickle.loads(shared.value)
        for batch in batches:
            found = [
                {"n_words": len(marks), "n_hit": int(marks.sum()), "items": items}
                for marks, items in _search(tests, batch.column(at))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, kind)], [*batch.schema.names, out]
            )
            give_memory_back()

    return source.mapInArrow(each, T.StructType([*source.schema.fields, T.StructField(out, FOUND)]))


def _digest() -> Column:
    return F.sha2(F.col("text").cast("binary"), 256)


def _hits(docs: DataFrame, blocks: Iterator[TestSuffixes]) -> DataFrame:
    """digest, n_hit, items of every text that some block hits. Hits depend on the text
    alone, so rows that share one share its hits."""
    spark = docs.sparkSession
    path = scratch_path(spark, "hits")
    texts = docs.select(_digest().alias("digest"), "text")
    for number, tests in enumerate(blocks):
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(tests))

        def each(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tests = pickle.loads(shared.value)
            for batch in batches:
                digests = batch.column(0)
                found = enumerate(_search(tests, batch.column(1)))
                rows = [
                    {"digest": digests[i].as_py(), "marks": np.packbits(m).tobytes(), "items": items}
                    for i, (m, items) in found
                    if items
                ]
                kind = pa.list_(pa.string())
                fields = [("digest", pa.string()), ("marks", pa.binary()), ("items", kind)]
                yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

        hit = texts.mapInArrow(each, HIT).withColumn("block", F.lit(number))
        hit.write.mode("append").parquet(path)
        shared.destroy()

    def whole(table: pa.Table) -> pa.Table:
        """One text's hits of all blocks: a word counts once, whichever blocks hit it."""
        marks = [np.frombuffer(m.as_py(), np.uint8) for m in table["marks"]]
        items = sorted({i for some in table["items"].to_pylist() for i in some})
        n_hit = int(np.unpackbits(np.bitwise_or.reduce(marks)).sum())
        return pa.table(
            {
                "digest": table["digest"][:1],
                "n_hit": pa.array([n_hit], pa.int64()),
                "items": pa.array([items], pa.list_(pa.string())),
            }
        )

    found = spark.read.schema(f"{HIT}, block int").parquet(path)
    once = found.groupBy("digest", "block").agg(
        F.first("marks").alias("marks"), F.first("items").alias("items")
    )
    return once.groupBy("digest").applyInArrow(whole, "digest string, n_hit long, items array<string>")


def _with_hits(docs: DataFrame, hits: DataFrame, out: str) -> DataFrame:
    rows = packed(docs, "text").withColumn("digest", _digest()).join(hits, "digest", "left")
    found = F.struct(
        F.coalesce(F.regexp_count("text", F.lit(N_WORDS)), F.lit(0)).cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    ).alias(out)
    row = F.col("row")
    kept = (F.col(c) if c == "text" else row[c].alias(c) for c in docs.columns)
    return rows.select(*kept, found)


def longest_matches(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """For each test suffix that has a match of a whole window: its longest verbatim
    match in the documents and one place of it (ties: smallest doc_id, then word). Runs a
    pass over the documents for each block of items before it returns."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    texts, path = docs.select("doc_id", "text"), scratch_path(docs.sparkSession, "matches")
    for tests in _blocks(benchmark, width, _block_count(benchmark)):
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(tests))

        def each(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            t = pickle.loads(shared.value)
            for batch in batches:
                for first, documents in _shards(batch.column(1)):
                    size, doc, word = Shard([t.word_ids(d) for d in documents], t).longest_matches()
                    some = (size >= t.sizes).nonzero()[0]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([t.names[i] for i in t.owner[some]], pa.string()),
                            pa.array(t.item_words[some], pa.int64()),
                            pa.array(size[some], pa.int64()),
                            batch.column(0).take(pa.array(first + doc[some])),
                            pa.array(word[some], pa.int64()),
                        ],
                        ["item", "item_word", "length", "doc_id", "doc_word"],
                    )

        texts.mapInArrow(each, MATCH.format(kind)).write.mode("append").parquet(path)
        shared.destroy()
    found = spark.read.schema(MATCH.format(kind)).parquet(path)
    best = F.min(F.struct(-F.col("length"), "doc_id", "doc_word")).alias("best")
    return found.groupBy("item", "item_word").agg(best).select(
        "item",
        "item_word",
        (-F.col("best.col1")).alias("length"),
        F.col("best.doc_id").alias("doc_id"),
        F.col("best.doc_word").alias("doc_word"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents without a hit, with the columns they had."""
    found = find_contamination(packed(docs, "text"), benchmark, "found", width)
    return unpacked(found.where("found.n_hit = 0"), docs.columns, "text")


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document with counts and a hash of the items found."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark, "found")
    items = F.col("found.items")
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )

