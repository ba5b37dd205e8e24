"""Token ids in files: frequency-ranked, byte-aligned codes with separate control bytes.

A file is a run of records, each of some documents:

    magic "TKR1" | documents n | ids m | bytes d | 8-byte id end | n ids counts | n document ids
    | n flags (1: no document id) | ceil(m / 4) control bytes | d data bytes | newline

All integers are little-endian, 32 bits wide, document ids 64. An id is written as its rank
by frequency in the whole corpus, in 1 to 4 bytes; a control byte holds the lengths, less one,
of four codes. Decoding looks up the four lengths of each control byte in a table, turns them
into places and gathers the bytes. The ranks are a table beside the records.

Files are written by Spark's text writer, so that failed or repeated tasks leave no parts.
"""

from __future__ import annotations

import struct
import sys
import zlib
from collections.abc import Iterator
from itertools import chain, islice, repeat
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm.common import arrow_batches, give_memory_back
from tidemark.sources.scratch import written

MAGIC = b"TKR1"
RECORD_IDS = 1 << 18
SHARD_IDS = 1 << 23
# What a worker process remembers from task to task, some 200 bytes each.
CACHE_CHUNKS, CACHE_PARTS = 150_000, 350_000
SLICE_BYTES, BATCH_BYTES = 2 << 20, 8 << 20
COUNTED_BYTES = 1 << 18
# The same where workers are to stay small.
SMALL_CACHES, SMALL_SLICE_BYTES, SMALL_BATCH_BYTES = (40_000, 60_000), 1 << 19, 2 << 20
SMALL_SHARD_IDS = 1 << 21
HEAD = "<4sIIIQ"
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])[None, :] & 3) + 1


# Tokenizing


# Chunks of printable ASCII and Latin-1 letters: lower-casing and splitting them needs no
# Unicode tables, so their parts can be looked up one by one. Arrow matches and splits all
# chunks at once.
_PLAIN = "^[!-~À-ÖØ-öø-ÿ]+$"
_PARTS = "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it
    is printable, else the next letter from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Table:
    """Numbered runs of ids, looked up by name; number 0 is the empty run."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def find(self, names: list[str]) -> np.ndarray:
        return np.fromiter(map(self.number.get, names, repeat(-1)), np.int64, len(names))

    def add(self, names: list[str], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The numbers of these names, none of which was there."""
        first = len(self.starts) - 1
        self.number.update(zip(names, range(first, first + len(names)), strict=True))
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        return np.arange(first, first + len(names))

    def keep(self, n: int) -> None:
        """The first n names to come: frequent ones come early."""
        self.number = dict(islice(self.number.items(), n))
        self.starts = self.starts[: n + 2].copy()
        self.ids = self.ids[: self.starts[-1]].copy()

    def sizes(self, numbers: np.ndarray) -> np.ndarray:
        return self.starts[numbers + 1] - self.starts[numbers]

    def runs(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of all these runs, one after another."""
        return self.ids[ranges(self.starts[numbers], self.sizes(numbers))]


class ChunkEncoder:
    """Ids of texts, by their white-space separated chunks; each distinct chunk is encoded
    once while the memory of them lasts. No token spans white space, so the ids of a text
    are those of its chunks one after another."""

    def __init__(
        self, tokenizer: Tokenizer, by_parts: bool, most: tuple[int, int] = (CACHE_CHUNKS, CACHE_PARTS)
    ) -> None:
        """``most`` chunks and parts are remembered."""
        self.tokenizer, self.by_parts, self.most = tokenizer, by_parts, most
        self.letters = byte_letters()
        self.chunks, self.parts = Table(), Table()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has."""
        for table, most in zip((self.chunks, self.parts), self.most, strict=True):
            if len(table.number) > most:
                table.keep(most // 2)
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        numbers = self.chunks.find(_strings(coded.dictionary))
        if len(new := np.flatnonzero(numbers < 0)):
            numbers[new] = self._learn(coded.dictionary.take(pa.array(new)))
        return self._joined(self.chunks, numbers, coded, lists)

    def _learn(self, chunks: pa.Array) -> np.ndarray:
        """Adds these chunks, each given once; returns their numbers."""
        easy = self._easy(chunks)
        numbers = np.zeros(len(chunks), np.int64)
        if others := _strings(chunks.filter(pa.array(~easy))):
            runs = [self.tokenizer.encode(c, add_special_tokens=False).ids for c in others]
            numbers[~easy] = self._add(self.chunks, others, runs)
        plain = chunks.filter(pa.array(easy))
        if len(plain):
            spaced = pc.replace_substring_regex(pc.utf8_lower(plain), _PARTS, r" \0")
            lists = pc.ascii_split_whitespace(pc.ascii_ltrim_whitespace(spaced))
            coded = lists.flatten().dictionary_encode()
            names = _strings(coded.dictionary)
            found = self.parts.find(names)
            if len(missing := np.flatnonzero(found < 0)):
                some = [names[i] for i in missing.tolist()]
                tokenize = self.tokenizer.model.tokenize
                runs = [[t.id for t in tokenize(self._spelled(p))] for p in some]
                found[missing] = self._add(self.parts, some, runs)
            ids, sizes = self._joined(self.parts, found, coded, lists)
            numbers[easy] = self.chunks.add(_strings(plain), ids, sizes)
        return numbers

    def _easy(self, chunks: pa.Array) -> np.ndarray:
        """Which chunks can be encoded by their parts."""
        if not self.by_parts:
            return np.zeros(len(chunks), bool)
        special = pc.match_substring(chunks, "<|")
        easy = pc.and_not(pc.match_substring_regex(chunks, _PLAIN), special)
        return easy.to_numpy(zero_copy_only=False)

    @staticmethod
    def _joined(
        table: Table, numbers: np.ndarray, coded: pa.DictionaryArray, lists: pa.Array
    ) -> tuple[np.ndarray, np.ndarray]:
        """The runs of all names in the lists, one after another, and each list's number of
        ids; ``numbers`` are those of the distinct names, ``coded`` the names of all lists."""
        each = numbers[coded.indices.to_numpy()]
        total = np.concatenate([[0], np.cumsum(table.sizes(each))])
        n = pc.list_value_length(lists).to_numpy()
        ends = np.cumsum(n)
        return table.runs(each), total[ends] - total[ends - n]

    def _spelled(self, part: str) -> str:
        """A letter for each byte; printable ASCII stands for itself."""
        return part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)

    @staticmethod
    def _add(table: Table, names: list[str], runs: list[list[int]]) -> np.ndarray:
        ids = np.fromiter(chain.from_iterable(runs), np.uint32)
        return table.add(names, ids, np.array([len(r) for r in runs], np.int64))


def _strings(names: pa.Array) -> list[str]:
    return names.to_numpy(zero_copy_only=False).tolist()


def ranges(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - count), count)


def _word_bpe(tokenizer: Tokenizer) -> bool:
    """Whether parts can be encoded one by one: checked on samples of every kind."""
    probe = ChunkEncoder(tokenizer, True)
    samples = ["Hello", "don't", "I'LLl'd", "x-1.25,00!?", "naïve", "ÀÉÿß", "a\"b'c", "''s's"]
    encode = tokenizer.encode
    return all(
        probe.encode(pa.array([s]))[0].tolist() == encode(s, add_special_tokens=False).ids
        for s in samples
    )


def new_encoder(vocabulary: str, **caches) -> ChunkEncoder:
    tokenizer = Tokenizer.from_str(vocabulary)
    return ChunkEncoder(tokenizer, _word_bpe(tokenizer), **caches)


def kept_encoder(vocabulary: str) -> ChunkEncoder:
    """The encoder of this process. What travels by value has no module of its own in a
    worker, so one is made for what is kept there for the tasks that come after."""
    kept = sys.modules.setdefault("_tidemark_kept", ModuleType("_tidemark_kept"))
    of = zlib.crc32(vocabulary.encode())
    if getattr(kept, "vocabulary", None) != of:
        kept.vocabulary, kept.encoder = of, new_encoder(vocabulary)
    return kept.encoder


STAGED = "doc_id long, n_ids long, packed binary"


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int, keep: bool = True) -> DataFrame:
    """doc_id, n_ids and the packed ids of every text, each with its end id. Workers
    keep the encoder between tasks, or, with ``keep`` off, make a smaller one for each."""
    vocabulary = open(tokenizer_path, encoding="utf-8").read()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(vocabulary) if keep else new_encoder(vocabulary, most=SMALL_CACHES)
        for batch in batches:
            for some in _slices(batch, SLICE_BYTES if keep else SMALL_SLICE_BYTES):
                ids, counts = encoder.encode(some.column(1))
                last = np.cumsum(counts)
                packed = [
                    _pack(np.append(ids[high - n : high], np.uint32(end_id)))
                    for high, n in zip(last.tolist(), counts.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array(counts + 1, pa.int64()),
                        pa.array(packed, pa.binary()),
                    ],
                    ["doc_id", "n_ids", "packed"],
                )
            give_memory_back()
        if not keep:
            del encoder
            give_memory_back()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(each, STAGED)


def _slices(batch: pa.RecordBatch, most: int, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``most`` bytes in a column of texts; a longer text by itself."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and held + size > most:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += size
    if first < batch.num_rows:
        yield batch.slice(first)


_ZSTD = "zstd"


def _pack(ids: np.ndarray) -> bytes:
    """Compressed; as 16-bit numbers where they fit. Ahead stand the bytes of a number and how
    many there are."""
    width = 2 if len(ids) == 0 or ids.max() < 1 << 16 else 4
    raw = ids.astype(f"<u{width}").tobytes()
    return struct.pack("<BI", width, len(ids)) + pa.Codec(_ZSTD, 1).compress(raw, asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    width, n = struct.unpack_from("<BI", packed)
    raw = pa.Codec(_ZSTD).decompress(packed[5:], width * n, asbytes=True)
    return np.frombuffer(raw, f"<u{width}")


# Ranks


def id_ranks(staged: DataFrame) -> DataFrame:
    """Every id that occurs, its count and its rank: most frequent first, ties by id. One
    row per id of the vocabulary at most, so that ranking them in one place is bounded."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            # A count is as long as the vocabulary, so it is made of many documents at once.
            for some in _slices(batch, COUNTED_BYTES, 0):
                ids = [_unpack(packed) for packed in some.column(0).to_pylist()]
                more = np.bincount(np.concatenate(ids))
                if len(more) > len(total):
                    total = np.append(total, np.zeros(len(more) - len(total), np.int64))
                total[: len(more)] += more
        seen = total.nonzero()[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"]
        )

    counts = staged.select("packed").mapInArrow(each, "id long, n long")
    return counts.groupBy("id").agg(F.sum("n").alias("n"))


# The code


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = size - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1)
    kept = np.arange(4) < size[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    start = np.cumsum(size) - size
    raw = np.frombuffer(data + bytes(3), np.uint8)
    out = raw[start].astype(np.uint32)
    for k in (1, 2, 3):
        long = np.flatnonzero(size > k)
        out[long] |= raw[start[long] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_record(doc_ids: list[int | None], ids: list[np.ndarray], end: int, rank: np.ndarray) -> bytes:
    flat = rank[np.concatenate(ids)]
    control, data = encode_ranks(flat)
    return b"".join(
        [
            struct.pack(HEAD, MAGIC, len(ids), len(flat), len(data), end),
            np.array([len(x) for x in ids], "<u4").tobytes(),
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            bytes(d is None for d in doc_ids),
            control,
            data,
        ]
    )


def record_heads(content: bytes) -> Iterator[tuple[int, int, int, int]]:
    """Where each record's body starts, and its numbers of documents, ids and data bytes."""
    at = 0
    while at < len(content):
        magic, n, m, d, _ = struct.unpack_from(HEAD, content, at)
        if magic != MAGIC:
            raise ValueError(f"no record at byte {at}")
        at += struct.calcsize(HEAD)
        yield at, n, m, d
        at += 13 * n - (-m // 4) + d + 1


def read_records(content: bytes, id_of: np.ndarray) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids) of every document in a file, in order."""
    for at, n, m, d in record_heads(content):
        counts = np.frombuffer(content, "<u4", n, at).tolist()
        doc_ids = np.frombuffer(content, "<i8", n, at + 4 * n).tolist()
        absent = content[at + 12 * n : at + 13 * n]
        control, data = at + 13 * n, at + 13 * n - (-m // 4)
        ids = id_of[decode_ranks(content[control:data], content[data : data + d], m)]
        low = 0
        for doc_id, gone, count in zip(doc_ids, absent, counts, strict=True):
            yield None if gone else doc_id, ids[low : low + count]
            low += count


# Files


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, stage_path: str, keep: bool = True
) -> None:
    """Writes every text of ``docs`` (doc_id, text) under ``path``: ``ids``, a folder of
    files that hold the documents in ascending doc_id order, null first, files in order
    of their names; and ``ranks``, the table of ids by rank.

    Null and empty texts are the end id alone. Rows that repeat a doc_id stand together,
    in the order of their ids' bytes. Texts are tokenized once, into ``stage_path``, with
    encoders that workers keep where ``keep`` is on: faster, but memory that what runs in the
    same workers before and after goes without. Files are smaller with ``keep`` off, too: who
    reads one holds it whole."""
    with arrow_batches(docs.sparkSession, BATCH_BYTES if keep else SMALL_BATCH_BYTES):
        _write_token_files(docs, path, tokenizer_path, end_id, stage_path, keep)


def _write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, stage_path: str, keep: bool
) -> None:
    spark = docs.sparkSession
    tokenized(docs, tokenizer_path, end_id, keep).write.option("compression", "none").parquet(stage_path)
    staged = spark.read.schema(STAGED).parquet(stage_path)
    # One row per id of the vocabulary.
    counted = sorted(((-r["n"], r["id"]) for r in id_ranks(staged).toLocalIterator()))
    order = [i for _, i in counted]
    ranks = spark.createDataFrame([(k, i) for k, i in enumerate(order)], "rank long, id long")
    ranks.coalesce(1).write.parquet(f"{path}/ranks")
    rank = np.zeros(max(order, default=0) + 1, np.uint32)
    rank[order] = np.arange(len(order))
    shared = spark.sparkContext.broadcast(rank.tobytes())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(shared.value, np.uint32)
        doc_ids, held, size = [], [], 0

        def record() -> pa.RecordBatch:
            made = write_record(doc_ids, held, end_id, rank)
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["record"])

        for batch in batches:
            for doc_id, packed in zip(batch.column(0), batch.column(1), strict=True):
                doc_ids.append(doc_id.as_py())
                held.append(_unpack(packed.as_py()))
                size += len(held[-1])
                if size >= RECORD_IDS:
                    yield record()
                    doc_ids, held, size = [], [], 0
            give_memory_back()
        if held:
            yield record()

    total = staged.agg(F.sum("n_ids")).first()[0] or 0
    shards = max(1, -(-total // (SHARD_IDS if keep else SMALL_SHARD_IDS)))
    records = (
        staged.select("doc_id", "packed")
        .repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), F.xxhash64("packed"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("packed"))
        .mapInArrow(each, "record binary")
    )
    # A cast keeps the bytes; the writer ends each record with a newline.
    records.select(F.col("record").cast("string").alias("value")).write.text(f"{path}/ids")


READ = T.StructType(
    [
        T.StructField("file", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("before", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Number and content of each file; the writer numbers them in order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids")
    number = F.regexp_extract("path", r"part-([0-9]+)[^/]*$", 1).cast("long")
    return files.select(number.alias("file"), "content")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: its file and place there, the ids before it in the
    file, how many ids it has, and their crc32 as 32-bit little-endian numbers."""
    # One row per id of the vocabulary.
    order = [r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").toLocalIterator()]
    shared = spark.sparkContext.broadcast(np.array(order, "<u4").tobytes())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_of = np.frombuffer(shared.value, "<u4")
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, before = [], 0
                for place, (doc_id, ids) in enumerate(read_records(content.as_py(), id_of)):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((file.as_py(), place, doc_id, before, len(ids), crc))
                    before += len(ids)
                columns = list(zip(*rows, strict=True)) or [()] * len(READ)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], READ.names
                )
            give_memory_back()

    return _files(spark, path).mapInArrow(each, READ)


def token_report(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 from the files,
    each read once, before this returns."""
    rows = written(read_token_files(spark, path), "token-rows")
    # One row per file, of some million ids.
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
    return rows.join(starts, "file").select(
        "doc_id", (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
