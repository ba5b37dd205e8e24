"""Katz backoff scores of documents, by a bigram model that the corpus itself teaches.

Discounts are Good-Turing's for counts up to CUT, and what they leave goes to unseen words
through backoff weights that make every distribution sum to 1 over the known words and one
unknown word. Where nothing is left in a context (all its counts are large) its total is
raised by one, so that unseen words keep some probability.

The model is a table of words and a table of pairs, both cut into buckets by hash. Documents
are coded in slices of bounded size: a slice keeps its distinct words and, for each token, the
word's number. Everything else goes between slices and buckets in packed rows:

1. Slices ask for their distinct words, with their own counts. A bucket adds all counts up,
   keeps them as the word table, and answers every slice in the order it asked.
2. Slices ask for their distinct pairs, again with their own counts, and with the words'
   totals. A bucket adds up, keeps the pair table, and answers with the pairs' totals and, for
   contexts in which a slice has unseen words, what their backoff weight is made of.
3. Slices look their tokens up in the answers and add the logarithms up by document.

So no token is shuffled by itself; a slice's pairs are pre-aggregated; and the pairs of a
context too frequent for one bucket are spread over several by their second word, its sums
being put together afterwards. Slices are a bucketed table, so answers are joined to them
without moving them.

Null and empty texts are the end token alone. A document without an id counts as id "" for
the split. Rows that repeat count as often as they are there. Without any training document
every probability is 1 and both scores are 0.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import remainder
from tidemark.llm.shingles import mixed, slices, word_hashes
from tidemark.sources.scratch import scratch_path, written

CUT = 5
SLICE_TOKENS = 2_200_000
BUCKET_TOKENS = 2_000_000
# Contexts of more than BUCKET_TOKENS / SPLIT tokens are spread; at most SPLIT a bucket.
SPLIT = 4
MOST_SPREAD = 1_000_000
END, BEGIN = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
CODED = (
    "slice long, doc_ids array<long>, train array<boolean>, sizes array<long>, words binary, "
    "tokens binary"
)
WORDS = "bucket int, slice long, words binary, counts binary, sums array<long>"
PAIRS = (
    "bucket int, slice long, contexts binary, runs binary, seconds binary, counts binary, "
    "kinds binary, weights binary, sums array<long>, spread_ids binary, spread_sums binary"
)
ASKED = (
    "bucket int, slice long, contexts binary, runs binary, spread binary, seconds binary, "
    "totals binary, counts binary"
)


def _pack(values: np.ndarray, kind: str) -> bytes:
    """Deflated, all first bytes, then all second ones: high bytes are mostly zero."""
    values = np.ascontiguousarray(values, kind).ravel()
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zlib.compress(planes.tobytes(), 1)


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _rows(kinds: str, rows: list[dict]) -> pa.RecordBatch:
    """A batch of rows for a schema given as text."""
    names = {
        "long": pa.int64(),
        "int": pa.int32(),
        "binary": pa.binary(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "array<long>": pa.list_(pa.int64()),
        "array<boolean>": pa.list_(pa.bool_()),
    }
    fields = [f.split(" ") for f in kinds.split(", ")]
    schema = pa.schema([(name, names[kind]) for name, kind in fields])
    return pa.RecordBatch.from_pylist(rows, schema)


# Discounts


@dataclass(frozen=True)
class Level:
    """Counts of one order: how many tokens and types, and the discounts of small counts."""

    tokens: int
    types: int
    discounts: tuple[float, ...]

    def discount(self, counts: np.ndarray) -> np.ndarray:
        table = np.array([0.0, *self.discounts, 1.0])
        return table[np.minimum(counts, CUT + 1)]


def good_turing(n: list[int]) -> tuple[float, ...]:
    """Katz's discounts for counts 1 to CUT from n[r - 1], the number of types seen r times,
    r up to CUT + 1. A count for which the formula gives no discount between 0 and 1 has none."""
    if not n[0]:
        return (1.0,) * CUT
    common = (CUT + 1) * n[CUT] / n[0]
    out = []
    for r in range(1, CUT + 1):
        raw = (r + 1) * n[r] / (r * n[r - 1]) if n[r - 1] else 0.0
        d = (raw - common) / (1 - common) if common != 1 else 0.0
        out.append(d if common < 1 and 0 < d < 1 else 1.0)
    return tuple(out)


def level(sums: list[int]) -> Level:
    """From tokens, types and the numbers of types seen 1 to CUT + 1 times."""
    return Level(sums[0], sums[1], good_turing(sums[2:]))


def _count_sums(counts: np.ndarray) -> list[int]:
    """Tokens, types, and types by count, of a table's counts."""
    by = np.bincount(np.minimum(counts, CUT + 2), minlength=CUT + 3)
    return [int(counts.sum()), int((counts > 0).sum()), *by[1 : CUT + 2].tolist()]


class Words:
    """Probabilities of single words by their counts."""

    def __init__(self, words: Level, small: list[int]) -> None:
        self.level = words
        rest = sum(n * r * (1 - d) for r, (n, d) in enumerate(zip(small, words.discounts), 1))
        self.total = words.tokens if rest > 0 else words.tokens + 1
        self.unknown = (rest + self.total - words.tokens) / self.total

    def probability(self, counts: np.ndarray) -> np.ndarray:
        seen = self.level.discount(counts) * counts / self.total
        return np.where(counts > 0, seen, self.unknown)


# Slices


def coded(docs: DataFrame, train: Column) -> DataFrame:
    """Slices of the documents; ``train`` tells which of them teach."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0
        for batch in batches:
            texts = [
                (t.as_py() or "").encode("utf-8", "surrogatepass").lower()
                for t in batch.column(2)
            ]
            ids, trains = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, last in slices(texts):
                held.append((ids[first:last], trains[first:last], *_tokens(texts[first:last])))
                size += len(held[-1][3])
                if size >= SLICE_TOKENS:
                    yield _slice(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield _slice(number, held)

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), train.alias("train"), "text"
    )
    return source.mapInArrow(each, CODED)


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in each text, and the hashes of all, an end after each text's words."""
    doc, word = word_hashes(texts)
    n = np.bincount(doc, minlength=len(texts))
    out = np.full(len(word) + len(texts), END, np.uint64)
    out[np.arange(len(word)) + doc] = word
    return n + 1, out


def _slice(number: int, held: list[tuple]) -> pa.RecordBatch:
    words, tokens = np.unique(np.concatenate([h[3] for h in held]), return_inverse=True)
    return _rows(
        CODED,
        [
            {
                "slice": number,
                "doc_ids": [i for h in held for i in h[0]],
                "train": [t for h in held for t in h[1]],
                "sizes": np.concatenate([h[2] for h in held]),
                "words": words.tobytes(),
                "tokens": _pack(tokens, "<u4"),
            }
        ],
    )


class Slice:
    """A coded slice: word numbers of its tokens, and which stand in training documents."""

    def __init__(self, row: dict) -> None:
        self.number = row["slice"]
        self.words = np.frombuffer(row["words"], np.uint64)
        self.tokens = _unpack(row["tokens"], "<u4").astype(np.int32)
        self.sizes = np.array(row["sizes"], np.int64)
        self.train = np.repeat(np.array(row["train"], bool), self.sizes)

    def own_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=len(self.words))

    def word_order(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Words by bucket, and each one's bucket."""
        bucket = (mixed(self.words) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, bucket[order]

    def totals(self, answers: list[dict], buckets: int) -> np.ndarray:
        """Each word's count in the corpus, from the answers of all buckets."""
        out = np.zeros(len(self.words), np.int64)
        order, _ = self.word_order(buckets)
        answers = sorted(answers, key=lambda a: a["bucket"])
        out[order] = np.concatenate([_unpack(a["counts"], "<i8") for a in answers])
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and second word of the distinct pairs, and each token's pair. The number
        after the last word stands for a document's begin."""
        n = len(self.words) + 1
        pair = np.empty(len(self.tokens), np.int64)
        pair[1:] = self.tokens[:-1]
        pair[np.cumsum(self.sizes) - self.sizes] = n - 1
        pair *= n
        pair += self.tokens
        pair, of = np.unique(pair, return_inverse=True)
        return pair // n, pair % n, of.astype(np.int32)

    def pair_order(
        self, first: np.ndarray, second: np.ndarray, context: np.ndarray, plan: Plan
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs by bucket, each one's bucket, and whether its context is spread. A bucket's
        pairs are by first word."""
        parts = -(-context // plan.most)
        spread = parts > 1
        part = mixed(self.words[second]) % np.maximum(parts, 1).astype(np.uint64)
        start = np.append(self.words, np.uint64(BEGIN))[first]
        bucket = mixed(start + part * np.uint64(END)) % np.uint64(plan.buckets)
        order = np.argsort(bucket, kind="stable")
        return order, bucket[order].astype(np.int64), spread


@dataclass(frozen=True)
class Plan:
    """Number of buckets, and the tokens of a context above which it is spread."""

    buckets: int
    most: int


def _per_row(work: Callable[[dict], Iterator[pa.RecordBatch]]):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from work(batch.slice(i, 1).to_pylist()[0])
            pa.default_memory_pool().release_unused()

    return each


def _cuts(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of each run of one bucket."""
    edge = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    for low, high in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        yield int(bucket[low]), low, high


# Words


def word_table(slices_: DataFrame, plan: Plan) -> DataFrame:
    """Rows of slice -1: a bucket's words and counts. Others: the answers to a slice."""

    def ask(row: dict) -> Iterator[pa.RecordBatch]:
        s = Slice(row)
        counts = s.own_counts()
        order, bucket = s.word_order(plan.buckets)
        for b, low, high in _cuts(bucket):
            some = order[low:high]
            row = {
                "bucket": b,
                "slice": s.number,
                "words": s.words[some].tobytes(),
                "counts": _pack(counts[some], "<i8"),
            }
            yield _rows("bucket int, slice long, words binary, counts binary", [row])

    def answer(table: pa.Table) -> pa.Table:
        asked = table.to_pylist()
        words = [np.frombuffer(a["words"], np.uint64) for a in asked]
        known, of = np.unique(np.concatenate(words), return_inverse=True)
        counts = np.concatenate([_unpack(a["counts"], "<i8") for a in asked])
        total = _sums(of, counts, len(known))
        seen = total > 0
        rows = [
            {
                "bucket": asked[0]["bucket"],
                "slice": -1,
                "words": known[seen].tobytes(),
                "counts": _pack(total[seen], "<i8"),
                "sums": _count_sums(total),
            }
        ]
        for a, low, high in _parts(asked, words):
            counts = _pack(total[of[low:high]], "<i8")
            rows.append({"bucket": a["bucket"], "slice": a["slice"], "counts": counts})
        return pa.Table.from_batches([_rows(WORDS, rows)])

    asked = slices_.mapInArrow(
        _per_row(ask), "bucket int, slice long, words binary, counts binary"
    )
    return asked.groupBy("bucket").applyInArrow(answer, WORDS)


def _sums(of: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    return np.rint(np.bincount(of, counts, n)).astype(np.int64)


def _parts(asked: list[dict], lists: list[np.ndarray]) -> Iterator[tuple[dict, int, int]]:
    low = 0
    for a, some in zip(asked, lists, strict=True):
        yield a, low, low + len(some)
        low += len(some)


def _totals(table: DataFrame) -> list[int]:
    """The sums of all buckets: a few numbers."""
    sums = [F.sum(F.col("sums")[i]) for i in range(CUT + 3)]
    return [int(x or 0) for x in table.where("slice = -1").agg(*sums).first()]


def _answers(table: DataFrame, name: str, *columns: str) -> DataFrame:
    """The answers to each slice as one list, no longer than the number of buckets."""
    listed = F.collect_list(F.struct("bucket", *columns)).alias(name)
    return table.where("slice >= 0").groupBy("slice").agg(listed)


# Pairs


def pair_table(joined: DataFrame, plan: Plan, words: Words, trained: int) -> DataFrame:
    """Rows of slice -1: a bucket's contexts, second words and counts, and its share of the
    sums of spread contexts. Others: the answers to a slice."""

    def ask(row: dict) -> Iterator[pa.RecordBatch]:
        s = Slice(row)
        total = s.totals(row["word_answers"], plan.buckets)
        first, second, of = s.pairs()
        counts = np.bincount(of[s.train], minlength=len(first))
        context = np.append(total, trained)[first]
        order, bucket, spread = s.pair_order(first, second, context, plan)
        hashes = np.append(s.words, np.uint64(BEGIN))
        for b, low, high in _cuts(bucket):
            some = order[low:high]
            edge = np.flatnonzero(np.diff(first[some], prepend=-1))
            row = {
                "bucket": b,
                "slice": s.number,
                "contexts": hashes[first[some][edge]].tobytes(),
                "runs": _pack(np.diff(np.append(edge, len(some))), "<u4"),
                "spread": _pack(spread[some][edge], "u1"),
                "seconds": _short(s.words[second[some]]),
                "totals": _pack(total[second[some]], "<i8"),
                "counts": _pack(counts[some], "<i8"),
            }
            yield _rows(ASKED, [row])

    def answer(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_rows(PAIRS, _bucket_answers(table.to_pylist(), words))])

    asked = joined.mapInArrow(_per_row(ask), ASKED)
    return asked.groupBy("bucket").applyInArrow(answer, PAIRS)


def _short(hashes: np.ndarray) -> bytes:
    """48 bits of each: enough to tell the words after one context apart."""
    return np.ascontiguousarray(hashes, "<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return np.concatenate([raw, np.zeros((len(raw), 2), np.uint8)], axis=1).view("<u8").ravel()


def _bucket_answers(asked: list[dict], words: Words) -> list[dict]:
    runs = [_unpack(a["runs"], "<u4").astype(np.int64) for a in asked]
    heads = [np.frombuffer(a["contexts"], np.uint64) for a in asked]
    seconds = [_long(a["seconds"]) for a in asked]
    context = np.concatenate([np.repeat(h, r) for h, r in zip(heads, runs, strict=True)])
    second = np.concatenate(seconds)
    spread = np.concatenate(
        [np.repeat(_unpack(a["spread"], "u1"), r) for a, r in zip(asked, runs, strict=True)]
    )
    key = mixed(context ^ mixed(second + np.uint64(END)))
    known, where, of = np.unique(key, return_index=True, return_inverse=True)
    counts = np.concatenate([_unpack(a["counts"], "<i8") for a in asked])
    total = _sums(of, counts, len(known))
    word_total = np.concatenate([_unpack(a["totals"], "<i8") for a in asked])[where]

    # What the backoff weight of each context is made of: its tokens, how many words follow
    # it 1 to CUT times, and how probable all that follow are as single words.
    contexts, group = np.unique(context[where], return_inverse=True)
    weight = np.zeros((len(contexts), CUT + 2))
    weight[:, 0] = np.bincount(group, total, len(contexts))
    for r in range(1, CUT + 1):
        weight[:, r] = np.bincount(group, total == r, len(contexts))
    probable = np.where(total > 0, words.probability(word_total), 0.0)
    weight[:, CUT + 1] = np.bincount(group, probable, len(contexts))
    kinds = ((weight[:, 1 : CUT + 1] > 0) << np.arange(CUT)).sum(axis=1)

    seen = np.flatnonzero(total > 0)
    seen = seen[np.lexsort((second[where][seen], group[seen]))]
    split = np.zeros(len(contexts), bool)
    split[group[spread[where] > 0]] = True
    rows = [
        {
            "bucket": asked[0]["bucket"],
            "slice": -1,
            "contexts": contexts.tobytes(),
            "runs": _pack(np.bincount(group[seen], minlength=len(contexts)), "<u4"),
            "seconds": _short(second[where][seen]),
            "counts": _pack(total[seen], "<i8"),
            "sums": _count_sums(total),
            "spread_ids": contexts[split].tobytes(),
            "spread_sums": weight[split].tobytes(),
        }
    ]
    for (a, low, high), h, r in zip(_parts(asked, seconds), heads, runs, strict=True):
        found = total[of[low:high]]
        at = np.searchsorted(contexts, h)
        needs = np.minimum.reduceat(found, np.cumsum(r) - r) == 0
        rows.append(
            {
                "bucket": a["bucket"],
                "slice": a["slice"],
                "counts": _pack(found, "<i8"),
                "kinds": _pack(kinds[at], "u1"),
                "weights": _pack(weight[at[needs]], "<f8"),
            }
        )
    return rows


# Scores


def _score_slice(
    row: dict, plan: Plan, words: Words, pairs: Level, trained: int, spread: dict
) -> Iterator[pa.RecordBatch]:
    s = Slice(row)
    total = s.totals(row["word_answers"], plan.buckets)
    first, second, of = s.pairs()
    context = np.append(total, trained)[first]
    order, bucket, is_spread = s.pair_order(first, second, context, plan)
    answers = sorted(row["pair_answers"], key=lambda a: a["bucket"])
    count = np.zeros(len(first), np.int64)
    count[order] = np.concatenate([_unpack(a["counts"], "<i8") for a in answers])

    # A run is what a bucket has of one context; weights came for runs with unseen pairs.
    new = np.diff(bucket, prepend=-1).astype(bool) | np.diff(first[order], prepend=-1).astype(bool)
    edge = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    kinds = np.concatenate([_unpack(a["kinds"], "u1") for a in answers])
    needs = np.minimum.reduceat(count[order], edge) == 0
    weight = np.zeros((len(edge), CUT + 2))
    weight[needs] = np.concatenate([_unpack(a["weights"], "<f8") for a in answers]).reshape(
        -1, CUT + 2
    )
    hashes = np.append(s.words, np.uint64(BEGIN))[first[order][edge]]
    for i in np.flatnonzero(is_spread[order][edge]):
        weight[i] = spread[int(hashes[i])]
        kinds[i] = sum(1 << r for r in range(CUT) if weight[i, r + 1] > 0)

    lost = 1 - np.array(pairs.discounts)
    # Contexts in which a discount takes something keep their total.
    taking = sum(1 << r for r in range(CUT) if lost[r] > 0)
    base = context[order][edge].astype(float)
    whole = base + ((kinds & taking) == 0)
    left = weight[:, 1 : CUT + 1] @ (lost * np.arange(1, CUT + 1)) + (whole - base)
    with np.errstate(divide="ignore", invalid="ignore"):
        alpha = np.where(base > 0, left / whole / (1 - weight[:, CUT + 1]), 1.0)
        single = np.log10(words.probability(total))
        seen = pairs.discount(count[order]) * count[order] / whole[run]
        known = count[order] > 0
        logs = np.where(
            known,
            np.log10(np.where(known, seen, 1.0)),
            np.log10(np.where(known, 1.0, alpha[run])) + single[second[order]],
        )
    score = np.zeros(len(first))
    score[order] = logs
    plain = np.log10((total + 0.1) / (words.level.tokens + 0.1 * (words.level.types + 1)))
    starts = np.cumsum(s.sizes) - s.sizes
    held = {
        "doc_id": row["doc_ids"],
        "held_out": [not t for t in row["train"]],
        "n_tokens": s.sizes.tolist(),
        "n_known": np.add.reduceat((total > 0)[s.tokens].astype(np.int64), starts).tolist(),
        "base_score": np.add.reduceat(plain[s.tokens], starts).tolist(),
        "score": np.add.reduceat(score[of], starts).tolist(),
    }
    yield pa.RecordBatch.from_pydict(held)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def katz_scores(docs: DataFrame, train: Column | None = None) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): held_out, n_tokens, n_known (tokens
    seen in training), train_tokens, base_score (unigrams with 0.1 added to every count) and
    score (the model's), both logarithms to base 10.

    ``train`` tells which documents teach; if not given, those whose id's crc32 is not
    divisible by 10."""
    spark = docs.sparkSession
    train = remainder(F.col("doc_id"), 10) != 0 if train is None else train
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices_ = _bucketed(coded(docs, train), "slice", parts)
    n = slices_.agg(
        F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)),
        F.sum(F.size(F.filter("train", lambda t: t))),
    ).first()
    tokens, trained = int(n[0] or 0), int(n[1] or 0)
    plan = Plan(max(parts, -(-tokens // BUCKET_TOKENS)), BUCKET_TOKENS // SPLIT)

    word_rows = written(word_table(slices_, plan), "katz-words")
    sums = _totals(word_rows)
    words = Words(level(sums), sums[2:])
    word_answers = _answers(word_rows, "word_answers", "counts")
    with_words = slices_.join(word_answers, "slice")
    pair_rows = written(pair_table(with_words, plan, words, trained), "katz-pairs")
    pairs = level(_totals(pair_rows))
    spread = _spread_contexts(pair_rows)
    pair_answers = _answers(pair_rows, "pair_answers", "counts", "kinds", "weights")

    def score(row: dict) -> Iterator[pa.RecordBatch]:
        return _score_slice(row, plan, words, pairs, trained, shared.value)

    shared = spark.sparkContext.broadcast(spread)
    both = slices_.join(word_answers, "slice").join(pair_answers, "slice")
    scores = both.mapInArrow(_per_row(score), SCORES)
    return scores.withColumn("train_tokens", F.lit(words.level.tokens).cast("long"))


def _spread_contexts(pair_rows: DataFrame) -> dict[int, list[float]]:
    """The sums of the spread contexts, of which there are at most SPLIT a bucket; more than
    MOST_SPREAD call for larger buckets."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sums in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(ids.as_py(), np.int64)
                sums = np.frombuffer(sums.as_py(), np.float64).reshape(-1, CUT + 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), *(pa.array(c) for c in sums.T)],
                    ["context", *(f"s{i}" for i in range(CUT + 2))],
                )

    names = [f"s{i}" for i in range(CUT + 2)]
    parts = pair_rows.where("slice = -1").select("spread_ids", "spread_sums")
    parts = parts.mapInArrow(each, "context long, " + ", ".join(f"{c} double" for c in names))
    whole = parts.groupBy("context").agg(*(F.sum(c) for c in names))
    rows = whole.limit(MOST_SPREAD + 1).collect()
    if len(rows) > MOST_SPREAD:
        raise ValueError("too many frequent contexts; raise BUCKET_TOKENS")
    return {r[0] % (1 << 64): list(r[1:]) for r in rows}


def _bucketed(df: DataFrame, by: str, n: int) -> DataFrame:
    """The rows as a table bucketed by a column: joins on it leave them where they are."""
    spark: SparkSession = df.sparkSession
    name = f"tidemark_{uuid.uuid4().hex}"
    path = scratch_path(spark, "katz-slices")
    df.write.bucketBy(n, by).option("path", path).option("compression", "none").saveAsTable(name)
    return spark.table(name)
