"""Spelling variants: words one edit apart, found by scanning sorted lists.

1. Words and their counts come from whole texts, added up in tasks before they are shuffled.
2. Two words of lengths m and m or m + 1 that are one edit apart share their first half or
   their last half. So every word goes to one block for each half, with the words that share it;
   a block of more than ``MOST`` words is cut again, by halves of what is left between the ends
   that its words share, until it is small or one letter is left, which bounds it.
3. A block's words, without the shared ends, are a sorted list. For each word the list is
   scanned once: the rows of the edit matrix, three cells wide, are kept for the letters shared
   with the word before, and a run of words whose shared letters are already more than one edit
   away is skipped whole.
4. Each pair is found in one block: where it shares both halves, in that of the first.

A word's form is the most frequent of its near words (ties: the smallest in code point order),
if that is ``ratio`` times as frequent or more; its root is where forms lead to. Forms have ever
larger counts, so they end.

Null and empty texts have no words; repeated rows count each time, and a null doc_id is the empty
text to the rule that plants misspellings. A text of any length is one string. An empty table
gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import give_memory_back
from tidemark.sources.scratch import written

LEAST_LETTERS, LEAST_COUNT, RATIO = 5, 3, 2
# Of the runs of a document, by checksum, one in so many has a letter deleted.
PLANTED = 97
# Words of a block, and words counted in a task before they are given on.
MOST, COUNTED = 20_000, 200_000
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LETTERS)
BLOCK = ["m", "first", "last", "limit", "head", "tail"]
NEAR = "word string, n_near long, near_n long, near string"


def planted(doc_id: int | None, run: str) -> str:
    """The run, or by its checksum the run without one of its letters."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % PLANTED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of LEAST_LETTERS letters or more; only A-Z are lower-cased."""

    def rows(counts: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                lowered = (text.as_py() or "").encode().lower().decode()
                for run, n in Counter(_RUN.findall(lowered)).items():
                    word = planted(doc_id, run)
                    if len(word) >= LEAST_LETTERS:
                        counts[word] += n
                if len(counts) >= COUNTED:
                    yield rows(counts)
                    counts.clear()
            give_memory_back()
        yield rows(counts)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(each, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _entries(words: DataFrame) -> DataFrame:
    """Each word in its blocks: those of pairs whose shorter word has m letters."""
    size = F.length("word")
    m = F.explode(F.array(size - 1, size)).alias("m")
    rows = words.select("word", "n", m).where(F.col("m") >= LEAST_LETTERS)
    return _cut(rows.withColumns({"first": F.lit(0), "last": F.lit(0), "limit": F.col("m") + 1}))


def _cut(rows: DataFrame) -> DataFrame:
    """Rows of blocks that share ``first`` letters and ``last`` ones, each in two blocks that
    share half of the letters between, too. Pairs that may stand in both are left to the one of
    the first half: the other has pairs that differ within the first ``limit`` letters."""
    m, first, last = F.col("m"), F.col("first"), F.col("last")
    half = F.ceil((m - first - last) / 2).cast("int")
    sides = F.array(
        F.struct((first + half).alias("first"), last.alias("last"), F.col("limit").alias("limit")),
        F.struct(first.alias("first"), (m - first - half).alias("last"), (first + half).alias("limit")),
    )
    cut = rows.select("word", "n", "m", F.explode(sides).alias("side")).select("word", "n", "m", "side.*")
    return cut.withColumns(
        {
            "head": F.substring("word", F.lit(1), F.col("first")),
            "tail": F.substring("word", F.length("word") - F.col("last") + 1, F.col("last")),
        }
    )


def _blocks(words: DataFrame, most: int) -> DataFrame:
    """Entries of blocks of two words or more, none with more than ``most`` words unless a
    single letter is left between what they share."""
    done, left = None, _entries(words)
    while True:
        left = written(left, "spelling-entries")
        sizes = left.groupBy(*BLOCK).agg(F.count("*").alias("size")).where("size > 1")
        large = (F.col("size") > most) & (F.col("m") - F.col("first") - F.col("last") > 1)
        sized = written(sizes.withColumn("large", large), "spelling-sizes")
        held = left.join(sized.select(*BLOCK, "large"), BLOCK)
        small = held.where("not large").drop("large")
        done = small if done is None else done.unionByName(small)
        if sized.where("large").isEmpty():
            return done
        left = _cut(held.where("large").drop("large", "head", "tail"))


class SortedList:
    """Words in order, with the letters each shares with the one before, and for each the next
    that shares fewer."""

    def __init__(self, words: list[str]):
        self.words = words
        self.shared = [0] * (len(words) + 1)
        for i in range(1, len(words)):
            a, b, n = words[i - 1], words[i], 0
            for x, y in zip(a, b, strict=False):
                if x != y:
                    break
                n += 1
            self.shared[i] = n
        self.shared[len(words)] = -1
        self.fewer = [0] * (len(words) + 1)
        stack: list[int] = []
        for i, n in enumerate(self.shared):
            while stack and self.shared[stack[-1]] > n:
                self.fewer[stack.pop()] = i
            stack.append(i)
        for i in stack:
            self.fewer[i] = len(words)

    def within_one_edit(self, word: str) -> list[int]:
        """Places of the words at most one edit from ``word``, which may be itself.

        The row for the first d letters of a list word holds its distances to the first d - 1,
        d and d + 1 letters of ``word``."""
        found, size = [], len(word)
        rows = [(2, 0, 1)]
        i, n = 0, len(self.words)
        while i < n:
            other = self.words[i]
            d = min(self.shared[i], len(rows) - 1)
            del rows[d + 1 :]
            low, same, high = rows[d]
            alive = True
            while d < len(other):
                c = other[d]
                # Cells for d, d + 1 and d + 2 letters of the word.
                x = min(low + (d < 1 or d > size or word[d - 1] != c), same + 1)
                y = min(same + (d >= size or word[d] != c), high + 1, x + 1)
                z = min(high + (d + 1 >= size or word[d + 1] != c), y + 1)
                low, same, high = x, y, z
                d += 1
                rows.append((low, same, high))
                if low > 1 and same > 1 and high > 1:
                    alive = False
                    break
            if alive:
                gap = size - len(other)
                if -1 <= gap <= 1 and (low, same, high)[gap + 1] <= 1:
                    found.append(i)
                i += 1
                continue
            i += 1
            while self.shared[i] >= d:
                i = self.fewer[i]
        return found


def _pairs_of(m: int, first: int, last: int, limit: int, words: list[str], n: list[int]) -> list[tuple]:
    """NEAR rows of a block: what each word has near it there."""
    middles = sorted(range(len(words)), key=lambda i: words[i][first : len(words[i]) - last])
    scan = SortedList([words[i][first : len(words[i]) - last] for i in middles])
    near: dict[int, list[int]] = {}
    for place, i in enumerate(middles):
        word = words[i]
        if len(word) != m:
            continue
        for other in scan.within_one_edit(scan.words[place]):
            j = middles[other]
            if j == i or word[:limit] == words[j][:limit]:
                continue
            near.setdefault(i, []).append(j)
            if len(words[j]) != m:
                near.setdefault(j, []).append(i)
    out = []
    for i, others in near.items():
        best = min(others, key=lambda j: (-n[j], words[j]))
        out.append((words[i], len(others), n[best], words[best]))
    return out


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, n_near, near_n, near) of the words that have near ones: how many, and the most
    frequent one."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, members, n, out = None, [], [], []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["word", "n_near", "near_n", "near"],
            )

        for batch in batches:
            for *key, word, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != block:
                    if len(members) > 1:
                        out += _pairs_of(*block[:4], members, n)
                    block, members, n = key, [], []
                members.append(word)
                n.append(count)
            yield rows()
            out = []
        if len(members) > 1:
            out += _pairs_of(*block[:4], members, n)
        yield rows()

    blocks = _blocks(words, most).select(*BLOCK, "word", "n")
    found = blocks.repartition(*BLOCK).sortWithinPartitions(*BLOCK).mapInArrow(each, NEAR)
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.order")).alias("near_n"), "best.near"
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words (word, form) that have a form: each round goes on from where the
    root so far has got to, so it doubles the steps."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(on, "root", "left")
        moved = written(
            step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("went")),
            "spelling-roots",
        )
        now = moved.select("word", "root")
        if moved.where("went").isEmpty():
            return now


def spelling_variants(
    docs: DataFrame, least: int = LEAST_COUNT, ratio: int = RATIO, most: int = MOST
) -> DataFrame:
    """word, form, root, n, n_near and form_n of all words found ``least`` times or more."""
    words = written(word_counts(docs).where(F.col("n") >= least), "spelling-words")
    near = near_words(words, most)
    known = F.col("near_n") >= ratio * F.col("n")
    rows = written(
        words.join(near, "word", "left").select(
            "word",
            F.when(known, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(known, F.col("near_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
