"""Windows found by suffix arrays against looking every window up."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.plain import DOCS, awkward_rows, lower, prose
from tidemark.llm.decontamination import decontaminate
from tidemark.llm import decontamination as dc
from tidemark.llm.suffixes import Shard, TestSuffixes, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [
    (1, prose(70, 40)),
    (2, prose(71, 10)),
    (3, "Tiny, item"),
    (4, "single"),
    (5, None),
    (6, " .,; "),
    (7, " ".join(["again"] * 30)),
    (None, prose(72, 15)),
    (1, prose(73, 12)),
    (10, prose(70, 40)),
    (100, "Ünïcode wörds " * 6),
]


def rows():
    draw = random.Random(3)
    texts = [t for _, t in ITEMS if t]
    out = awkward_rows()
    for i in range(200, 240):
        piece = draw.choice(texts).split(" ")
        low = draw.randrange(len(piece))
        some = " ".join(piece[low : low + draw.choice([5, 9, 10, 11, 25])])
        out.append((i, f"{prose(i, 20)} {some}, {prose(i + 1, 5)} {draw.choice(texts).upper()}", "en", "a", 1))
    out += [(300, "again " * 25, None, None, None), (301, "a tiny item", None, None, None)]
    return out


def plain(texts, items, width=10):
    windows = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        size = min(width, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text, *_ in texts:
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if items_ := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= items_
        whole = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), whole, bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 200])
def test_report_equals_lookup(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_BYTES", block)
    docs = spark.createDataFrame(rows(), DOCS)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert Counter(map(tuple, dc.contamination_report(docs, items).collect())) == plain(rows(), ITEMS)


def test_small_shards_and_small_windows(monkeypatch):
    tests = TestSuffixes([(str(i), t) for i, t in ITEMS], 3)
    texts = [r[1] for r in rows()]
    shard = Shard([tests.word_ids(words(t)) for t in texts], tests)
    covered, doc, item = shard.hits()
    got = dict(enumerate(shard.per_document(covered).tolist()))
    want = plain([(i, t) for i, t in enumerate(texts)], [(str(i), t) for i, t in ITEMS], 3)
    assert got == {w[0]: w[2] for w in want}
    ids = [p for p in zip(shard.order[:-1], shard.order[1:], strict=True)]
    far = int(tests.longest)
    key = [tuple(np.r_[shard.ids[p : p + far], 0][: (np.r_[shard.ids[p : p + far], 0] == 0).argmax()]) for p in shard.order]
    assert len(ids) and key == sorted(key)


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 100])
def test_longest_matches(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_BYTES", block)
    docs = spark.createDataFrame(rows(), DOCS)
    items = spark.createDataFrame(ITEMS[:2], "item_id long, text string")
    got = {(r["item"], r["item_word"]): r for r in dc.longest_matches(docs, items).collect()}
    texts = {}
    for r in rows():
        texts.setdefault(r[0], WORD.findall(lower(r[1])))
    for item, text in ITEMS[:2]:
        w = WORD.findall(text)
        for at in range(len(w) - 9):
            best = 0
            for d in texts.values():
                for p in range(len(d)):
                    n = 0
                    while at + n < len(w) and p + n < len(d) and w[at + n] == d[p + n]:
                        n += 1
                    best = max(best, n)
            found = got.get((str(item), at))
            assert (found["length"] if found else 0) == (best if best >= 10 else 0)
            if found:
                p = found["doc_word"]
                assert texts[found["doc_id"]][p : p + best] == w[at : at + best]


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 300])
def test_removal_keeps_columns_and_clean_rows(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_BYTES", block)
    docs = spark.createDataFrame(rows(), DOCS).withColumn("contamination", F.lit("c")).withColumn("items", F.lit(2))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = dc.decontaminate(docs, items)
    want = Counter(k[0] for k in plain(rows(), ITEMS).elements() if not k[5])
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == want
    assert dc.decontaminate(docs, items.limit(0)).count() == docs.count()
    assert dc.contamination_report(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 3])
def test_clashing_columns_pass_through(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_BYTES", block)
    kept = [(1, "a", "clean words", 7, 8), (2, "b", "some item text", 7, 8)]
    docs = spark.createDataFrame(kept, "doc_id long, found string, text string, digest long, row long")
    items = spark.createDataFrame([("i", "item text")], "item_id string, text string")
    left = decontaminate(docs, items)
    assert left.columns == docs.columns and [tuple(r) for r in left.collect()] == kept[:1]
