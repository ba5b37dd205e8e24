"""Components by the grouped prefix join against comparing all pairs of sets."""

import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.plain import DOCS, corpus, prose
from tests.llm.test_near_duplicates import near_boundary
from tests.llm.test_near_duplicates import plain as all_pairs
from tidemark.llm import minhash, prefix_join


def plain(rows, k, percent):
    return Counter((i, n, c) for i, n, c, _ in all_pairs(rows, k, percent).elements())


def chained():
    """A line that many share, and a chain of texts each similar to the next one only."""
    draw, line = random.Random(3), prose(500, 12)
    out = [(8000 + i, f"{prose(600 + i, 30)} {line}", None, None, None) for i in range(40)]
    text = prose(700, 150).split(" ")
    for i in range(30):
        text[draw.randrange(150)] = f"y{i}"
        out.append((9000 + i, " ".join(text), None, None, None))
    return out


@pytest.mark.parametrize(("k", "percent", "often"), [(3, 90, 5), (3, 90, 1000), (5, 80, 5)])
def test_components_equal_all_pairs(spark, monkeypatch, k, percent, often):
    monkeypatch.setattr(prefix_join, "OFTEN", often)
    rows = corpus() + near_boundary() + chained() + [(None, prose(9, 120), None, None, None)]
    rows += [(100, prose(9, 120), None, None, None)]  # an id that repeats with another text
    docs = spark.createDataFrame(rows, DOCS)
    got = Counter(map(tuple, prefix_join.similar_documents(docs, k, percent).collect()))
    assert got == plain(rows, k, percent)


def test_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(prefix_join, "BLOCK", 16)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rows = near_boundary()
    docs = spark.createDataFrame(rows, DOCS)
    got = Counter(map(tuple, prefix_join.similar_documents(docs, 3, 90).collect()))
    assert got == plain(rows, 3, 90)


def test_empty_and_clashing(spark):
    assert prefix_join.similar_documents(spark.createDataFrame([], DOCS), 3, 90).count() == 0
    docs = spark.createDataFrame([(1, "a b c d", 1, 2), (2, "a b c d", 1, 2)], "doc_id long, text string, token long, prefix long")
    got = prefix_join.similar_documents(docs, 3, 90).collect()
    assert sorted(map(tuple, got)) == [(1, 2, 1), (2, 2, 1)]


def test_similar_sets_share_prefixes():
    """Whatever the order, also where half of the shingles come last by their rank."""
    draw = np.random.default_rng(4)
    for size in (1, 2, 9, 10, 11, 60):
        base = np.unique(draw.integers(0, 1 << 63, size).astype(np.uint64))
        known = np.sort(draw.permutation(base)[: len(base) // 2])
        rank = np.arange(1, len(known) + 1, dtype=np.int32)
        for _ in range(50):
            both = [np.sort(draw.permutation(base)[: draw.integers(1, len(base) + 1)]) for _ in range(2)]
            doc = np.repeat([0, 1], [len(x) for x in both])
            owner, token = prefix_join.prefixes(doc, np.concatenate(both), 2, 90, known, rank)
            common = len(np.intersect1d(*both))
            if 100 * common >= 90 * (len(both[0]) + len(both[1]) - common):
                assert set(token[owner == 0]) & set(token[owner == 1])


def test_similar_sets_share_keys():
    """Sets that differ in as many shingles as a link allows, of all sizes, in either order."""
    draw = np.random.default_rng(5)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    links = 0
    for percent in (50, 80, 90):
        for size in (*range(1, 40), 120, 619, 700):
            base = np.unique(draw.integers(0, 1 << 63, 2 * size).astype(np.uint64))
            base = draw.permutation(base)
            differ = 2 * size * (100 - percent) // (100 + percent)
            for gone in {0, differ // 2, differ}:
                a, b = base[: size - gone // 2], base[gone - gone // 2 : size + (differ - gone) // 2]
                doc = np.repeat([0, 1], [len(a), len(b)])
                doc, value, _ = prefix_join.ordered(doc, np.concatenate([np.sort(a), np.sort(b)]), *none)
                text, key = prefix_join.part_keys(doc, value, 2, percent)
                common = len(np.intersect1d(a, b))
                union = len(a) + len(b) - common
                if 0 < common < union and 100 * common >= percent * union:
                    links += 1
                    assert set(key[text == 0]) & set(key[text == 1])
    assert links > 100


def test_unrelated_texts_do_not_meet(spark, monkeypatch):
    """Texts of few words share many shingles, but are nowhere near each other."""
    rows = {}

    def noted(df, name):
        out = written(df, name)
        rows[name] = out.count()
        return out

    written = prefix_join.written
    monkeypatch.setattr(prefix_join, "written", noted)
    draw = random.Random(6)
    texts = [" ".join(draw.choice("abcdefghijkl") for _ in range(150)) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    got = prefix_join.similar_documents(docs, 3, 90).collect()
    assert sorted(r["component_id"] for r in got) == list(range(400))
    assert rows["prefix-buckets"] + rows["prefix-open"] < 400
