"""Components of near copies against comparing all pairs of sets."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.plain import DOCS, corpus, prose, words
from tidemark.llm import minhash
from tidemark.llm.components import components
from tidemark.llm.shingles import mixed, probes, shingle_sets, sketches


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def joined(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {n: find(n) for n in nodes}


def plain(rows, k=4, percent=80):
    sets = [(r[0], shingles(r[1], k)) for r in rows]
    links = []
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if i is not None and j is not None and a and b:
            if 100 * len(a & b) >= percent * len(a | b):
                links.append((i, j))
    root = joined(links, {i for i, _ in sets if i is not None})
    return Counter(
        (i, len(s), root.get(i), i is None or root[i] == i) for i, s in sets
    )


def near_boundary():
    """A large group whose members are at all distances from each other."""
    draw, base = random.Random(1), prose(77, 70).split(" ")
    out = []
    for i in range(120):
        text = list(base)
        for at in draw.sample(range(70), draw.choice([0, 1, 1, 2, 2, 3, 5])):
            text[at] = f"x{draw.randrange(4)}"
        out.append((5000 + i, " ".join(text), None, None, None))
    return out


@pytest.mark.parametrize("block, shingles", [(512, 500_000), (16, 500_000), (512, 1000)])
def test_components_equal_all_pairs(spark, monkeypatch, block, shingles):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
    rows = corpus() + near_boundary() + [(None, prose(9, 120), None, None, None)]
    rows += [(100, prose(9, 120), None, None, None)]  # an id that repeats with another text
    docs = spark.createDataFrame(rows, DOCS)
    got = Counter(map(tuple, minhash.near_duplicates(docs, 4, 80).collect()))
    assert got == plain(rows)


@pytest.mark.parametrize("density", [0.0, 0.05, 0.3, 1.0])
def test_a_forest_joins_what_all_links_join(density):
    draw = np.random.default_rng(5)
    linked = draw.random((40, 50)) < density
    left, right = draw.integers(0, 70, 40), draw.integers(0, 70, 50)
    row, column = minhash._forest(linked, left, right)
    assert linked[row, column].all()
    names = {*left.tolist(), *right.tolist()}
    few = list(zip(left[row].tolist(), right[column].tolist(), strict=True))
    every = [(int(left[i]), int(right[j])) for i, j in zip(*linked.nonzero(), strict=True)]
    found = joined(few, names)
    assert found == joined(every, names) and len(few) == len(names) - len(set(found.values()))


def test_a_similar_group_gives_fewer_links_than_nodes(spark):
    """Forty members of one bucket, all alike, each a component so far."""
    docs = [(i, zlib.compress(prose(9, 120).encode())) for i in range(40)]
    texts = spark.createDataFrame(docs, "node long, packed binary")
    open_ = texts.selectExpr("1L as bucket", "node", "node as label", "1 as blocks")
    links = minhash.compared_in_blocks(open_, texts, 4, 80)
    assert links.count() == 39
    assert {r["component"] for r in components(links).collect()} == {0}


def test_one_document_of_each_group_stays(spark):
    rows = corpus(20)
    docs = spark.createDataFrame(rows, DOCS).withColumn("node", F.lit(1)).withColumn("row", F.lit(2))
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, _, k in plain(rows, 5).elements() if k}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(want)
    assert minhash.without_near_duplicates(docs.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    draw = random.Random(2)
    names = draw.sample(range(10_000), 400)
    path = list(zip(names[:150], names[1:150], strict=False))
    star = [(names[200], n) for n in names[201:300]]
    ring = list(zip(names[300:], names[301:] + names[300:301], strict=True))
    edges = path + star + ring + [(b, a) for a, b in ring] + [(names[0], names[0])]
    got = {
        r["node"]: r["component"]
        for r in components(spark.createDataFrame(edges, "a long, b long")).collect()
    }
    nodes = {n for e in path + star + ring for n in e}
    assert got == joined(edges, nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingle_sets_equal_sets_of_words():
    texts = [r[1] for r in corpus(20)] + ["a b", "b a", "a b c", "a b c d", "a  b\tc\nd"]
    raw = [(t or "").encode().lower() for t in texts]
    doc, value = shingle_sets(raw, 4)
    assert np.bincount(doc, minlength=len(raw)).tolist() == [len(shingles(t, 4)) for t in texts]
    by = [set(value[doc == i].tolist()) for i in range(len(raw))]
    for i, j in itertools.combinations(range(len(raw)), 2):
        assert len(by[i] & by[j]) == len(shingles(texts[i], 4) & shingles(texts[j], 4))


@pytest.mark.parametrize("n", [3, 40, 600])
def test_sketches_agree_as_often_as_sets_are_similar(n):
    """Also for sets much smaller than the number of bins: empty bins are filled unbiased."""
    draw, order, seen = np.random.default_rng(n), probes(512), []
    for _ in range(60):
        pool = mixed(draw.integers(0, 1 << 63, 3 * n, np.uint64))
        a, b = np.sort(pool[: 2 * n]), np.sort(pool[n:])
        doc = np.repeat([0, 1], 2 * n)
        both = sketches(doc, np.concatenate([a, b]), 2, order)
        seen.append((both[0] == both[1]).mean())
    assert abs(np.mean(seen) - 1 / 3) < 0.05
