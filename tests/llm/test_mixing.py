"""Targets, quotas and draws of mixtures."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.plain import DOCS, corpus, prose, words
from tidemark.llm import mixing


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=12))
def test_targets_share_everything_below_the_caps(sizes):
    got = mixing.targets(sizes, (5, 2, 1), 1.5, 2)
    assert all(0 <= t <= 2 * s + 1e-6 for t, s in zip(got, sizes, strict=True))
    assert sum(got) == pytest.approx(1.5 * sum(sizes))
    open_ = [t / (5, 2, 1)[i % 3] for i, (t, s) in enumerate(zip(got, sizes, strict=True)) if t < 2 * s]
    assert not open_ or max(open_) == pytest.approx(min(open_))
    full = [t / (5, 2, 1)[i % 3] for i, (t, s) in enumerate(zip(got, sizes, strict=True)) if t == 2 * s]
    assert not open_ or not full or max(full) <= min(open_) + 1e-6


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=6), st.integers(1, 17))
def test_split_keeps_quotas_and_room(quotas, shards):
    dealt = mixing.split_quotas(quotas, shards, 3)
    assert dealt.sum(axis=0).tolist() == quotas
    assert dealt.sum(axis=1).max() - dealt.sum(axis=1).min() <= 1
    assert (dealt >= 0).all() and (dealt == mixing.split_quotas(quotas, shards, 3)).all()


def test_splits_are_hypergeometric_in_the_mean():
    first = [mixing.split_quotas([60, 30, 10], 4, seed)[0] for seed in range(300)]
    assert np.allclose(np.mean(first, axis=0), [15, 7.5, 2.5], atol=0.4)


def rows():
    out = corpus(80)
    return out + [(9000 + i, prose(i, 50 + i), "en", f"s{i % 4}", None) for i in range(200)]


def test_report(spark):
    docs = spark.createDataFrame(rows(), DOCS).withColumn("m_size", F.lit(1)).withColumn("row", F.lit(2))
    mixture = mixing.mix(docs, block_words=500, shard_words=8000)
    got = mixture.report().collect()
    size = {r[0]: len(words(r[1])) for r in rows()}
    of, total = {r[0]: r[3] for r in rows()}, defaultdict(int)
    for r in rows():
        total[r[3]] += size[r[0]]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, mixing.targets([total[s] for s in order], (5, 2, 1), 1.5, 2), strict=True))
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows())
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        s = of[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], total[s])
        assert r["target"] == pytest.approx(target[s])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in total)
    again = mixing.mix(docs.repartition(7), block_words=500, shard_words=8000).report().collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))

    shuffled = mixture.shuffled()
    assert shuffled.columns == docs.columns
    copies = Counter(r["doc_id"] for r in shuffled.collect())
    want = Counter()
    for r in got:
        want[r["doc_id"]] += len(r["shards"].split(",")) if r["shards"] else 0
    assert copies == +want
    held = {(r["m_index"], r["m_block"]): r["m_shard"] for r in mixture.blocks.collect()}
    assert len(held) == mixture.blocks.count()  # blocks are disjoint
    assert set(held.values()) == set(range(mixture.shards))


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert mixing.mix(docs).report().count() == 0
    assert mixing.mix(docs).shuffled().count() == 0
    blank = spark.createDataFrame([(1, None, None, None, None), (2, "", None, "a", 0)], DOCS)
    assert [r["taken"] for r in mixing.mix(blank).report().collect()] == [0, 0]
