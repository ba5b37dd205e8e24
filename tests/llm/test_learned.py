"""Toxicity by held-out accuracy, neighbours by recall, the language model by brute force."""

import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.plain import DOCS, awkward_rows, corpus, prose, words
from tidemark.llm import katz, neighbours, toxicity

LABELS = "doc_id long, quality int, toxic int"


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


# Toxicity


def toxic_rows(n=400):
    draw, rows, labels = random.Random(8), awkward_rows(), []
    for i in range(n):
        text, bad = prose(20_000 + i, draw.randint(5, 80)).split(" "), draw.random() < 0.25
        if bad:
            for _ in range(draw.randint(1, 4)):
                text.insert(draw.randrange(len(text)), draw.choice(["gruffle", "snarkery", "you blorp"]))
        rows.append((20_000 + i, " ".join(text) + "!" * draw.randint(0, 2), "en", "a", None))
        labels.append((20_000 + i, 1, int(bad)))
    return rows, labels + [(1, None, None), (None, 0, 1), (777_777, 0, 1), (20_000, None, None)]


def test_toxicity_of_held_out_documents(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TREES", 5)
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, DOCS)
    got = toxicity.toxicity_report(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) for r in got)
    truth = {d: t for d, _, t in labels if t is not None}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert len(held) > 50 and right / len(held) > 0.95


def test_held_out_labels_teach_nothing(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TREES", 2)
    rows, labels = toxic_rows(150)
    docs = spark.createDataFrame(rows, DOCS)
    turned = [(d, q, t if t is None or crc(d) % 5 else 1 - t) for d, q, t in labels]
    one, two = (
        Counter(map(tuple, toxicity.toxicity_report(docs, spark.createDataFrame(x, LABELS)).collect()))
        for x in (labels, turned)
    )
    assert one == two


@pytest.mark.parametrize(("labels", "score"), [([], 0.0), ([(20_001, 1, 0), (20_002, 1, 0)], 0.0)])
def test_without_two_kinds_of_labels(spark, labels, score):
    rows, _ = toxic_rows(5)
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("s")).withColumn("_row", F.lit(1))
    model = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
    assert {r["score"] for r in model.score(docs).collect()} == {score}
    kept = toxicity.without_toxic(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert toxicity.toxicity_report(docs.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_features_of_single_texts():
    lexicon = toxicity.Lexicon({"moron": 2.0}, {"blorp": 1.5})
    named = dict(zip(toxicity.FEATURES, toxicity.features("YOU m0ron!! Blorpish, moron", lexicon), strict=True))
    assert named["word_density"] == 1 / 5 and named["opening_density"] == 1 / 5  # m 0 ron
    assert named["masked_hits"] == 1 and named["near_you"] == 2 and named["shouted_words"] == 1 / 5
    assert set(toxicity.features(None, lexicon)) == {0.0}


# Neighbours


def vector_rows():
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(12, 16))
    vectors = [(centres[i % 12] + draw.normal(size=16) * 0.7).astype(np.float32).tolist() for i in range(900)]
    rows = [(i, v, 1) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[7], 2) for i in range(300)]  # one vector, many rows
    rows += [rows[20], rows[20], (2000, vectors[3], None), (None, vectors[1], 1)]
    odd = [None, [], [0.0] * 16, [1.0, None] + [0.0] * 14, [float("nan")] * 16, [float("inf")] * 16, [1.0] * 3]
    rows += [(3000 + 20 * i, v, 0) for i, v in enumerate(odd)]
    # Of another length: searched among themselves. One alone of its length finds nothing.
    return rows + [(4000, [1.0, 0.0, 0.5], 0), (4001, [0.0, 2.0, 0.0], 0), (4020, [9.0], 0)]


def nearest(rows, k, every):
    good = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = v
    out = {}
    for length in {len(v) for v in good.values()}:
        ids = np.array(sorted(i for i, v in good.items() if len(v) == length))
        x = np.array([good[i] for i in ids])
        for q in ids[ids % every == 0]:
            score = neighbours._inner(x, np.array(good[q]))
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
            out[int(q)] = [(int(ids[j]), float(score[j])) for j in order]
    return {q: found for q, found in out.items() if found}


@pytest.mark.parametrize("shard", [5000, 300])
def test_neighbours(spark, monkeypatch, shard):
    monkeypatch.setattr(neighbours, "SHARD_NODES", shard)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 16)
    table = spark.createDataFrame(vector_rows(), "vec_id long, embedding array<float>, label int")
    got = defaultdict(list)
    for r in sorted(neighbours.nearest(table).collect()):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    want = nearest(vector_rows(), 20, 20)
    assert got.keys() == want.keys()
    found = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert found >= 0.97 * sum(map(len, want.values()))
    assert all(len(got[q]) == len(want[q]) == len(set(got[q])) for q in want)
    assert got[4000] == want[4000] == [(3120, 1.5), (4001, 0.0)] and 4020 not in got
    # The vector of many rows: all ties, smaller ids first.
    assert got[1000][:19] == want[1000][:19]


def test_places_of_a_beam_that_are_not_filled_are_empty():
    """Whatever the sort does with equal distances: neither absent edges nor nodes met before."""
    points = np.array([[0.0, 1.0], [1.0, 0.0]], np.float32)
    edges = np.array([[1, 2, 2, 2, 0, 0, 0, 0]] * 2)
    nodes, far = neighbours.beam_search(points, edges, 0, points, 5)
    assert [sorted(row) for row in nodes.tolist()] == [[-1, -1, -1, 0, 1]] * 2
    assert np.isfinite(far).sum() == 4


def test_few_vectors_and_none(spark):
    kind = "vec_id long, embedding array<float>"
    some = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [1.0, 0.0])], kind)
    got = [tuple(r) for r in sorted(neighbours.nearest(some).collect())]
    assert got == [(0, 1, 20, 1.0), (0, 2, 1, 0.5), (20, 1, 0, 1.0), (20, 2, 1, 0.5)]
    assert neighbours.nearest(some.limit(0)).count() == 0
    assert neighbours.nearest(some.where("vec_id = 0")).count() == 0


def test_pruning_keeps_diverse_neighbours():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [-5, 0]], np.float32)
    kept = neighbours.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 4, 0, -1, 1]]), 3, 1.2)
    assert kept.tolist() == [[1, 3, 4]]  # 2 stands behind 1


# Language model


class Brute:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.uni, self.ctx, self.pair = Counter(), Counter(), Counter()
        for text in texts:
            before = 0
            for w in text:
                self.uni[w] += 1
                self.pair[before, w] += 1
                self.ctx[before] += 1
                before = w
        self.n = sum(self.uni.values())
        self.d1, self.d2 = self.discounts(self.uni), self.discounts(self.pair)
        lost = sum(c * (1 - self.d1.get(c, 1)) for c in self.uni.values())
        self.whole = self.n if lost > 0 else self.n + 1
        self.unknown = (lost + self.whole - self.n) / self.whole
        after = defaultdict(list)
        for (a, b), c in self.pair.items():
            after[a].append((b, c))
        self.back = {}
        for a, seen in after.items():
            lost = sum(c * (1 - self.d2.get(c, 1)) for _, c in seen)
            whole = self.ctx[a] + (lost == 0)
            rest = 1 - math.fsum(self.single(b) for b, _ in seen)
            self.back[a] = whole, (lost + whole - self.ctx[a]) / whole / rest

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        return dict(enumerate(katz.good_turing([n[r] for r in range(1, katz.CUT + 2)]), 1))

    def single(self, w):
        c = self.uni[w]
        return self.d1.get(c, 1) * c / self.whole if c else self.unknown

    def log(self, a, b):
        if c := self.pair[a, b]:
            return math.log10(self.d2.get(c, 1) * c / self.back[a][0])
        return math.log10(self.back[a][1] if a in self.back else 1) + math.log10(self.single(b))


@pytest.mark.parametrize(("slice_", "bucket"), [(4_000_000, 2_000_000), (3_000, 200)])
def test_scores_equal_brute_force(spark, monkeypatch, slice_, bucket):
    monkeypatch.setattr(katz, "SLICE_TOKENS", slice_)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", bucket)
    rows = corpus(60) + [(None, "w1 w2 unheardof", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("slice", F.lit(1))
    got = katz.katz_scores(docs.repartition(3)).collect()
    texts = [(r[0], [*words(r[1]), 1]) for r in rows]  # 1 is the end
    model = Brute([t for i, t in texts if crc(i) % 10])
    v, want = len(model.uni), Counter()
    for i, t in texts:
        base = sum(math.log10((model.uni[w] + 0.1) / (model.n + 0.1 * (v + 1))) for w in t)
        score = sum(model.log(a, b) for a, b in zip([0, *t], t, strict=False))
        known = sum(model.uni[w] > 0 for w in t)
        want[i, crc(i) % 10 == 0, len(t), known, round(base, 5), round(score, 5), model.n] += 1
    assert want == Counter((*r[:4], round(r[4], 5), round(r[5], 5), r[6]) for r in got)
    for a in [0, "w0", "w3", *list(model.back)[-3:]]:  # every distribution sums to 1
        assert math.fsum(10 ** model.log(a, b) for b in [*model.uni, "unheardof"]) == pytest.approx(1)


def test_no_training_documents(spark):
    docs = spark.createDataFrame(awkward_rows(), DOCS)
    got = katz.katz_scores(docs, F.lit(False)).collect()
    assert len(got) == docs.count()
    assert {(r["n_known"], r["base_score"], r["score"], r["train_tokens"]) for r in got} == {(0, 0.0, 0.0, 0)}
    assert katz.katz_scores(docs.limit(0)).count() == 0


def test_a_long_run_of_letters_is_read_once():
    started = time.perf_counter()
    toxicity.features("a" * 1_000_000, toxicity.Lexicon({}, {}))
    assert time.perf_counter() - started < 5
