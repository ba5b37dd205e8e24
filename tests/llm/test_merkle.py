"""The manifest against a tree built in plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.plain import DOCS, awkward_rows
from tidemark.llm import merkle

NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """The root and, per leaf, (left, right) of each level."""
    paths, own, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, at in enumerate(own):
            first = at - at % 3
            paths[i].append((nodes[first:at], nodes[at + 1 : first + 3]))
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        own = [at // 3 for at in own]
    return nodes[0], paths


def plain(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        mine = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[source] = (mine, *tree([leaf(*r) for r in mine]))
    root, above = tree([trees[s][1] for s in order])
    out = []
    for source, more in zip(order, above, strict=True):
        mine, subroot, paths = trees[source]
        for r, path in zip(mine, paths, strict=True):
            path = path + more
            seen = r
            if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 2 == 0 and r[1]:
                seen = (r[0], r[1].replace("\n", ""), *r[2:])
            digest = leaf(*seen)
            for left, right in path:
                digest = h(*left, digest, *right)
            proof = h(*(x for left, right in path for x in left + right))
            out.append((r[0], leaf(*r), subroot, root, proof, digest, digest == root))
    return Counter(out)


def many():
    rows = [r for r in awkward_rows() if r[0] != 8]
    rows += [(None, "no id\n", "en", "a", 6), (None, None, None, None, None)]
    rows += [(1000 + i, f"line\n{i}\nend", "en", "big", i) for i in range(1000)]
    rows += [(5000 + i, f"one\n{i}", None, f"s{i}", None) for i in range(100)]
    return rows + [(7000 + i, "x\n\ny", "de", "￮" if i % 2 else "\U0001f600", i) for i in range(9)]


@pytest.mark.parametrize("rows", [many(), many()[:1], many()[:3], [(3, "a\n", "x", "s", 1)] * 4])
def test_manifest_equals_plain_trees(spark, rows):
    got = merkle.manifest_report(spark.createDataFrame(rows, DOCS))
    assert got.columns == NAMES
    assert Counter(map(tuple, got.collect())) == plain(rows)


def test_empty_and_clashing(spark):
    assert merkle.manifest_report(spark.createDataFrame([], DOCS)).count() == 0
    docs = spark.createDataFrame([(1, "a", "b", "c", 2, 9, 9)], DOCS + ", tree long, at long")
    [row] = merkle.manifest_report(docs).collect()
    assert row["verified"] and row["root"] == row["leaf"] == leaf(1, "a", "b", "c", 2)
