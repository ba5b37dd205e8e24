"""Near-duplicate documents by one-permutation hashing.

1. Each text becomes its set of word shingles, a 128-bit digest of the set and BANDS hashes
   of a densified one-permutation sketch. Texts of the same set are one node from here on.
2. Nodes with a band in common meet in a bucket. Each bucket is a star: every member is
   compared with the bucket's smallest node only, so a bucket of m nodes gives m pairs.
3. Pairs are confirmed on the full sets, and links joined to components.
4. A bucket whose members are still in several components may hide a link between two members
   that both miss the centre. Such buckets are compared whole, in pairs of bounded blocks
   that give only links, not pairs. So every two nodes that meet in some bucket are either
   compared or already connected.

A pair of similarity 0.8 meets in no bucket with probability (1 - 0.8^8)^64 < 1e-5.

Null, empty and blank texts have no shingles: n_shingles 0, linked with nothing. A row
without doc_id is linked with nothing and kept; its component_id is null. Rows that share a
doc_id are one document, linked by any of their texts. Other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batches, give_memory_back
from tidemark.llm.components import components
from tidemark.llm.shingles import (
    band_hashes,
    probes,
    set_digests,
    shingle_sets,
    sketches,
    slices,
)
from tidemark.sources.scratch import written

BANDS, ROWS = 64, 8
SALTS = 8
# Nodes whose ids are sent to every executor, 8 bytes each; more are joined by shuffle.
MOST_SENT = 1_000_000
# Nodes and shingles in a block of a bucket that is compared whole (one node may have more),
# and shingles looked at at a time.
BLOCK, BLOCK_SHINGLES, COLUMNS = 512, 500_000, 4096
# Of texts that are unpacked together, and of what a Python task gets at a time.
PAIR_BYTES, BATCH_BYTES = 2 << 20, 2 << 20
SKETCH = "doc_id long, n_shingles long, digest binary, bands array<long>"


def _lowered(texts: pa.Array) -> list[bytes]:
    return [(t.as_py() or "").encode("utf-8", "surrogatepass").lower() for t in texts]


def sketched(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, digest and bands (both null without shingles) of every text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = probes(BANDS * ROWS)
        for batch in batches:
            texts = _lowered(batch.column(1))
            for first, last in slices(texts):
                n = last - first
                doc, value = shingle_sets(texts[first:last], k)
                size = np.bincount(doc, minlength=n)
                bands = band_hashes(sketches(doc, value, n, order), BANDS).view(np.int64)
                digest = set_digests(doc, value, n)
                some = size > 0
                offsets = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(bands[some].ravel()), mask=pa.array(~some)
                )
                names = [d.tobytes() if s else None for d, s in zip(digest, some, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        pa.array(size, pa.int64()),
                        pa.array(names, pa.binary()),
                        lists,
                    ],
                    ["doc_id", "n_shingles", "digest", "bands"],
                )
            give_memory_back()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(each, SKETCH)


def packed_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The deflated texts of the nodes, from the documents."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [zlib.compress(t, 1) for t in _lowered(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], ["node", "packed"]
            )
            give_memory_back()

    wanted = F.broadcast(nodes) if nodes.count() <= MOST_SENT else nodes
    source = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    return source.join(wanted, "node", "left_semi").mapInArrow(each, "node long, packed binary")


def _unpacked_pairs(
    left: pa.Array, right: pa.Array
) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
    """Runs of pairs of texts of about PAIR_BYTES in all: the first one's place, and both sides."""
    first, a, b, held = 0, [], [], 0
    for i, (x, y) in enumerate(zip(left, right, strict=True)):
        a.append(zlib.decompress(x.as_py()))
        b.append(zlib.decompress(y.as_py()))
        held += len(a[-1]) + len(b[-1])
        if held >= PAIR_BYTES:
            yield first, a, b
            first, a, b, held = i + 1, [], [], 0
    if a:
        yield first, a, b


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            for first, left, right in _unpacked_pairs(batch.column(2), batch.column(3)):
                n = len(left)
                doc_a, a = shingle_sets(left, k)
                doc_b, b = shingle_sets(right, k)
                doc, value = np.concatenate([doc_a, doc_b]), np.concatenate([a, b])
                order = np.lexsort((value, doc))
                doc, value = doc[order], value[order]
                twice = (doc[1:] == doc[:-1]) & (value[1:] == value[:-1])
                common = np.bincount(doc[1:][twice], minlength=n)
                union = np.bincount(doc, minlength=n) - common
                linked[first : first + n] = (union > 0) & (100 * common >= percent * union)
            yield batch.select(["a", "b"]).filter(pa.array(linked))
            del batch
            give_memory_back()

    both = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("packed").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("packed").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    return both.mapInArrow(each, "a long, b long")


def _members(sketch: DataFrame, groups: DataFrame) -> DataFrame:
    """(bucket, node, n_shingles, centre) of every bucket with two nodes or more."""
    nodes = sketch.join(
        groups.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"]
    )
    met = nodes.select(
        F.col("doc_id").alias("node"), "n_shingles", F.explode("bands").alias("bucket")
    )
    shared = (
        met.groupBy("bucket")
        .agg(F.min("node").alias("centre"), F.max("node").alias("last"))
        .where("centre < last")
    )
    # A hot bucket is spread over SALTS tasks; only its one row of the other side is copied.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = met.withColumn("salt", F.pmod(F.hash("node"), F.lit(SALTS)))
    return salted.join(shared.select("bucket", "centre", salts), ["bucket", "salt"]).drop("salt")


def labelled(rows: DataFrame, column: str, labels: DataFrame, name: str) -> DataFrame:
    """Rows with the component of a node; one without links is its own."""
    found = labels.select(F.col("node").alias(column), F.col("component").alias(name))
    return rows.join(found, column, "left").withColumn(name, F.coalesce(name, column))


def _links(members: DataFrame, texts: DataFrame, known: DataFrame, k: int, percent: int) -> DataFrame:
    """Components of the nodes, from all links that buckets can show."""
    stars = members.where("node != centre").select(
        F.col("node").alias("a"), F.col("centre").alias("b")
    )
    stars = written(stars.distinct(), "stars")
    links = written(known.union(confirmed(stars, texts, k, percent)), "links")
    labels = components(links)
    open_ = _unresolved(members, labels)
    hidden = written(compared_in_blocks(open_, texts, k, percent), "links")
    return components(links.union(hidden)) if hidden.head(1) else labels


def _unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, node, label, blocks) of buckets in which two nodes other than the centre, which
    all have been compared with, are in different components; blocks is how many to cut the
    bucket into."""
    cuts = F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
    rows = labelled(members.where("node != centre"), "node", labels, "label")
    apart = (
        rows.groupBy("bucket")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.ceil(cuts).cast("int").alias("blocks"),
        )
        .where("low != high")
    )
    return rows.join(apart.select("bucket", "blocks"), "bucket").select(
        "bucket", "node", "label", "blocks"
    )


def compared_in_blocks(open_: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links that join all components which links within a bucket join. A bucket is cut into
    blocks of about BLOCK nodes or BLOCK_SHINGLES shingles; a task gets two blocks of one bucket, compares all their pairs
    and gives a spanning forest of the links, fewer than it has nodes."""

    def each(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        same = key[1].as_py() == key[2].as_py()
        left = np.array(table["block"]) == key[1].as_py()
        node, label = (np.array(table[c], np.int64) for c in ("node", "label"))
        bodies = [zlib.decompress(t.as_py()) for t in table["packed"]]
        common, size = _overlaps(bodies, left, left if same else ~left, k)
        a, b = np.flatnonzero(left), np.flatnonzero(left if same else ~left)
        union = size[a][:, None] + size[b][None, :] - common
        row, column = _forest(100 * common >= percent * union, label[a], label[b])
        return pa.table({"a": pa.array(node[a][row]), "b": pa.array(node[b][column])})

    block = F.pmod(F.hash("node"), F.col("blocks")).alias("block")
    cut = open_.distinct().select("bucket", "node", "label", block, "blocks")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    meeting = cut.select("bucket", "node", "label", "block", other).withColumns(
        {"i": F.least("block", "other"), "j": F.greatest("block", "other")}
    )
    return (
        meeting.join(texts, "node")
        .groupBy("bucket", "i", "j")
        .applyInArrow(each, "a long, b long")
        .distinct()
    )


def _forest(
    linked: np.ndarray, left: np.ndarray, right: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Of a table of links, rows and columns of those that join labels not yet joined by
    others; ``left`` and ``right`` are the labels of its rows and columns."""
    names, of = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = of[: len(left)], of[len(left) :]
    root = np.arange(len(names))
    rows, columns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in np.flatnonzero(linked.any(axis=1)):
        some = np.flatnonzero(linked[i])
        roots, first = np.unique(root[b[some]], return_index=True)
        new = roots != root[a[i]]
        rows.append(np.full(new.sum(), i))
        columns.append(some[first[new]])
        root[np.isin(root, roots[new])] = root[a[i]]
    return np.concatenate(rows), np.concatenate(columns)


def _overlaps(
    bodies: list[bytes], left: np.ndarray, right: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in common of every left and every right text, and all texts' sizes."""
    found = [shingle_sets(bodies[first:last], k) for first, last in slices(bodies)]
    firsts = [first for first, _ in slices(bodies)]
    doc = np.concatenate([d + first for first, (d, _) in zip(firsts, found, strict=True)])
    value = np.concatenate([v for _, v in found])
    _, column, times = np.unique(value, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    _, column = np.unique(column[shared], return_inverse=True)
    row = doc[shared]
    a, b = np.cumsum(left) - 1, np.cumsum(right) - 1
    total = np.zeros((left.sum(), right.sum()), np.float32)
    width = int(column.max(initial=-1)) + 1
    for low in range(0, width, COLUMNS):
        some = (column >= low) & (column < low + COLUMNS)
        sides = []
        for side, number in ((left, a), (right, b)):
            mine = some & side[row]
            table = np.zeros((side.sum(), COLUMNS), np.float32)
            table[number[row[mine]], column[mine] - low] = 1
            sides.append(table)
        total += sides[0] @ sides[1].T
    return np.rint(total).astype(np.int64), np.bincount(doc, minlength=len(bodies))


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, name: str = "near"
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text).

    Two documents are linked when 100 * intersection >= percent * union of their sets of k-word
    shingles; the component is the smallest doc_id reachable, and that one is kept.
    """
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        return _near_duplicates(docs, k, percent, name)


def _near_duplicates(docs: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """All that Python does is written when this returns."""
    sketch = written(sketched(docs, k), f"{name}-sketch")
    narrow = sketch.select("doc_id", "n_shingles", "digest")
    named = narrow.where("doc_id is not null and digest is not null")
    groups = written(
        named.groupBy("digest").agg(F.min("doc_id").alias("rep")), f"{name}-groups"
    )
    members = written(_members(sketch, groups), f"{name}-members")
    texts = written(packed_texts(docs, members.select("node").distinct()), f"{name}-texts")
    labels = _links(members, texts, same_id_links(named, groups), k, percent)
    classes = labelled(groups, "rep", labels, "component_id")
    found = narrow.join(classes.select("digest", "component_id"), "digest", "left")
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")
    )
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def same_id_links(named: DataFrame, groups: DataFrame) -> DataFrame:
    """Links between the sets that one doc_id has, where it repeats with several texts."""
    of = F.xxhash64("digest")
    several = named.groupBy("doc_id").agg(F.min(of).alias("low"), F.max(of).alias("high"))
    several = several.where("low != high").select("doc_id")
    rows = named.join(several, "doc_id").select("doc_id", "digest").distinct()
    return rows.join(groups, "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))


def without_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with the columns
    the documents had. Of rows that repeat a kept doc_id, the first by text stays; rows
    without an id all stay."""
    # Columns travel as one, so that none can clash with those made here.
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
    )
    gone = near_duplicates(docs.select("doc_id", "text"), k, percent).where("not kept")
    kept = rows.join(gone.select("doc_id").distinct(), "doc_id", "left_anti")
    repeated = (
        docs.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("doc_id")
    )
    several = kept.join(repeated, "doc_id").groupBy("doc_id").agg(
        F.min_by("row", F.struct("row.text", F.xxhash64("row"))).alias("row")
    )
    once = kept.join(repeated, "doc_id", "left_anti")
    return once.select("row.*").union(several.select("row.*"))
