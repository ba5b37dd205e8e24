"""Nearest neighbours by robust-pruned directed graphs, one for each shard of the vectors.

Equal vectors are one node that knows its smallest ids; nodes are dealt to shards of about
SHARD_NODES by a hash. A shard's graph is built from a random one: greedy searches for every
node propose neighbours, and pruning keeps a proposal only where no kept neighbour is closer
to it, by a factor ALPHA, than the node is; edges are added backwards and pruned again where
a node has too many. Queries run a beam search over every shard, in blocks.

The largest inner product is the smallest distance after one more dimension has made all
vectors equally long (and is 0 for queries), so graphs use distances. Scores are computed
anew in double precision from the original vectors, component by component.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
rows without an id. Inner products are of vectors of one length: each length has shards and
query blocks of its own, and a query meets only those of its length. Rows that repeat an id and
vector count once. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.scratch import written

SHARD_NODES = 25_000
# Queries that meet a shard's graph together, and those searched a step at a time.
QUERY_BLOCK, SEARCH_BLOCK = 16_384, 1024
DEGREE, BEAM, SEARCH_BEAM, ALPHA = 32, 80, 160, 1.2
BUILD_BLOCK, PRUNE_BLOCK = 256, 256
SALTS = 32


# Vectors to nodes


def usable(rows: DataFrame, id_: str, vector: str) -> DataFrame:
    """vec_id, vector (floats, or doubles if given otherwise), length of the rows that take part."""
    v = F.col("vector")
    floats = rows.schema[vector].dataType == T.ArrayType(T.FloatType(), True)
    kind = "array<float>" if floats else "array<double>"
    rows = rows.select(
        F.col(id_).cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("vector")
    )
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size(v) > 0) & finite)
    return rows.where(F.exists(v, lambda x: x != 0)).withColumn("length", F.size(v))


def _nodes(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector with its k + 1 smallest ids: enough for any answer, as
    a query leaves out its own. A vector that many rows share is ranked in SALTS parts."""
    key = F.xxhash64("vector")
    rows = rows.withColumn("key", key).withColumn("salt", F.pmod(F.hash("vec_id"), F.lit(SALTS)))
    part = Window.partitionBy("key", "vector", "salt").orderBy("vec_id")
    rows = rows.distinct().withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k + 1)
    whole = Window.partitionBy("key", "vector").orderBy("vec_id")
    rows = rows.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k + 1)
    ids = F.array_sort(F.collect_list("vec_id")).alias("ids")
    return rows.groupBy("length", "key", "vector").agg(ids)


# The graph of a shard


def _squares(points: np.ndarray, of: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances from row i of ``of`` to the points numbered to[i]."""
    step = points[to] - of[:, None, :]
    return np.einsum("ijk,ijk->ij", step, step)


def beam_search(
    points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nodes found nearest to each query and their squared distances, all
    queries a step at a time: each opens its nearest unopened node."""
    n, rows = len(queries), np.arange(len(queries))
    nodes = np.full((n, beam), -1, np.int64)
    far = np.full((n, beam), np.inf, points.dtype)
    opened = np.ones((n, beam), bool)
    nodes[:, 0], opened[:, 0] = start, False
    far[:, 0] = _squares(points, queries, nodes[:, :1])[:, 0]
    seen = np.zeros((n, len(points) + 1), bool)  # the last column is for absent edges
    seen[:, [start, len(points)]] = True
    live = rows
    while True:
        waiting = np.where(opened[live], np.inf, far[live])
        pick = waiting.argmin(axis=1)
        more = np.isfinite(waiting[np.arange(len(live)), pick])
        live, pick = live[more], pick[more]
        if not len(live):
            return nodes, far
        opened[live, pick] = True
        near = edges[nodes[live, pick]]
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        row, place = fresh.nonzero()
        step = points[near[row, place]] - queries[live[row]]
        distance = np.full(near.shape, np.inf, points.dtype)
        distance[row, place] = np.einsum("ij,ij->i", step, step)
        all_far = np.concatenate([far[live], distance], axis=1)
        all_nodes = np.concatenate([nodes[live], np.where(fresh, near, -1)], axis=1)
        all_opened = np.concatenate([opened[live], ~fresh], axis=1)
        best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        far[live] = np.take_along_axis(all_far, best, axis=1)
        nodes[live] = np.take_along_axis(all_nodes, best, axis=1)
        opened[live] = np.take_along_axis(all_opened, best, axis=1)


def robust_prune(
    points: np.ndarray, nodes: np.ndarray, proposed: np.ndarray, degree: int, alpha: float
) -> np.ndarray:
    """For each node, up to ``degree`` of its proposed neighbours (-1: none), nearest first;
    one goes when a kept one is nearer to it by ``alpha`` than the node is."""
    out = np.full((len(nodes), degree), len(points), np.int64)
    for low in range(0, len(nodes), PRUNE_BLOCK):
        some = slice(low, low + PRUNE_BLOCK)
        _prune(points, nodes[some], proposed[some], alpha, out[some])
    return out


def _prune(
    points: np.ndarray, nodes: np.ndarray, proposed: np.ndarray, alpha: float, out: np.ndarray
) -> None:
    n = len(nodes)
    ordered = np.sort(proposed, axis=1)
    bad = (ordered < 0) | (ordered == nodes[:, None])
    bad[:, 1:] |= ordered[:, 1:] == ordered[:, :-1]
    safe = np.where(bad, 0, ordered)
    far = np.where(bad, np.inf, _squares(points, points[nodes], safe))
    order = np.argsort(far, axis=1, kind="stable")
    safe, far = np.take_along_axis(safe, order, 1), np.take_along_axis(far, order, 1)
    near = points[safe] - points[nodes][:, None, :]
    square = np.einsum("ijk,ijk->ij", near, near)
    between = square[:, :, None] + square[:, None, :] - 2 * near @ near.transpose(0, 2, 1)
    left, count = np.isfinite(far), np.zeros(n, np.int64)
    rows = np.flatnonzero(left.any(axis=1))
    while len(rows):
        first = left[rows].argmax(axis=1)
        out[rows, count[rows]] = safe[rows, first]
        count[rows] += 1
        # Distances here are squared, and so is the factor.
        left[rows] &= alpha * alpha * between[rows, first] > far[rows]
        left[rows, first] = False
        rows = rows[left[rows].any(axis=1) & (count[rows] < out.shape[1])]


class Graph:
    """Neighbours of every node, in a table with room to spare; a row that would overflow
    is pruned back to the degree."""

    def __init__(self, points: np.ndarray, degree: int, seed: int) -> None:
        n, self.degree, self.points = len(points), degree, points
        self.edges = np.full((n, degree + max(1, degree // 2)), n, np.int64)
        drawn = np.sort(np.random.default_rng(seed).integers(0, n, (n, degree)), axis=1)
        drawn[:, 1:][drawn[:, 1:] == drawn[:, :-1]] = n
        self.edges[:, :degree] = np.sort(drawn, axis=1)

    def own(self, nodes: np.ndarray) -> np.ndarray:
        held = self.edges[nodes]
        return np.where(held == len(self.points), -1, held)

    def choose(self, nodes: np.ndarray, proposed: np.ndarray, alpha: float) -> None:
        kept = robust_prune(self.points, nodes, proposed, self.degree, alpha)
        self.edges[nodes] = len(self.points)
        self.edges[nodes, : self.degree] = kept

    def add(self, source: np.ndarray, target: np.ndarray, alpha: float) -> None:
        """An edge from each source to its target, unless there is one."""
        width = self.edges.shape[1]
        new = ~(self.edges[source] == target[:, None]).any(axis=1)
        source, target = source[new], target[new]
        order = np.argsort(source, kind="stable")
        source, target = source[order], target[order]
        nodes, first, new = np.unique(source, return_index=True, return_counts=True)
        held = (self.edges[nodes] < len(self.points)).sum(axis=1)
        at = np.repeat(held, new) + np.arange(len(source)) - np.repeat(first, new)
        fits = np.repeat(held + new <= width, new)
        self.edges[source[fits], at[fits]] = target[fits]
        full = held + new > width
        # Hubs are pruned in runs, so that no row of proposals is longer than two rows.
        for low in range(0, int(new[full].max(initial=0)), width):
            some = full & (new > low)
            taken = np.minimum(new[some] - low, width)
            table = np.full((len(taken), width), -1, np.int64)
            row = np.repeat(np.arange(len(taken)), taken)
            column = np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
            table[row, column] = target[first[some][row] + low + column]
            both = np.concatenate([self.own(nodes[some]), table], axis=1)
            self.choose(nodes[some], both, alpha)


def build_graph(points: np.ndarray, seed: int = 0) -> tuple[np.ndarray, int]:
    """Edges (the number of nodes stands for none) and the node to start from, the one
    nearest to the mean."""
    n, draw = len(points), np.random.default_rng([seed, 1])
    start = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    graph = Graph(points, min(DEGREE, max(1, n - 1)), seed)
    for alpha in (1.0, ALPHA):
        order = draw.permutation(n)
        for low in range(0, n, BUILD_BLOCK):
            block = order[low : low + BUILD_BLOCK]
            found, _ = beam_search(points, graph.edges, start, points[block], BEAM)
            graph.choose(block, np.concatenate([found, graph.own(block)], axis=1), alpha)
            row, place = (graph.edges[block] < n).nonzero()
            graph.add(graph.edges[block][row, place], block[row], alpha)
    return graph.edges, start


def _longer(vectors: np.ndarray) -> np.ndarray:
    """One more component, so that all have the length of the longest."""
    square = (vectors.astype(np.float64) ** 2).sum(axis=1)
    rest = np.sqrt(np.maximum(square.max(initial=0.0) - square, 0.0))
    points = np.concatenate([vectors, rest[:, None]], axis=1)
    return (points / max(1e-300, float(np.abs(points).max(initial=0.0)))).astype(np.float32)


# Shards and queries


def _bytes(vectors: np.ndarray) -> bytes:
    """In single precision where that loses nothing, told by the first byte."""
    single = vectors.astype(np.float32)
    short = bool((single == vectors).all())
    return bytes([4 if short else 8]) + (single if short else vectors).tobytes()


def _vectors(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, f"<f{packed[0]}", offset=1).astype(np.float64).reshape(n, -1)


SHARD = "length int, shard int, n int, start int, vectors binary, edges binary, ids binary, counts binary"


def shard_numbers(nodes: DataFrame, size: int) -> DataFrame:
    """length, shards: how many shards of about ``size`` nodes each length has."""
    shards = F.greatest(F.lit(1), F.round(F.count(F.lit(1)) / size).cast("int"))
    return nodes.groupBy("length").agg(shards.alias("shards"))


def build_shards(nodes: DataFrame, numbers: DataFrame) -> DataFrame:
    """One row per shard: its vectors, graph, and the ids of each node."""

    def each(table: pa.Table) -> pa.Table:
        vectors = np.array(table["vector"].to_pylist(), np.float64)
        edges, start = build_graph(_longer(vectors))
        ids = table["ids"].to_pylist()
        flat = np.array([i for some in ids for i in some], np.int64)
        row = {
            "length": [vectors.shape[1]],
            "shard": [table["shard"][0].as_py()],
            "n": [len(vectors)],
            "start": [start],
            "vectors": [_bytes(vectors)],
            "edges": [edges.astype(np.int32).tobytes()],
            "ids": [flat.tobytes()],
            "counts": [np.array([len(some) for some in ids], np.int64).tobytes()],
        }
        kinds = [pa.int32()] * 4 + [pa.binary()] * 4
        return pa.table(
            [pa.array(c, k) for c, k in zip(row.values(), kinds, strict=True)], list(row)
        )

    # Hashing deals unevenly; a shard is bounded in expectation.
    dealt = nodes.join(numbers, "length").withColumn("shard", F.expr("pmod(hash(key), shards)"))
    return dealt.groupBy("length", "shard").applyInArrow(each, SHARD)


def _blocks(queries: DataFrame) -> DataFrame:
    """Queries in tables of ids and vectors, of about QUERY_BLOCK queries of one length."""

    def each(table: pa.Table) -> pa.Table:
        vectors = np.array(table["vector"].to_pylist(), np.float64)
        ids = np.array(table["vec_id"].to_pylist(), np.int64)
        return pa.table(
            {
                "length": pa.array([vectors.shape[1]], pa.int32()),
                "block": pa.array([table["block"][0].as_py()], pa.int32()),
                "query_ids": pa.array([ids.tobytes()], pa.binary()),
                "query_vectors": pa.array([_bytes(vectors)], pa.binary()),
            }
        )

    blocks = F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks")
    numbers = queries.groupBy("length").agg(blocks)
    dealt = queries.join(numbers, "length").withColumn("block", F.expr("pmod(hash(vec_id), blocks)"))
    return dealt.groupBy("length", "block").applyInArrow(
        each, "length int, block int, query_ids binary, query_vectors binary"
    )


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products along the last axis, added in the order of the components."""
    total = np.zeros(np.broadcast_shapes(a.shape, b.shape)[:-1])
    for d in range(a.shape[-1]):
        total += a[..., d] * b[..., d]
    return total


def _answers(shard: dict, block: dict, k: int) -> Iterator[pa.RecordBatch]:
    """query_id, vec_id, score of the k best of a shard for each query of a block."""
    n = shard["n"]
    vectors = _vectors(shard["vectors"], n)
    points = _longer(vectors)
    edges = np.frombuffer(shard["edges"], np.int32).reshape(n, -1).astype(np.int64)
    ids, counts = (np.frombuffer(shard[c], np.int64) for c in ("ids", "counts"))
    first = np.cumsum(counts) - counts
    reach = np.sqrt((points[:1].astype(np.float64) ** 2).sum())
    beam = min(max(SEARCH_BEAM, 2 * k), n)
    all_ids = np.frombuffer(block["query_ids"], np.int64)
    all_queries = _vectors(block["query_vectors"], len(all_ids))
    for low in range(0, len(all_ids), SEARCH_BLOCK):
        query_ids, queries = (x[low : low + SEARCH_BLOCK] for x in (all_ids, all_queries))
        # Only a query's direction matters; it is made as long as the points are.
        size = np.sqrt((queries**2).sum(axis=1, keepdims=True))
        aimed = np.concatenate([queries / size * reach, np.zeros((len(queries), 1))], axis=1)
        found, _ = beam_search(points, edges, shard["start"], aimed.astype(np.float32), beam)
        row, place = (found >= 0).nonzero()
        node = found[row, place]
        score = _inner(queries[row], vectors[node])
        many = counts[node]
        ends = np.cumsum(many)
        at = np.arange(many.sum()) + np.repeat(first[node] - (ends - many), many)
        row, score, vec_id = np.repeat(row, many), np.repeat(score, many), ids[at]
        other = vec_id != query_ids[row]
        row, score, vec_id = row[other], score[other], vec_id[other]
        order = np.lexsort((vec_id, -score, row))
        row, score, vec_id = row[order], score[order], vec_id[order]
        begin = np.searchsorted(row, np.arange(len(query_ids)))
        kept = np.arange(len(row)) - begin[row] < k
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[kept]) for c in (query_ids[row], vec_id, score)],
            ["query_id", "vec_id", "score"],
        )


def nearest(
    rows: DataFrame, id_: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20
) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every row whose id is
    divisible by ``every``: largest inner product, ties to the smaller id."""
    some = written(usable(rows, id_, vector), "vectors")
    nodes = written(_nodes(some, k), "nodes")
    numbers = written(shard_numbers(nodes, SHARD_NODES), "numbers")
    graphs = written(build_shards(nodes, numbers), "graphs")
    blocks = written(_blocks(some.where(F.col("vec_id") % every == 0).distinct()), "blocks")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = batch.slice(i, 1).to_pylist()[0]
                yield from _answers(pair, pair, k)

    # Every block of the query set meets every shard of its length.
    to = F.explode(F.expr("sequence(0, shards - 1)")).alias("shard")
    pairs = blocks.join(numbers, "length").select(*blocks.columns, to)
    pairs = pairs.join(graphs, ["length", "shard"])
    pairs = pairs.repartition("length", "shard", "block")
    answers = pairs.mapInArrow(each, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
