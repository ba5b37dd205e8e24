"""Mixing sources to target weights with a splitting tree of exact block quotas.

Each source's documents stand in an order given by a hash; positions are counted in words.
A source with a target of t words gives the first t, going round again after its last
document, and these are cut into blocks of equal length. The blocks of all sources are
dealt to output shards by a tree: at each node a multivariate hypergeometric draw splits
the node's quotas between its halves, so that shards get random mixtures whose quotas add
up exactly. A shard takes the next blocks of each source in a permuted order, disjoint from
those of other shards, and is then shuffled by itself.

A null text has 0 words; a null source is a source of its own, the last one. Documents
without words are taken as their place in the order says. Rows that repeat are documents of
their own. Empty tables give empty mixtures.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import n_words
from tidemark.sources.scratch import written

WEIGHTS = (5.0, 2.0, 1.0)
ROWS_PER_SLOT = 4096
MAX_SOURCES = 1_000_000
# Most blocks in one draw that the sampler takes.
MAX_BLOCKS = 10**9 - 1
PLAN = (
    "m_source string, m_index int, m_source_size long, m_target double, m_rows long, m_slots long"
)


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Words for each source: ``share`` of all by weight, none above ``most`` times its size.
    What is above goes to the others by weight, until none is above."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    left, out = share * sum(sizes), [0.0] * len(sizes)
    active = list(range(len(sizes)))
    while active:
        unit = left / sum(weight[i] for i in active)
        above = [i for i in active if unit * weight[i] > most * sizes[i]]
        if not above:
            for i in active:
                out[i] = unit * weight[i]
            break
        for i in above:
            out[i] = float(most * sizes[i])
            left -= out[i]
        active = [i for i in active if i not in set(above)]
        left = max(left, 0.0)
    return out


def split_quotas(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Blocks per shard and source. Shards get equally many blocks, give or take one. Each
    node of the tree draws its left half's blocks without replacement from its own."""
    total = int(sum(quotas))
    if total > MAX_BLOCKS:
        raise ValueError(f"{total} blocks; use longer ones")
    room = np.diff(np.arange(shards + 1) * total // shards)
    out = np.zeros((shards, len(quotas)), np.int64)
    nodes = [(0, shards, np.array(quotas, np.int64))]
    while nodes:
        low, high, held = nodes.pop()
        if high - low == 1:
            out[low] = held
            continue
        middle = (low + high) // 2
        draw = np.random.default_rng([seed, low, high])
        left = draw.multivariate_hypergeometric(held, int(room[low:middle].sum()), method="marginals")
        nodes += [(low, middle, left), (middle, high, held - left)]
    return out


@dataclass(frozen=True)
class Mixture:
    """``decided``: the documents as structs with m_* columns (size, source_size, target,
    rank within the source and the blocks each copy starts in). ``blocks``: the shard of
    every block."""

    decided: DataFrame
    blocks: DataFrame
    shards: int
    seed: int

    def copies(self) -> DataFrame:
        """One row per copy taken, with its shard."""
        each = self.decided.withColumn("m_block", F.explode("m_blocks"))
        return each.join(self.blocks, ["m_index", "m_block"])

    def shuffled(self) -> DataFrame:
        """The mixture: the documents' columns, shard by shard, each in random order."""
        order = F.xxhash64(F.lit(self.seed + 1), "m_block", "m_index", "m_rank")
        dealt = self.copies().repartition(self.shards, "m_shard")
        return dealt.sortWithinPartitions("m_shard", order, "m_index", "m_rank").select(
            "row.*"
        )

    def report(self) -> DataFrame:
        """Per document: size, source_size, target, the words taken, and its shards."""
        rows = self.decided.withColumn("m_block", F.explode_outer("m_blocks"))
        rows = rows.join(self.blocks, ["m_index", "m_block"], "left")
        kept = ("m_size", "m_source_size", "m_target")
        return (
            rows.groupBy("m_index", "m_rank")
            .agg(
                F.min("row.doc_id").alias("doc_id"),
                *(F.min(c).alias(c) for c in kept),
                (F.count("m_shard") * F.min("m_size")).alias("taken"),
                F.array_sort(F.collect_list("m_shard")).alias("m_shards"),
            )
            .select(
                "doc_id",
                F.col("m_size").alias("size"),
                F.col("m_source_size").alias("source_size"),
                F.col("m_target").alias("target"),
                "taken",
                F.array_join(F.col("m_shards").cast("array<string>"), ",").alias("shards"),
            )
        )


def _keyed(docs: DataFrame, plan: DataFrame, seed: int, kept: list[str]) -> DataFrame:
    """The kept columns as one struct, the size, the source's plan, and a slot and a key
    from a hash. All other columns have names of this module, whatever the documents have."""
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    found = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"),
        F.col("source").alias("m_source_of"),
        n_words(F.col("text")).alias("m_size"),
        key.alias("m_key"),
    ).join(F.broadcast(plan), F.col("m_source_of").eqNullSafe(F.col("m_source")))
    return found.withColumn("m_slot", F.pmod(F.col("m_key"), F.col("m_slots")))


def _copies(start: Column, size: Column, most: float, block_words: int) -> Column:
    """The blocks in which the copies of a document start: a copy for each round in which
    its middle comes before the target. Taken words so miss the target by half a document."""
    rounds = F.array(
        *(
            F.when(
                start + F.lit(k) * F.col("m_source_size") + size / 2 < F.col("m_target"),
                F.floor((start + F.lit(k) * F.col("m_source_size")) / block_words),
            )
            for k in range(math.ceil(most))
        )
    )
    return F.array_compact(rounds)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = 1 << 16,
    shard_words: int = 1 << 22,
    seed: int = 7,
    keep: Sequence[str] | None = None,
) -> Mixture:
    """Draws a mixture of ``docs`` (doc_id, text, source and any others), of which the
    columns ``keep`` (all if not given) come along.

    Sources, by code point and null last, have ``weights`` in turn. They share ``share``
    times the words of all documents; none gives more than ``most`` times its own.
    """
    spark = docs.sparkSession
    keep = list(docs.columns if keep is None else keep)
    # One row per source comes to the driver; their number is checked.
    counted = docs.groupBy("source").count().limit(MAX_SOURCES + 1).collect()
    if len(counted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    counted = sorted(
        ((r["source"], r["count"]) for r in counted), key=lambda s: (s[0] is None, s[0] or "")
    )
    plain = [(s, i, 0, 0.0, n, -(-n // ROWS_PER_SLOT)) for i, (s, n) in enumerate(counted)]
    slots = (
        _keyed(docs, spark.createDataFrame(plain, PLAN), seed, ["doc_id"])
        .groupBy("m_index", "m_slot")
        .agg(F.sum("m_size").alias("m_slot_size"), F.count("*").alias("m_slot_rows"))
    )
    slots = written(slots, "mix")
    sizes = dict(slots.groupBy("m_index").agg(F.sum("m_slot_size")).collect())
    sizes = [sizes[i] for i in range(len(plain))]
    goal = targets(sizes, weights, share, most)
    plan = [(s, i, z, t, n, k) for (s, i, _, _, n, k), z, t in zip(plain, sizes, goal, strict=True)]

    before = Window.partitionBy("m_index").orderBy("m_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slots.select(
        "m_index",
        "m_slot",
        F.coalesce(F.sum("m_slot_size").over(before), F.lit(0)).alias("m_words_before"),
        F.coalesce(F.sum("m_slot_rows").over(before), F.lit(0)).alias("m_rows_before"),
    )
    ordered = Window.partitionBy("m_index", "m_slot").orderBy("m_key", "m_size")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    placed = _keyed(docs, spark.createDataFrame(plan, PLAN), seed, keep)
    placed = placed.join(offsets, ["m_index", "m_slot"])
    placed = placed.withColumns(
        {
            "m_rank": F.col("m_rows_before") + F.row_number().over(ordered),
            "m_start": F.col("m_words_before")
            + F.coalesce(F.sum("m_size").over(earlier), F.lit(0)),
        }
    )
    decided = placed.withColumn(
        "m_blocks", _copies(F.col("m_start"), F.col("m_size"), most, block_words)
    )

    quotas = [math.ceil(t / block_words) for t in goal]
    shards = max(1, math.ceil(sum(goal) / shard_words))
    blocks = _dealt_blocks(docs, quotas, split_quotas(quotas, shards, seed), seed)
    return Mixture(decided, blocks, shards, seed)


def _dealt_blocks(docs: DataFrame, quotas: list[int], dealt: np.ndarray, seed: int) -> DataFrame:
    """The shard of every block: shards take each source's blocks one after another in an
    order permuted by j -> a * j + b mod the source's quota."""
    offsets = np.cumsum(dealt, axis=0) - dealt
    draw, steps = np.random.default_rng([seed, 1]), {}
    for i, q in enumerate(quotas):
        a = 1 + int(draw.integers(max(q, 1)))
        while math.gcd(a, max(q, 1)) != 1:
            a += 1
        steps[i] = (a, int(draw.integers(max(q, 1))))
    rows = [
        (int(i), int(s), int(offsets[s, i]), int(dealt[s, i]), quotas[i], *steps[i])
        for s, i in zip(*dealt.nonzero(), strict=True)
    ]
    runs = docs.sparkSession.createDataFrame(
        rows, "m_index int, m_shard int, first long, n long, quota long, a long, b long"
    )
    place = F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("j")
    return runs.select("m_index", "m_shard", "quota", "a", "b", place).select(
        "m_index", "m_shard", F.pmod(F.col("a") * F.col("j") + F.col("b"), F.col("quota")).alias("m_block")
    )
