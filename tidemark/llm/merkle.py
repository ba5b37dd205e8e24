"""Merkle manifest of a dataset: proofs from nested-interval labels.

Leaves stand in ranks within their tree. A node of level L covers the interval of ranks
[at * 3^L, (at + 1) * 3^L): the ancestors of a leaf are the nodes whose intervals hold its rank,
and what a parent's interval covers besides its own child are the child's siblings. So labels
alone tell ancestors and siblings. Containment is bucketed by level: nodes are kept in blocks of
FAN^STEP neighbours, each with all nodes of its STEP levels, and a block's interval is the label
by which the nodes below it find it.

Up: blocks are hashed, and their tops are the leaves of the next tier, until a tree has one node.
Down: a block learns the siblings above it, once for all its leaves, by a join on the interval
that holds it. The trees' tops, in order, are the leaves of one more tree in the same way.

Ranks come from a sort by ranges and a sum of counts by range, so no tree is sorted in one task.

Null values in any column have a place in a leaf; rows without doc_id come first, null sources
too. Rows of one doc_id and source are ordered by their digest; equal rows are leaves each. A
null doc_id is the empty text to the rule of tampering. No rows give no rows. Columns other than
those of a leaf are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import remainder
from tidemark.sources.scratch import written

FAN, STEP = 3, 4
BLOCK = FAN**STEP
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
# What stands to the left and to the right of a node among its siblings.
SIDE = "array<struct<left: string, right: string>>"


def hashed(*parts: Column) -> Column:
    """Lower-case hex of the hash of texts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    return hashed(*(field(columns[c]) for c in LEAF))


def ranked(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """Rows with their rank ``at`` in their ``tree`` and its size ``n``. Rows are sorted by
    ranges, and what the ranges before one hold of its trees is added up: a range has a row for
    each tree that begins in it, and one."""
    part = F.spark_partition_id().alias("part")
    spread = written(rows.repartitionByRange("tree", *by).select("*", part), f"{name}-ranges")
    within = Window.partitionBy("part", "tree").orderBy(*by)
    counts = spread.groupBy("tree", "part").agg(F.count("*").alias("held"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree",
        "part",
        F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"),
        F.sum("held").over(Window.partitionBy("tree")).alias("n"),
    )
    placed = spread.withColumn("place", F.row_number().over(within) - 1)
    return placed.join(starts, ["tree", "part"]).select(
        *rows.columns, (F.col("start") + F.col("place")).alias("at"), "n"
    )


def _levels(digests: Column, n: Column) -> Column:
    """The digests of each level of a block, its leaves first; ``n`` is the number of leaves of
    its tree. Levels end where the tree has one node."""

    def above(acc: Column) -> Column:
        last = F.element_at(acc["levels"], -1)
        runs = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(last) - 1) / FAN).cast("int")),
            lambda i: F.sha2(F.array_join(F.slice(last, i * FAN + 1, FAN), "").cast("binary"), 256),
        )
        more = F.struct(
            F.ceil(acc["n"] / FAN).cast("long").alias("n"),
            F.concat(acc["levels"], F.array(runs)).alias("levels"),
        )
        return F.when(acc["n"] > 1, more).otherwise(acc)

    start = F.struct(n.cast("long").alias("n"), F.array(digests).alias("levels"))
    steps = F.array(*(F.lit(i) for i in range(STEP)))
    return F.aggregate(steps, start, lambda acc, _: above(acc), lambda acc: acc["levels"])


def _siblings(levels: Column, at: Column) -> Column:
    """What stands beside the node at ``at`` of a block's first level, and beside each of its
    ancestors in the block: the interval of the parent without the child's own."""

    def beside(level: Column, i: Column) -> Column:
        place = F.floor(at / F.pow(F.lit(FAN), i)).cast("int")
        first = place - place % FAN
        left = F.array_join(F.slice(level, first + 1, place - first), "")
        right = F.array_join(F.slice(level, place + 2, FAN - 1 - (place - first)), "")
        return F.struct(left.alias("left"), right.alias("right"))

    # The last level of a block is the first of the one above it, or a top without siblings.
    inner = F.slice(levels, 1, F.size(levels) - 1)
    return F.transform(inner, beside).cast(SIDE)


def _blocks(nodes: DataFrame, name: str, *carried: str) -> DataFrame:
    """(tree, block, n, rows, levels, top) of nodes (tree, at, n, digest, ...)."""
    row = F.struct("at", "digest", *carried)
    rows = nodes.groupBy("tree", F.floor(F.col("at") / BLOCK).alias("block")).agg(
        F.any_value("n").alias("n"), F.sort_array(F.collect_list(row)).alias("rows")
    )
    rows = rows.withColumn("levels", _levels(F.col("rows.digest"), F.col("n")))
    return written(
        rows.withColumn("top", F.element_at(F.element_at("levels", -1), 1)), f"{name}-blocks"
    )


def _tops(blocks: DataFrame) -> DataFrame:
    n = F.ceil(F.col("n") / BLOCK).cast("long").alias("n")
    return blocks.select("tree", F.col("block").alias("at"), n, F.col("top").alias("digest"))


class Forest:
    """Trees over ranked leaves (tree, at, n, digest, ...): blocks of every tier."""

    def __init__(self, leaves: DataFrame, name: str, *carried: str):
        self.carried = carried
        self.tiers = [_blocks(leaves, f"{name}-0", *carried)]
        while self._largest() > BLOCK:
            nodes = _tops(self.tiers[-1])
            self.tiers.append(_blocks(nodes, f"{name}-{len(self.tiers)}"))

    def _largest(self) -> int:
        return self.tiers[-1].agg(F.max("n")).first()[0] or 0

    def tops(self) -> DataFrame:
        """(tree, digest)"""
        return self.tiers[-1].select("tree", F.col("top").alias("digest"))

    def proofs(self, above: DataFrame) -> DataFrame:
        """Each leaf's carried columns, digest, and ``path``: its siblings level by level. What
        ``above`` (tree, path, ...) has goes to every leaf, its path at the end."""
        extra = [c for c in above.columns if c not in ("tree", "path")]
        paths = above.withColumn("block", F.lit(0).cast("long"))
        for tier, blocks in reversed(list(enumerate(self.tiers))):
            kept = ["digest", *self.carried] if tier == 0 else []
            joined = blocks.join(paths, ["tree", "block"])
            each = joined.select(
                "tree", "levels", "path", *extra, "block", F.explode("rows").alias("row")
            )
            within = each.withColumn("within", F.col("row.at") - F.col("block") * BLOCK)
            paths = within.select(
                "tree",
                F.col("row.at").alias("block"),
                *(F.col("row")[c].alias(c) for c in kept),
                F.concat(_siblings(F.col("levels"), F.col("within")), "path").alias("path"),
                *extra,
            )
        return paths.drop("block")


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings make."""
    return F.aggregate(path, digest, lambda d, side: hashed(side["left"], d, side["right"]))


def manifest(docs: DataFrame, tampered: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, path, seen (the leaf of the row as ``tampered`` replaces its
    columns) and folded_root (the root that ``seen`` makes) of every row."""
    columns = {c: F.col(c) for c in LEAF}
    leaves = docs.select(
        # Null first, then by bytes.
        F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("0")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(columns).alias("digest"),
        leaf(columns | (tampered or {})).alias("seen"),
    )
    leaves = ranked(written(leaves, "merkle-leaves"), ["doc_id", "digest", "seen"], "merkle")
    trees = Forest(leaves, "merkle-trees", "doc_id", "seen")
    tops = trees.tops().select(
        F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("digest").alias("subroot"), "digest"
    )
    top = Forest(ranked(written(tops, "merkle-tops"), ["of"], "merkle-top"), "merkle-top", "of", "subroot")
    none = F.array().cast(SIDE)
    roots = top.tops().select("tree", F.col("digest").alias("root"), none.alias("path"))
    above = top.proofs(roots).select(F.col("of").alias("tree"), "subroot", "root", "path")
    return trees.proofs(written(above, "merkle-above")).select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        "seen",
        folded(F.col("seen"), F.col("path")).alias("folded_root"),
    )


def manifest_report(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, those of even checksum seen without their line ends."""
    text = F.col("text")
    cut = F.when(remainder(F.col("doc_id"), 2) == 0, F.translate(text, "\n", "")).otherwise(text)
    proof = F.array_join(F.transform("path", lambda side: F.concat(side["left"], side["right"])), "")
    return manifest(docs, {"text": cut}).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof.cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
