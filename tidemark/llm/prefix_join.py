"""Exact similarity join of documents by a grouped prefix join over word shingles.

1. Each text becomes its set of shingles. All sets are put in one order, rare shingles first:
   two sets of Jaccard similarity t or more share a shingle among the first
   size - ceil(t * size) + 1 of each (their prefixes), whatever the order.
2. A set is cut by hash into more parts than two similar sets of its run of sizes can differ
   in shingles. So some of the parts, SPARE more than one, are the same in both, and so are the
   first, rarest shingles of these, the part's prefix; a hash of it is a key. Unrelated texts
   share single shingles, the more the larger the corpus, but hardly ever the prefix of a part.
3. Texts of the same set are one node, nodes of the same prefixes and size one group.
4. Groups meet in buckets, one for each key that several have; buckets that hold the same
   groups are one. Each bucket is a star: groups are paired with its smallest one. Pairs are
   filtered by size and by the number of shingles that the prefixes of the whole sets share:
   all that two sets share is in both prefixes, or after the one that ends first.
5. Pairs of groups that pass are expanded: every member is compared with the smallest member of
   the other group, and with that of its own, on the full sets. Links are joined to components.
6. A bucket whose members are still in several components may hide a link that misses the
   centre. Its members are compared by their prefixes, in pairs of bounded blocks; those that
   may match one of another component are compared on the full sets, in such blocks again,
   which give a forest of their links. So any two nodes that meet are either compared, or ruled
   out by a filter, or connected.

The order only decides how many nodes meet, never which are linked: shingles that parts of the
corpus show often come last, by their count in all documents; the others by their hash.

Null, empty and blank texts have no shingles: n_shingles 0, linked with nothing. A row without
doc_id is linked with nothing; its component_id is null. Rows that share a doc_id are one
document, linked by any of their texts. An empty table gives an empty result. Other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import give_memory_back
from tidemark.llm.components import components
from tidemark.llm.minhash import (
    BLOCK,
    BLOCK_SHINGLES,
    COLUMNS,
    MOST_SENT,
    compared_in_blocks,
    confirmed,
    labelled,
    packed_texts,
    same_id_links,
)
from tidemark.llm.shingles import mixed, set_digests, shingle_sets, slices
from tidemark.sources.scratch import written

# Shingles counted together in a task, how often one must be there to be reported, and the
# most that are sent to every executor, 12 bytes each. They bear on the order alone.
COUNTED, OFTEN, MOST_FREQUENT = 2_000_000, 5, 1_000_000
# Sizes of a run grow by this, in percent at least. Of the parts, one in so many is spare; a key
# is made of so many shingles; parts of no more than one are small where they hold so many at most.
RUN, SPARE, PART_PREFIX, PART_SIZE = 130, 16, 4, 6
# A place in the order, as one number: rank first, then as many bits of the hash as fit.
RANK_BITS = 20
_CUT = np.uint64(0x9E3779B97F4A7C15)
SETS = "doc_id long, n_shingles long, digest binary, prefix_id binary, prefix array<long>, keys array<long>"


def _bytes(texts: pa.Array) -> list[bytes]:
    return [(t.as_py() or "").encode("utf-8", "surrogatepass").lower() for t in texts]


def frequent_shingles(
    docs: DataFrame, k: int, most: int = MOST_FREQUENT
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles found in most documents, sorted, and the rank of each, the most
    frequent last."""

    def often(values: list[np.ndarray]) -> pa.RecordBatch:
        value, n = np.unique(np.concatenate(values), return_counts=True)
        some = n >= OFTEN
        columns = [pa.array(value[some].view(np.int64)), pa.array(n[some], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["token", "n"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [np.zeros(0, np.uint64)], 0
        for batch in batches:
            texts = _bytes(batch.column(0))
            for first, last in slices(texts):
                kept.append(shingle_sets(texts[first:last], k)[1])
                size += len(kept[-1])
                if size >= COUNTED:
                    yield often(kept)
                    kept, size = [np.zeros(0, np.uint64)], 0
            give_memory_back()
        yield often(kept)

    counts = docs.select("text").mapInArrow(each, "token long, n long")
    table = (
        counts.groupBy("token")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(most)
        .toArrow()
    )
    token = np.array(table["token"], np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], (len(token) - order).astype(np.int64)


def prefixes(
    doc: np.ndarray, value: np.ndarray, n: int, percent: int, known: np.ndarray, rank: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(text, token) of the prefixes of sets given as ``shingle_sets`` gives them, in order. A
    token is the shingle's place in the order of all."""
    doc, _, token = ordered(doc, value, known, rank)
    return _first(doc, token, n, percent)


def _first(doc: np.ndarray, token: np.ndarray, n: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.bincount(doc, minlength=n)
    length = size - -(-percent * size // 100) + 1
    first = np.arange(len(doc)) - (np.cumsum(size) - size)[doc] < length[doc]
    return doc[first], token[first]


def ordered(
    doc: np.ndarray, value: np.ndarray, known: np.ndarray, rank: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, token) of each set in order."""
    token = (value >> np.uint64(RANK_BITS + 1)).astype(np.int64)
    if len(known):
        place = np.searchsorted(known, value)
        place[place == len(known)] = 0
        token |= np.where(known[place] == value, rank[place], 0) << (63 - RANK_BITS)
    order = np.lexsort((token, doc))
    return doc[order], value[order], token[order]


def part_keys(
    doc: np.ndarray, value: np.ndarray, n: int, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of the prefixes of the parts of sets given as ``ordered`` gives them. Two
    similar sets that are not the same share a key.

    A pair belongs to the run of its smaller set; a set has keys of its own run, and of the one
    before where it may match the largest of that. ``most`` is by how many shingles a pair of
    the run can differ: it is the same in all parts but so many. A set with no more small parts
    than are spare has no keys of these: of the equal ones then at least one is not small."""
    size = np.bincount(doc, minlength=n)
    growth = max(RUN, 10_100 // percent + 1) / 100
    own = np.floor(np.log(np.maximum(size, 1)) / np.log(growth)).astype(np.int64)
    drawn = mixed(value ^ _CUT) >> np.uint64(32)
    texts, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for run in (own, own - 1):
        top = np.floor(growth ** (run + 1.0)).astype(np.int64) + 1
        most = (top + 100 * top // percent) * (100 - percent) // (100 + percent)
        some = (size > 0) & (run >= 0) & (most > 0) & (size * percent <= 100 * top)
        spare = 1 + most // SPARE
        parts = np.where(some, most + 1 + spare, 0)
        begin = np.cumsum(parts) - parts
        mine = np.flatnonzero(some[doc])
        of = doc[mine]
        part = begin[of] + (drawn[mine] * parts[of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        held = np.bincount(part, minlength=parts.sum())
        together = np.argsort(part, kind="stable")
        at = np.arange(len(part)) - (np.cumsum(held) - held)[part[together]]
        first = together[at < PART_PREFIX]
        name = np.zeros(len(held), np.uint64)
        np.add.at(name, part[first], value[mine[first]])
        text = np.repeat(np.arange(n), parts)
        small = held <= (top >= PART_SIZE * parts)[text]
        kept = ~small | (np.bincount(text[small], minlength=n) > spare)[text]
        number = (run[text] << 40) + np.arange(len(text)) - begin[text]
        key = mixed(mixed(name + held.astype(np.uint64) * _CUT) ^ mixed(number.astype(np.uint64)))
        texts.append(text[kept])
        keys.append(key[kept].view(np.int64))
    text, key = np.concatenate(texts), np.concatenate(keys)
    order = np.lexsort((key, text))
    return text[order], key[order]


def _lists(owner: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def prefixed(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, prefix_id (of prefix, keys and size), prefix and keys."""
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, k))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = frequent.value
        for batch in batches:
            texts = _bytes(batch.column(1))
            for first, last in slices(texts):
                n = last - first
                doc, value = shingle_sets(texts[first:last], k)
                size = np.bincount(doc, minlength=n)
                digest = set_digests(doc, value, n)
                doc, value, token = ordered(doc, value, known, rank)
                owner, token = _first(doc, token, n, percent)
                text, keys = part_keys(doc, value, n, percent)
                names = set_digests(owner, token.view(np.uint64), n)
                names += set_digests(text, keys.view(np.uint64), n)
                names[:, 0] += mixed(size.astype(np.uint64))
                none = size == 0
                ids = [
                    pa.array([None if x else d.tobytes() for d, x in zip(of, none, strict=True)], pa.binary())
                    for of in (digest, names)
                ]
                lists = [_lists(owner, token, n), _lists(text, keys, n)]
                columns = [batch.column(0).slice(first, n), pa.array(size, pa.int64()), *ids, *lists]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "n_shingles", "digest", "prefix_id", "prefix", "keys"]
                )
            give_memory_back()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(each, SETS)


def _buckets(lists: DataFrame) -> DataFrame:
    """(bucket, group, centre) of the keys that several groups have; ``centre`` is the smallest
    group."""
    entries = lists.select("group", F.explode("keys").alias("bucket"))
    # Most keys are of one group. To tell them apart a shuffle of the keys alone will do.
    several = entries.groupBy("bucket").agg(F.count("*").alias("rows")).where("rows > 1")
    several = written(several.select("bucket"), "prefix-keys")
    met = written(entries.join(_sent(several), "bucket").distinct(), "prefix-met")
    held = F.xxhash64("group")
    found = (
        met.groupBy("bucket")
        .agg(
            F.count("*").alias("groups"),
            F.bit_xor(held).alias("bits"),
            F.sum(F.shiftright(held, 20)).alias("total"),
            F.min("group").alias("centre"),
        )
        .where("groups > 1")
    )
    # Buckets of the same groups show the same pairs: that of the first key stays.
    kept = found.groupBy("groups", "bits", "total", "centre").agg(F.min("bucket").alias("bucket"))
    kept = written(kept.select("bucket", "centre"), "prefix-kept")
    return met.join(_sent(kept), "bucket").select("bucket", "group", "centre")


def _sent(rows: DataFrame) -> DataFrame:
    """Rows to be joined with: sent to every executor while they are few."""
    return F.broadcast(rows) if rows.count() <= MOST_SENT else rows


def similar_documents(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs`` (doc_id, text): two
    documents are linked when 100 * intersection >= percent * union of their sets of k-word
    shingles; the component is the smallest doc_id reachable."""
    sets = written(prefixed(docs, k, percent), "prefix-sets")
    named = sets.where("doc_id is not null and digest is not null")
    nodes = written(
        named.groupBy("digest", "prefix_id", F.col("n_shingles").alias("size")).agg(
            F.min("doc_id").alias("node")
        ),
        "prefix-nodes",
    )
    groups = written(
        nodes.groupBy("prefix_id", "size").agg(F.min("node").alias("group"), F.count("*").alias("n")),
        "prefix-groups",
    )
    # The lists of a group are those of its smallest node. Where that is a document of several
    # texts, it has the keys of them all.
    lists = named.join(_sent(groups.select(F.col("group").alias("doc_id")).distinct()), "doc_id", "left_semi")
    lists = lists.withColumnsRenamed({"doc_id": "group", "n_shingles": "size"})
    buckets = written(_buckets(lists), "prefix-buckets")
    used = written(buckets.select("group").distinct(), "prefix-met-groups")
    shared = written(_shared(lists.join(_sent(used), "group"), buckets), "prefix-shared")
    several = groups.where("n > 1").select("prefix_id", "size", "group")
    own = written(
        nodes.join(several, ["prefix_id", "size"]).select("group", "node"), "prefix-members"
    )
    # (group, node), groups of one node included, of the groups that are in a bucket.
    single = groups.where("n = 1").select("group", F.col("group").alias("node"))
    members = written(own.union(single).distinct().join(used, "group"), "prefix-used")

    stars = buckets.where("group != centre").select("group", F.col("centre").alias("b"))
    across = written(_filtered(stars.distinct(), shared, percent), "prefix-across")
    pairs = own.where("node != group").select(F.col("node").alias("a"), F.col("group").alias("b"))
    pairs = pairs.union(across.join(members, "group").select(F.col("node").alias("a"), "b"))
    pairs = written(pairs.distinct(), "prefix-pairs")
    links = confirmed(pairs, _texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("node"))), k, percent)
    reps = nodes.select("digest", F.col("node").alias("rep"))
    same = same_id_links(named.select("doc_id", "digest"), reps)
    links = written(links.union(same), "prefix-links")
    labels = components(links)

    open_ = written(_unresolved(buckets, members, labels), "prefix-open")
    of_nodes = members.join(shared, "group").drop("group", "tokens")
    left = written(_promising(open_, of_nodes, percent), "prefix-left")
    hidden = written(compared_in_blocks(_sized(left), _texts(docs, left.select("node")), k, percent), "prefix-hidden")
    if hidden.head(1):
        labels = components(links.union(hidden))
    classes = labelled(reps, "rep", labels, "component_id").select("digest", "component_id")
    found = sets.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"))


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    return written(packed_texts(docs, nodes.distinct()), "prefix-texts")


def _shared(lists: DataFrame, buckets: DataFrame) -> DataFrame:
    """(group, size, length, last, tokens, codes, keys) of groups that meet others: the length
    of the prefix, its last shingle, all of it in order, whole and in short, and the group's
    buckets in order."""
    keys = buckets.groupBy("group").agg(F.sort_array(F.collect_list("bucket")).alias("keys"))
    rows = lists.dropDuplicates(["group", "prefix_id"]).select(
        "group",
        "size",
        F.size("prefix").alias("length"),
        F.element_at("prefix", -1).alias("last"),
        F.col("prefix").alias("tokens"),
        F.transform("prefix", _code).alias("codes"),
    )
    return rows.join(keys, "group")


def _code(token: Column) -> Column:
    """A token in 32 bits, in the same order: none comes before one it should come after, and
    those that are the same stay so."""
    middle = 1 << 31
    low = F.shiftright(token, 63 - RANK_BITS - 31) - middle
    return F.when(token < 1 << (63 - RANK_BITS), low).otherwise(F.shiftright(token, 32)).cast("int")


def _filtered(pairs: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups (group, b) that by their prefixes may hold similar sets. What two sets
    share stands in both prefixes up to the end of the one that ends first, or after it."""

    def of(name: str) -> DataFrame:
        return shared.select(F.col("group").alias(name), F.struct("size", "length", "last", "tokens").alias(f"of_{name}"))

    a, b = F.col("of_group"), F.col("of_b")

    def after(x: Column, y: Column) -> Column:
        """At least so many of x come later than the first end."""
        before = F.size(F.filter(x["tokens"], lambda t: t <= y["last"]))
        return x["size"] - F.when(x["last"] <= y["last"], x["length"]).otherwise(before)

    sizes = 100 * F.least(a["size"], b["size"]) >= percent * F.greatest(a["size"], b["size"])
    most = F.size(F.array_intersect(a["tokens"], b["tokens"])) + F.least(after(a, b), after(b, a))
    both = pairs.join(of("group"), "group").join(of("b"), "b")
    may = sizes & ((100 + percent) * most >= percent * (a["size"] + b["size"]))
    return both.where(may).select("group", "b").distinct()


def _unresolved(buckets: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, node, label) of buckets in which two nodes other than the centre,
    which all have been compared with, are in different components."""
    rows = buckets.join(members, "group").where("node != centre").select("bucket", "node")
    rows = labelled(rows.distinct(), "node", labels, "label")
    apart = (
        rows.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low != high")
    )
    return rows.join(apart.select("bucket"), "bucket")


def _sized(rows: DataFrame) -> DataFrame:
    """Rows with the number of blocks to cut their bucket into."""
    cuts = F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_SHINGLES)
    sizes = rows.groupBy("bucket").agg(F.ceil(cuts).cast("int").alias("blocks"))
    return rows.join(sizes, "bucket").select("bucket", "node", "label", "blocks")


KEY = ["bucket", "i", "j"]
ROW = ["node", "label", "size", "length", "last"]


def _promising(open_: DataFrame, of_nodes: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, label, size) of nodes that by their prefixes may match a node of another
    component. A pair is looked at in one bucket only, that of the first key it shares. A bucket is cut into blocks, and a task compares two of them."""
    blocks = open_.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    cut = open_.join(blocks, "bucket").withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    meeting = cut.select("*", other).withColumns(
        {"i": F.least("block", "other"), "j": F.greatest("block", "other")}
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of their key: those of one key at a time are held."""
        key, held = None, []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in KEY), strict=True)
            rows = zip(*(batch.column(c).to_pylist() for c in ROW), strict=True)
            codes, earlier = (_arrays(batch.column(c)) for c in ("codes", "earlier"))
            out = []
            for at, (now, row) in enumerate(zip(keys, rows, strict=True)):
                if now != key:
                    out += _may_link(key, held, percent)
                    key, held = now, []
                held.append((*row, codes[at], earlier[at]))
            yield _rows(out)
            give_memory_back()
        yield _rows(_may_link(key, held, percent))

    earlier = F.filter("keys", lambda k: k < F.col("bucket")).alias("earlier")
    rows = meeting.join(of_nodes, "node").select(*KEY, *ROW, "codes", earlier)
    rows = rows.repartition("bucket", "i", "j").sortWithinPartitions(*KEY)
    return rows.mapInArrow(each, "bucket long, node long, label long, size long").distinct()


def _arrays(lists: pa.ListArray) -> list[np.ndarray]:
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return np.split(np.array(lists.flatten(), np.int64), ends[1:-1]) if len(lists) else []


def _rows(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["bucket", "node", "label", "size"]
    )


def _may_link(key: tuple | None, held: list[tuple], percent: int) -> list[tuple]:
    """(bucket, node, label, size) of those that may match one of another label."""
    if len(held) < 2:
        return []
    bucket = key[0]
    _, label, size, length, last = np.array([h[:5] for h in held], np.int64).T
    codes, earlier = [h[5] for h in held], [h[6] for h in held]
    sizes = np.minimum.outer(size, size), np.maximum.outer(size, size)
    may = (label[:, None] != label[None, :]) & (100 * sizes[0] >= percent * sizes[1])
    if not may.any():
        return []
    may &= _common(earlier) == 0
    # Codes that are the same may be of two shingles: so no fewer count as shared, nor as later.
    ends = np.array([c[-1] for c in codes])
    before = np.stack([np.searchsorted(c, ends) for c in codes])
    after = size[:, None] - np.where(last[:, None] <= last[None, :], length[:, None], before)
    most = _common(codes) + np.minimum(after, after.T)
    may &= (100 + percent) * most >= percent * (size[:, None] + size[None, :])
    return [(bucket, *held[i][:3]) for i in np.flatnonzero(may.any(axis=1))]


def _common(prefixes: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two prefixes share."""
    owner = np.repeat(np.arange(len(prefixes)), [len(p) for p in prefixes])
    _, column, times = np.unique(np.concatenate(prefixes), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    _, column = np.unique(column[shared], return_inverse=True)
    row, total = owner[shared], np.zeros((len(prefixes), len(prefixes)), np.float32)
    for low in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        some = (column >= low) & (column < low + COLUMNS)
        table = np.zeros((len(prefixes), COLUMNS), np.float32)
        table[row[some], column[some] - low] = 1
        total += table @ table.T
    return np.rint(total).astype(np.int64)
