"""N-gram Jaccard join by a MinHash LSH forest, verified exactly.

A document is the set of its runs of five words; two are linked if their sets' Jaccard similarity is 0.8 or more. Texts
with the same set are one class, worked on once. Signatures are cut into trees; a tree is the trie of its signatures'
prefixes, and documents under one node share a prefix. The join starts at the longest prefixes: members of a node whose
signatures agree well with the node's first or last member form rough groups. Then prefixes are shortened until
the chance that a pair of similarity 0.8 shares a node of some tree reaches the target recall; there only members of
different rough groups are compared, by signature inside the join.

All that is found is verified with the whole sets: rough groups in blocks of bounded size, each block against each, as
a product of 0/1 matrices inside a task that returns counts and a spanning forest, never the pairs; the few pairs across
groups one by one. So no list of all pairs of a group exists, however large it is, and no link within it is lost.

Null texts count as empty; documents without a word have no links and a class of their own. A text of fewer than five
words is one run. Rows are told apart by their sets, not ids: repeated rows and ids are copies like others, and of
several rows the class gets the smallest id (null only if all are null). An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studytrail.llm import tables
from studytrail.llm.components import components
from studytrail.llm.words import SLICE, shingles, slices, words_of
from studytrail.session import bounded_batches

WORDS, SIMILAR = 5, 0.8
TREES, DEPTH = 20, 6
RECALL = 0.9999
ROUGH = 0.6  # agreement of signatures in a rough group, and of pairs across groups: over five deviations below SIMILAR
BLOCK = 512  # documents of a block of a rough group
STRIP = 64  # rows of a block's matrix that are worked on at once


def recall(prefix: int, similar: float = SIMILAR) -> float:
    """Chance that a pair of that similarity shares a prefix of that length in some tree."""
    return 1 - (1 - similar**prefix) ** TREES


def shortest_prefix(target: float = RECALL) -> int:
    return next(k for k in range(DEPTH, 0, -1) if recall(k) >= target or k == 1)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    n = TREES * DEPTH
    return rng.integers(0, 1 << 32, n, np.uint32), rng.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, TREES * DEPTH) minima of keyed 32-bit hashes; no set may be empty."""
    xor, times = _functions()
    out = np.empty((len(sets), len(xor)), np.uint32)
    at = 0
    while at < len(sets):  # some sets at a time, so that they stay in the processor's cache
        to, size = at, 0
        while to < len(sets) and (to == at or size + len(sets[to]) <= 1 << 15):
            size += len(sets[to])
            to += 1
        flat = (np.concatenate(sets[at:to]) >> np.uint64(32)).astype(np.uint32)
        start = np.cumsum([0, *(len(s) for s in sets[at : to - 1])])
        for k in range(len(xor)):
            h = flat ^ xor[k]
            h *= times[k]
            h ^= h >> np.uint32(16)
            h *= np.uint32(0x85EBCA6B)
            out[at:to, k] = np.minimum.reduceat(h, start)
        at = to
    return out


def set_key(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, key of its set (null without words), size of the set, and signature (null for repeats within a batch)."""

    def work(batches):
        for b in batches:
            for at, texts in slices(b["text"], SLICE):
                sets = [shingles(w, WORDS) for w in words_of(texts)]
                keys = [set_key(s) for s in sets]
                full = [i for i, s in enumerate(sets) if len(s)]
                flat = signatures([sets[i] for i in full]).view(np.int32).ravel() if full else np.zeros(0, np.int32)
                width = np.zeros(len(sets) + 1, np.int32)
                width[[i + 1 for i in full]] = TREES * DEPTH
                sig = pa.ListArray.from_arrays(pa.array(np.cumsum(width, dtype=np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"][at : at + len(texts)], pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int32()), sig],
                    names=["doc_id", "key", "n", "sig"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(work, "doc_id bigint, key binary, n int, sig array<int>")


def _sets(docs: DataFrame) -> DataFrame:
    """key and set of every row with words."""

    def work(batches):
        for b in batches:
            for _, texts in slices(b["text"], SLICE):
                sets = [s for s in (shingles(w, WORDS) for w in words_of(texts)) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "shingles"])

    return docs.select("text").mapInArrow(work, "key binary, shingles binary")


def _nodes(classes: DataFrame, prefix: int, *columns: str) -> DataFrame:
    """A row for each class and tree: the trie's node at that depth."""
    nodes = F.array(*(F.xxhash64(F.lit(t), F.slice("sig", t * DEPTH + 1, prefix)) for t in range(TREES)))
    return classes.select(*columns, F.explode(nodes).alias("node"))


def _agreement(a: str, b: str):
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda total, x: total + x) / F.lit(TREES * DEPTH)


def _shared(nodes: DataFrame, member: str, store) -> DataFrame:
    """(node, other columns, lo, hi) of the nodes with several members; a Bloom filter spares the others a second shuffle."""
    shared = nodes.groupBy("node").agg(F.min(member).alias("lo"), F.max(member).alias("hi")).where("lo <> hi")
    shared = store(shared, "nodes")
    return tables.among(nodes, "node", shared, store).where("maybe").drop("maybe").join(shared, "node")


def _only(classes: DataFrame, wanted: DataFrame, store) -> DataFrame:
    """Classes that may be among the wanted short keys; a Bloom filter spares the others the shuffle of their signatures."""
    return tables.among(classes, "short", wanted, store).where("maybe").drop("maybe")


def rough_groups(classes: DataFrame, store=tables.stored) -> DataFrame:
    """(key, comp) of classes that share a longest prefix and agree with the node's first or last member."""
    with tables.Scratch(classes.sparkSession) as scratch:
        members = _shared(_nodes(classes, DEPTH, "short"), "short", scratch.stored)
        members = members.select("short", F.explode(F.array("lo", "hi")).alias("other")).where("short <> other").distinct()
        members = scratch.stored(members, "members")
        few = _only(classes, members.select("short").union(members.select("other")), scratch.stored).select("short", "key", "sig")
        star = few.select(F.col("short").alias("other"), F.col("key").alias("star"), F.col("sig").alias("star_sig"))
        pairs = members.join(few, "short").join(star, "other").where(_agreement("sig", "star_sig") >= ROUGH)
        return components(pairs.select(F.col("key").alias("a"), F.col("star").alias("b")), store)


def grouped_classes(classes: DataFrame, rough: DataFrame, store=tables.stored) -> DataFrame:
    """Classes with the comp of their rough group, else their own key; only those in the rough groups' filter shuffle."""
    marked = tables.among(classes, "key", rough, store)
    inside = marked.where("maybe").join(rough, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    return inside.unionByName(marked.where("NOT maybe").withColumn("comp", F.col("key"))).drop("maybe")


def pairs_across(classes: DataFrame, prefix: int, store=tables.stored) -> DataFrame:
    """(a, b) of different rough groups that share a prefix in some tree and agree by size and signature."""
    with tables.Scratch(classes.sparkSession) as scratch:
        nodes = _nodes(classes, prefix, "short", F.xxhash64("comp").alias("group"))
        members = scratch.stored(_shared(nodes, "group", scratch.stored).select("node", "short"), "mixed")
        members = members.join(_only(classes, members, scratch.stored).select("short", "key", "comp", "n", "sig"), "short")
        a, b = (members.select("node", *(F.col(c).alias(f"{c}_{side}") for c in ("key", "comp", "n", "sig"))) for side in "ab")
        close = (F.col("n_a") >= SIMILAR * F.col("n_b")) & (F.col("n_b") >= SIMILAR * F.col("n_a"))
        found = a.join(b, (a["node"] == b["node"]) & (F.col("comp_a") < F.col("comp_b")) & close & (_agreement("sig_a", "sig_b") >= ROUGH))
        return store(found.select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct(), "across")


def similar(inter: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    out = np.empty(inter.shape, bool)
    for at in range(0, len(inter), STRIP):
        part = inter[at : at + STRIP]
        union = sizes_a[at : at + STRIP, None] + sizes_b[None, :] - part
        out[at : at + STRIP] = part >= SIMILAR * union - 1e-9
    return out


def least_neighbours(linked: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Smallest label of each member's neighbours; the number of members where there are none."""
    strips = (linked[at : at + STRIP] for at in range(0, len(label), STRIP))
    return np.concatenate([np.where(s, label[None, :], len(label)).min(1, initial=len(label)) for s in strips])


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: a product of 0/1 matrices over the shingles that two sets or more have."""
    n = len(sets)
    term, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    place = np.cumsum(count > 1) - 1
    shared = count[inverse] > 1
    row, column = row[shared], place[inverse[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out, width = np.zeros((n, n), np.float32), 1024
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, (at, at + width))
        part = np.zeros((n, min(width, int(column[-1]) + 1 - at)), np.float32)
        part[row[lo:hi], column[lo:hi] - at] = 1
        out += part @ part.T
    return out


def block_links(keys: list[bytes], sets: list[np.ndarray], weight: np.ndarray, side: np.ndarray, across: bool):
    """(links, label) of each member: linked documents of other members, and a member that names its component."""
    sizes = np.array([len(s) for s in sets], np.float64)
    linked = similar(intersections(sets), sizes, sizes)
    np.fill_diagonal(linked, False)
    if across:
        linked &= side[:, None] != side[None, :]
    links = linked @ weight
    label = np.arange(len(keys))
    while True:  # smallest label of the neighbours, until nothing changes
        new = np.minimum(label, least_neighbours(linked, label))
        new = new[new]
        if (new == label).all():
            return links, [keys[i] for i in label]
        label = new


def grouped_links(members: DataFrame) -> DataFrame:
    """members: comp, key, size, block, blocks, shingles. (key, links, label) for every block against every block."""

    def blocks_of(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):  # sets are large, so few at a time
                part = b.slice(at, 256)
                columns = [part[c].to_pylist() for c in ("comp", "lo", "hi", "key", "size", "block", "shingles")]
                yield from zip(*columns, strict=True)

    def work(batches):
        out = []
        for (_, lo, hi), rows in itertools.groupby(blocks_of(batches), lambda r: r[:3]):
            own = {r[3]: r for r in rows}  # copies come once
            if len(own) < 2:
                continue
            keys = sorted(own)
            sets = [np.frombuffer(own[k][6], np.uint64) for k in keys]
            weight = np.array([own[k][4] for k in keys], np.int64)
            side = np.array([own[k][5] for k in keys])
            links, label = block_links(keys, sets, weight, side, lo != hi)
            out += zip(keys, links.tolist(), label, strict=True)
            if len(out) > 10_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    def _batch(rows):
        kinds = (pa.binary(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["key", "links", "label"])

    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = members.select("comp", "key", "size", "block", "shingles", other)
    dealt = dealt.select("comp", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "key", "size", "block", "shingles")
    dealt = dealt.repartition("comp", "lo", "hi").sortWithinPartitions("comp", "lo", "hi")
    return dealt.mapInArrow(work, "key binary, links bigint, label binary")


def joined(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sketches, classes): doc_id and key of every row; key, rep_id, size, links and class_id of every set."""
    bounded_batches(docs.sparkSession)
    with tables.Scratch(docs.sparkSession) as scratch:
        found = scratch.stored(sketched(docs), "sketches")
        classes = found.where("key IS NOT NULL").groupBy("key").agg(
            F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("size"), F.first("n").alias("n"), F.first("sig").alias("sig")
        )
        # nodes carry a short form of the key; two keys with the same one only add candidates
        classes = scratch.stored(classes.withColumn("short", F.xxhash64("key")), "classes")
        sketches = tables.stored(found.select("doc_id", "key"), "sketches")
        return sketches, _named(docs, classes, scratch.stored)


def _named(docs: DataFrame, classes: DataFrame, store) -> DataFrame:
    rough = rough_groups(classes, store)
    across = pairs_across(grouped_classes(classes, rough, store), shortest_prefix(), store)

    # whole sets of the classes that have anything to be compared with; Bloom filters let the other texts go
    sizes = rough.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    wanted = store(rough.select("key").union(across.select("a")).union(across.select("b")).distinct(), "wanted")
    ids = store(classes.select("key", F.col("rep_id").alias("doc_id")).join(wanted, "key").select("doc_id"), "ids")
    chosen = tables.among(docs.select(F.col("doc_id").cast("bigint"), "text"), "doc_id", ids, store).where("maybe")
    sets = store(tables.among(_sets(chosen), "key", wanted, store).where("maybe").drop("maybe"), "sets")

    members = rough.join(sizes, "comp").join(classes.select("key", "size"), "key")
    members = members.withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    inside = store(grouped_links(members.join(sets, "key")), "inside")
    across = store(_verified(across, sets), "links")

    weight = classes.select(F.col("key").alias("b"), F.col("size").alias("links"))
    both = across.unionByName(across.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = inside.select("key", "links").unionByName(both.join(weight, "b").select(F.col("a").alias("key"), "links"))
    links = links.groupBy("key").agg(F.sum("links").alias("links"))
    edges = inside.select(F.col("key").alias("a"), F.col("label").alias("b")).unionByName(across)
    final = classes.join(components(edges, store), "key", "left").join(links, "key", "left")
    final = final.select("key", "rep_id", "size", F.coalesce("comp", "key").alias("comp"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"))
    final = store(final, "final")
    names = final.groupBy("comp").agg(F.min("rep_id").alias("class_id"), F.sum("size").alias("class_size"))
    return tables.stored(final.join(names, "comp"), "named")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    def work(batches):
        for b in batches:
            keep = []
            for x, y in zip(b["x"], b["y"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                inter = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(inter >= SIMILAR * (len(x) + len(y) - inter) - 1e-9)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one, two = (sets.select(F.col("key").alias(k), F.col("shingles").alias(s)) for k, s in (("a", "x"), ("b", "y")))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(work, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest id of its group of linked documents), n_links, rep_id (of its equal sets), class_size."""
    sketches, named = joined(docs)
    total = sketches.count()
    groups = named.select("key", F.col("size").alias("n"), "class_id", "links", "rep_id", "class_size")
    rows = sketches.where("key IS NOT NULL").select("doc_id", F.hex("key").alias("key"))
    found = tables.with_group(rows, groups.withColumn("key", F.hex("key")), "key", "doc_id", total)
    found = found.select("doc_id", "class_id", F.col("links").alias("n_links"), "rep_id", "class_size")
    empty = sketches.where("key IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), F.col("doc_id").alias("rep_id"), F.lit(1).cast("bigint").alias("class_size")
    )
    return found.unionByName(empty)


def _with_key(rows: DataFrame) -> DataFrame:
    """row, doc_id and key of packed rows."""

    def work(batches):
        for b in batches:
            keys = [set_key(shingles(w, WORDS)) for _, texts in slices(b["text"], SLICE) for w in words_of(texts)]
            yield pa.RecordBatch.from_arrays([b["row"], b["doc_id"], pa.array(keys, pa.binary())], names=["row", "doc_id", "key"])

    schema = T.StructType([rows.schema["row"], T.StructField("doc_id", T.LongType()), T.StructField("key", T.BinaryType())])
    return rows.select("row", F.col("doc_id").cast("bigint"), "text").mapInArrow(work, schema)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group, the one with the smallest id, and all rows of no group, with all their columns."""
    sketches, named = joined(docs)
    groups = tables.stored(named.where("class_size > 1").select("key", "comp", "class_id"), "groups")
    ids = tables.stored(sketches.join(groups.select("key"), "key", "left_semi").select("doc_id"), "ids")
    blocks = tables.blocks_for(ids.count())
    bits = tables.stored(tables.filter_of(ids, "doc_id", blocks), "bits")
    rows = tables.packed(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marked = tables.maybe(rows, "doc_id", bits, blocks)
    found = tables.stored(_with_key(marked.where("maybe")).join(groups, "key", "left"), "grouped")
    first = found.where(F.col("comp").isNotNull() & F.col("doc_id").eqNullSafe(F.col("class_id"))).select("comp", "row").dropDuplicates(["comp"])
    out = marked.where(~F.col("maybe")).select("row").unionByName(found.where("comp IS NULL").select("row"))
    return tables.unpacked(out.unionByName(first.select("row")))
