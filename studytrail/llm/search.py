"""Ranked lexical search over a length-stratified index.

Documents with the same normaliser m, which comes from their length, are a stratum. Inside a block of a stratum postings
are in order of term and tf, so that what a posting adds to a score, its impact, is worked out once for each term and
tf. The highest impact of each term bounds what any document of the block can score for an item; an item visits
the blocks of a task from the highest bound down and stops where the bound is below the 50th score it holds. The best rows of
all tasks are ranked at the end.

The index is a frame with a row for each block. It holds the terms that the items ask for; items come in groups whose
terms fit a bound, so that what is sent to the tasks stays small whatever the number of items, and every group is searched over all
documents. The range of (m, hash of the id) cuts the index into partitions, so a length that many documents share is
spread over several.

Null texts and texts without a term are in no block and are not counted; items without a term find nothing. Rows with the
same item_id are one item with the terms of all; a null item_id is an item of its own. Documents with a null or a repeated doc_id are ranked
row by row, null after all others of the same score. Texts of any length are read as a whole, scores of 0 are left out,
other columns are ignored, an empty table on either side gives an empty result.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from studytrail.llm.tables import stored
from studytrail.llm.words import slices

#: bytes of a term for themselves, A-Z as a-z, everything else a blank (fixed value: what a term is made of)
TERM_BYTES = bytes(b if b >= 0x80 or 48 <= b < 58 or 97 <= b < 123 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
TOP = 50
BLOCK = 4096  # documents of a block
GROUP_TERMS = 1 << 17  # terms of a group of items; a single item may have more
PARTITION_ROWS, PARTITION_POSTINGS = 1 << 15, 1 << 22
BOUNDS = 1 << 20  # bounds of blocks by items that a task holds at once
POSTINGS = "doc_id bigint, n bigint, terms binary, tfs binary, held int"
INDEX = "m bigint, docs array<bigint>, terms binary, tfs binary, places binary, starts binary"
FOUND = "item_id bigint, doc_id bigint, score bigint"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): distinct terms of every item."""

    def work(batches):
        for b in batches:
            for at, texts in slices(b["text"]):
                rows = [(i.as_py(), sorted(set(terms_of(t)))) for i, t in zip(b["item_id"][at : at + len(texts)], texts, strict=True)]
                ids = pa.array([i for i, terms in rows for _ in terms], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array([t for _, terms in rows for t in terms], pa.binary())], names=["item_id", "term"])

    return items.select(F.col("item_id").cast("bigint"), "text").mapInArrow(work, "item_id bigint, term binary").distinct()


def item_groups(terms: DataFrame, most: int = GROUP_TERMS) -> DataFrame:
    """Adds ``part``: items in order of their ids, a new part whenever the next ``most`` terms are full."""
    sizes = terms.groupBy("item_id").agg(F.count(F.lit(1)).alias("size"))
    upto = F.sum("size").over(Window.orderBy("item_id"))
    parts = sizes.select(F.col("item_id").alias("_item"), F.floor(upto / F.lit(most)).alias("part"))
    return terms.join(parts, F.col("item_id").eqNullSafe(F.col("_item"))).drop("_item")


def postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs, held): length and the numbered terms of every document that has a term at all."""

    def work(batches):
        known = numbers.keys()
        for b in batches:
            for at, texts in slices(b["text"]):
                out = []
                for i, text in zip(b["doc_id"][at : at + len(texts)].to_pylist(), texts, strict=True):
                    tf = Counter(terms_of(text))
                    if not tf:
                        continue
                    held = tf.keys() & known
                    which = np.fromiter((numbers[t] for t in held), np.int32, len(held))
                    times = np.fromiter((tf[t] for t in held), np.int32, len(held))
                    order = np.argsort(which)
                    out.append((i, tf.total(), which[order].tobytes(), times[order].tobytes(), len(held)))
                columns = zip(*out, strict=True) if out else ([],) * 5
                types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n", "terms", "tfs", "held"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, POSTINGS)


def index(rows: DataFrame, n_docs: int, n_terms: int, n_postings: int) -> DataFrame:
    """Blocks of at most BLOCK documents with the same m, from rows of ``postings``."""
    m = F.lit(50) + F.expr(f"(50 * n * {n_docs}L) div {max(n_terms, 1)}L")
    parts = 1 + max(n_docs // PARTITION_ROWS, n_postings // PARTITION_POSTINGS)
    dealt = rows.where(F.col("held") > 0).select(m.alias("m"), "doc_id", "terms", "tfs", F.xxhash64("doc_id").alias("_h"))
    dealt = dealt.repartitionByRange(parts, "m", "_h").sortWithinPartitions("m", "_h", "doc_id").drop("_h")

    def work(batches):
        rows = (r for b in batches for r in zip(b["m"].to_pylist(), b["doc_id"].to_pylist(), b["terms"].to_pylist(), b["tfs"].to_pylist(), strict=True))
        for m, stratum in itertools.groupby(rows, lambda r: r[0]):
            while block := list(itertools.islice(stratum, BLOCK)):
                yield _block(m, block)

    return dealt.mapInArrow(work, INDEX)


def _block(m: int, rows: list) -> pa.RecordBatch:
    terms = np.frombuffer(b"".join(r[2] for r in rows), np.int32)
    tfs = np.frombuffer(b"".join(r[3] for r in rows), np.int32)
    places = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[2]) // 4 for r in rows])
    order = np.lexsort((tfs, terms))
    terms, tfs, places = terms[order], tfs[order], places[order]
    starts = np.flatnonzero(np.concatenate(([True], (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1])))).astype(np.int32)
    columns = (
        pa.array([m], pa.int64()), pa.array([[r[1] for r in rows]], pa.list_(pa.int64())),
        *(pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (terms[starts], tfs[starts], places, starts)),
    )
    return pa.RecordBatch.from_arrays(list(columns), names=["m", "docs", "terms", "tfs", "places", "starts"])


class Block:
    """A block with the impacts of its postings and the highest one of each term."""

    def __init__(self, row: dict, weights: np.ndarray):
        ints = lambda name: np.frombuffer(row[name], np.int32)
        self.docs = row["docs"]
        terms, tfs, self.places = ints("terms"), ints("tfs").astype(np.int64), ints("places")
        self.impacts = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * row["m"]))
        self.starts = np.append(ints("starts"), len(self.places))
        first = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1])))
        self.first = np.append(first, len(terms))  # runs of one tf, by term
        self.terms = terms[first]
        self.highest = np.maximum.reduceat(self.impacts, first)

    def bounds(self, size: int, terms: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """What any document can score at most, for every item."""
        highest = np.zeros(size, np.int64)
        highest[self.terms] = self.highest
        return np.add.reduceat(highest[terms], cuts)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Scores of all documents for the terms of one item; whole numbers below 2**53."""
        at = np.searchsorted(self.terms, terms)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == terms)]
        runs = _ranges(self.first[at], self.first[at + 1])
        lengths = self.starts[runs + 1] - self.starts[runs]
        places = self.places[_ranges(self.starts[runs], self.starts[runs + 1])]
        return np.bincount(places, np.repeat(self.impacts[runs], lengths), len(self.docs)).astype(np.int64)


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """start[0] .. end[0] - 1, start[1] .. end[1] - 1, and so on."""
    size = end - start
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


LAST = 1 << 63  # stands for a null id, after all others


class Best:
    """The best documents of one item so far: score down, id up."""

    def __init__(self, top: int):
        self.top, self.rows, self.least = top, [], 1

    def add(self, scores: np.ndarray, docs: list) -> None:
        found = np.flatnonzero(scores >= self.least)
        if len(found) > self.top:  # all that reach the score of the last that fits; equal ones go by id
            edge = np.partition(scores[found], len(found) - self.top)[len(found) - self.top]
            found = found[scores[found] >= edge]
        rows = [(-int(scores[i]), LAST if docs[i] is None else docs[i]) for i in found]
        self.rows = sorted(self.rows + rows)[: self.top]
        if len(self.rows) == self.top:
            self.least = -self.rows[-1][0]


def _found(item: int | None, best: Best) -> pa.RecordBatch:
    columns = ([item] * len(best.rows), [None if d == LAST else d for _, d in best.rows], [-s for s, _ in best.rows])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])


def best_of(blocks: DataFrame, items: dict[int | None, list[int]], weights: list[int], top: int = TOP) -> DataFrame:
    """(item_id, doc_id, score): of every partition of the index the best documents of each item."""

    def work(batches) -> Iterator[pa.RecordBatch]:
        w = np.array(weights, np.int64)
        ids = list(items)
        wanted = [np.array(items[i], np.int32) for i in ids]
        held = [Block(row, w) for b in batches for row in b.to_pylist()]
        if not held:
            return
        step = max(1, BOUNDS // len(held))
        for low in range(0, len(ids), step):
            some = wanted[low : low + step]
            flat, cuts = np.concatenate(some), np.cumsum([0, *map(len, some[:-1])])
            bounds = np.stack([block.bounds(len(w), flat, cuts) for block in held])
            for k, (item, terms) in enumerate(zip(ids[low : low + step], some, strict=True)):
                best = Best(top)
                for at in np.argsort(-bounds[:, k], kind="stable"):
                    if bounds[at, k] < best.least:
                        break
                    best.add(held[at].scores(terms), held[at].docs)
                if best.rows:
                    yield _found(item, best)

    return blocks.mapInArrow(work, FOUND)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item, best first, equal scores by doc_id."""
    spark = docs.sparkSession
    asked = stored(item_groups(item_terms(items)), "search-items")
    found = spark.createDataFrame([], FOUND)
    for (part,) in sorted(asked.select("part").distinct().collect()):
        found = found.unionByName(_search_group(docs, asked.where(F.col("part") == part), top))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _search_group(docs: DataFrame, asked: DataFrame, top: int) -> DataFrame:
    """Results of items whose terms are few enough to be sent to every task."""
    items: dict[int | None, list[int]] = {}
    numbers: dict[bytes, int] = {}
    for item, term in asked.select("item_id", "term").collect():
        items.setdefault(item, []).append(numbers.setdefault(bytes(term), len(numbers)))
    items = {i: sorted(t) for i, t in items.items()}
    rows = stored(postings(docs, numbers), "search-postings")
    total = rows.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.col("held").cast("bigint"))).first()
    n_docs, n_terms, n_postings = (int(x or 0) for x in total)
    weight = F.floor(F.lit(1000) * F.log((F.lit(2.0) * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1)))
    counted = _frequencies(rows).groupBy("term").agg(F.sum("df").alias("df")).select("term", weight.cast("bigint"))
    weights = [0] * len(numbers)
    for term, w in counted.collect():
        weights[term] = w
    blocks = stored(index(rows, n_docs, n_terms, n_postings), "search-index")
    return best_of(blocks, items, weights, top)


def _frequencies(rows: DataFrame) -> DataFrame:
    """(term, df): documents of each term, counted inside the tasks first."""

    def work(batches):
        df: Counter = Counter()
        for b in batches:
            for row in b["terms"]:
                df.update(np.frombuffer(row.as_buffer(), np.int32).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(df.keys(), pa.int32()), pa.array(df.values(), pa.int64())], names=["term", "df"])

    return rows.select("terms").mapInArrow(work, "term int, df bigint")
