"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(b + sum w_i + sum <v_i, v_j>) over a text's distinct hashed terms: words, and their first letters, as
insults come inflected. The products of factors learn what pairs of terms say together, as an insult and a group
mention, which weights alone add up and miss.

Labels are learnt from a bounded sample of labelled rows: up to ``rows`` of each class, those with the smallest hashes
of their ids, weighted back to the classes' shares of all labelled rows. Terms of the same sampled rows, such as a word
and its beginnings, are one column. Columns are screened by their association with either class (a G statistic), and by
that of pairs: of any two columns, both that of the second among the rows of the first and the other way round must be
high, so that terms count that say nothing alone. The machine is fitted to the screened columns by Adam on full batches,
with fixed seeds. Null texts count as empty and get the score of the bias. Without labelled rows of both classes all scores are
next to 1 (only toxic labels) or 0. Rows with a null or repeated doc_id are scored like any other; null labels
are not learnt from, of a doc_id's repeated labels the largest counts, of its repeated rows one is learnt from (that of
the smallest list of hashed terms). A score of 0.5 counts as toxic. Very long texts are scored whole; an empty table gives
an empty one. Other columns are not read, so their names don't matter; drop_toxic() returns them.
"""

from __future__ import annotations

import itertools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrail.llm import tables
from studytrail.llm.words import SLICE, mixed, slices, words_of

ROWS = 5_000  # sampled rows of each class
PREFIXES = (3, 4, 5, 6, 7, 8)
TERMS = 1024  # screened columns at most
LEAST_G = 24.0  # twice the log-likelihood gained; chance alone gives about 2 * log(65,536 terms) = 22
PAIR_G = 48.0  # as LEAST_G, for pairs of 100,000 columns
SIDE = 1024  # columns of a block of pairs, one task
STEP = 256  # columns of a block that are unpacked at once
FACTORS = 8
FOLDS = 5


def held_out(folds: int = FOLDS):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))


def terms_of(texts: list[str | None]):
    """Sorted distinct 32-bit terms of each text."""
    for words in words_of(texts, PREFIXES):
        yield np.unique((words >> np.uint64(32)).astype(np.uint32))


@dataclass(frozen=True)
class Machine:
    bias: float
    terms: np.ndarray  # those of the screened columns, sorted
    weight: np.ndarray
    factor: np.ndarray

    def score(self, found: np.ndarray) -> float:
        at = places(self.terms, found)
        v = self.factor[at]
        total = v.sum(0)
        z = self.bias + self.weight[at].sum() + 0.5 * float(total @ total - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def places(known: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Where in the sorted known terms those of the found ones are that are known."""
    if not len(known):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
    return at[known[at] == found]


def constant(share: float) -> Machine:
    share = min(max(share, 1e-12), 1 - 1e-12)
    return Machine(float(np.log(share / (1 - share))), np.zeros(0, np.uint32), np.zeros(0), np.zeros((0, FACTORS)))


def fit(x: np.ndarray, y: np.ndarray, row_weight: np.ndarray, steps: int = 150, rate: float = 0.05, decay: float = 1e-5):
    """(bias, weights, factors) of a machine over 0/1 columns, by Adam on the weighted log loss."""
    n, d = x.shape
    share = row_weight / row_weight.sum()
    prior = float((share * y).sum())
    rng = np.random.default_rng(7)
    p = [np.array([np.log(prior / (1 - prior))]), np.zeros(d), rng.normal(0, 0.05, (d, FACTORS))]
    m, s = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for t in range(1, steps + 1):
        b, w, v = p
        grads = [np.zeros_like(a) for a in p]
        for at in range(0, n, 2000):
            part = x[at : at + 2000].astype(np.float32)
            xv = part @ v.astype(np.float32)
            z = b[0] + part @ w.astype(np.float32) + 0.5 * ((xv * xv).sum(1) - part @ (v * v).sum(1).astype(np.float32))
            e = (share[at : at + 2000] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at : at + 2000])).astype(np.float32)
            grads[0] += e.sum()
            grads[1] += part.T @ e
            grads[2] += part.T @ (e[:, None] * xv) - (part.T @ e)[:, None] * v
        grads[1] += decay * w
        grads[2] += decay * 10 * v
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.99 * s[k] + 0.01 * g * g
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-9)
    return float(p[0][0]), p[1], p[2]


def _xlogx(n):
    return F.when(n > 0, n * F.log(n)).otherwise(F.lit(0.0))


def association(n1: int, n0: int):
    """G statistic of columns with_1 and with_0, the rows of each class that have a term, of n1 and n0 rows."""
    a, b, n = F.col("with_1"), F.col("with_0"), n1 + n0
    cells = _xlogx(a) + _xlogx(b) + _xlogx(F.lit(n1) - a) + _xlogx(F.lit(n0) - b)
    return 2 * (cells - _xlogx(a + b) - _xlogx(F.lit(n) - a - b) - _xlogx(F.lit(n1)) - _xlogx(F.lit(n0)) + _xlogx(F.lit(n)))


def pair_scores(one: np.ndarray, two: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For 0/1 columns of two blocks: the lesser of the G statistics of either column among the rows of the other."""
    t = np.arange(len(y) + 1, dtype=np.float64)
    t[1:] *= np.log(t[1:])
    toxic = y == 1
    c1, c0 = ((one[rows].astype(np.float32).T @ two[rows].astype(np.float32)).astype(np.int32) for rows in (toxic, ~toxic))
    shared = t[c1] + t[c0] - t[c1 + c0]

    def among(w1, w0):
        return 2 * (shared + t[w1 - c1] + t[w0 - c0] - t[w1 + w0 - c1 - c0] + t[w1 + w0] - t[w1] - t[w0])

    w = [[x[rows].sum(0).astype(np.int32) for rows in (toxic, ~toxic)] for x in (one, two)]
    return np.minimum(among(w[0][0][:, None], w[0][1][:, None]), among(w[1][0][None, :], w[1][1][None, :]))


def column_blocks(data: DataFrame, tags: np.ndarray) -> DataFrame:
    """(block, bits): for each SIDE columns the sample's rows, in the order of tags, as packed and compressed bits."""

    def dealt(batches):
        for b in batches:
            out = []
            for tag, found in zip(b["tag"].to_pylist(), b["at"].to_pylist(), strict=True):
                at = np.frombuffer(found, np.int32)
                blocks, start = np.unique(at // SIDE, return_index=True)
                parts = np.split((at % SIDE).astype(np.int16), start[1:])
                out += [(k, tag, part.tobytes()) for k, part in zip(blocks.tolist(), parts, strict=False)]
            kinds = (pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=["block", "tag", "at"])

    def rows_of(batches):
        for b in batches:
            yield from zip(*(b[c].to_pylist() for c in ("block", "tag", "at")), strict=True)

    def packed(batches):
        for block, rows in itertools.groupby(rows_of(batches), lambda r: r[0]):
            bits = np.zeros((len(tags), SIDE), np.uint8)
            for _, tag, at in rows:
                bits[np.searchsorted(tags, tag), np.frombuffer(at, np.int16)] = 1
            bits = zlib.compress(np.packbits(bits, axis=1).tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits], pa.binary())], names=["block", "bits"])

    rows = data.mapInArrow(dealt, "block int, tag bigint, at binary").repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(packed, "block int, bits binary")


def pair_bests(spark, blocks: list[bytes], y: np.ndarray, columns: int) -> np.ndarray:
    """Highest pair score of each column, by tasks over pairs of blocks; they have the bits of column_blocks(), y the order of its tags."""
    pairs = [(i, j) for i in range(len(blocks)) for j in range(i, len(blocks))]

    def work(batches):
        bits = lambda k: np.frombuffer(zlib.decompress(blocks[k]), np.uint8).reshape(len(y), SIDE // 8)
        cut = lambda block, at: np.unpackbits(block[:, at // 8 : (at + STEP) // 8], axis=1)
        for b in batches:
            for i, j in (pairs[k] for k in b["id"].to_pylist()):
                one_bits, two_bits = bits(i), bits(j)
                best = np.zeros((2, SIDE))
                for k in range(0, SIDE, STEP):
                    one = cut(one_bits, k)
                    for m in range(0, SIDE, STEP):
                        g = pair_scores(one, cut(two_bits, m), y)
                        best[0, k : k + STEP] = np.maximum(best[0, k : k + STEP], g.max(1))
                        best[1, m : m + STEP] = np.maximum(best[1, m : m + STEP], g.max(0))
                best, at = best.ravel(), np.concatenate([i * SIDE + np.arange(SIDE), j * SIDE + np.arange(SIDE)])
                high = best > PAIR_G
                yield pa.RecordBatch.from_arrays([pa.array(at[high], pa.int64()), pa.array(best[high], pa.float64())], names=["at", "g"])

    found = spark.range(0, len(pairs), 1, max(1, len(pairs))).mapInArrow(work, "at bigint, g double")
    found = found.groupBy("at").agg(F.max("g").alias("g")).toArrow()
    out = np.zeros(columns)
    out[found["at"].to_numpy()] = found["g"].to_numpy()
    return out


def spread(columns: list[np.ndarray], bias: float, weight: np.ndarray, factor: np.ndarray) -> Machine:
    """The machine by terms: those of a column share its weight and factors, and give the same score together."""
    sizes = np.array([len(c) for c in columns], np.int64)
    weight = (weight - 0.5 * (factor * factor).sum(1) * (1 - 1 / np.maximum(sizes, 1))) / np.maximum(sizes, 1)
    terms = np.concatenate([*columns, np.zeros(0, np.uint32)]).astype(np.uint32)
    order = np.argsort(terms)
    of = np.repeat(np.arange(len(columns)), sizes)[order]
    return Machine(bias, terms[order], weight[of], (factor / np.maximum(sizes, 1)[:, None])[of])


def sampled(labels: DataFrame, rows: int, folds: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, y) of at most ``rows`` rows a class, and the number of labelled rows of each class."""
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("y"))
    known = known.where(~held_out(folds)).groupBy("doc_id").agg(F.max("y").alias("y"))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    return parts[0].unionByName(parts[1]), n


def _counted(batches):
    """(term, with_1, with_0, rows): a term's rows of each class in a part of the sample, and a hash of all its rows."""

    def batch(parts):
        terms, tags, ys = zip(*parts, strict=True)
        term, sizes = np.concatenate(terms), [len(t) for t in terms]
        order = np.argsort(term, kind="stable")
        term, at = np.unique(term[order], return_index=True)
        tag, y = np.repeat(np.array(tags, np.uint64), sizes)[order], np.repeat(np.array(ys, np.int64), sizes)[order]
        rows = np.bitwise_xor.reduceat(mixed(tag), at)
        cols = (term.astype(np.int64), np.add.reduceat(y, at), np.add.reduceat(1 - y, at), rows.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["term", "with_1", "with_0", "rows"])

    parts, held = [], 0
    for b in batches:
        for y, tag, found in zip(*(b[c].to_pylist() for c in ("y", "tag", "terms")), strict=True):
            if found:
                parts.append((np.frombuffer(found, np.uint32), tag + 1, y))
                held += len(parts[-1][0])
            if held > 1 << 20:
                yield batch(parts)
                parts, held = [], 0
    if parts:
        yield batch(parts)


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS, folds: int = FOLDS) -> Machine:
    sample, n = sampled(labels, rows, folds)
    if not n.get(0) or not n.get(1):
        return constant(1.0 if n.get(1) else 0.0)

    def featured(batches):
        for b in batches:
            for at, texts in slices(b["text"], SLICE):
                found = [t.tobytes() for t in terms_of(texts)]
                rows = slice(at, at + len(texts))
                yield pa.RecordBatch.from_arrays([b["doc_id"][rows], b["y"][rows], pa.array(found, pa.binary())], names=["doc_id", "y", "terms"])

    # the sample has 2 * rows rows of two numbers at most, so it may be broadcast
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(F.col("doc_id").cast("bigint"), "y", "text")
    # one row an id, so that repeated ids don't outgrow the sample's bound
    chosen = chosen.mapInArrow(featured, "doc_id bigint, y int, terms binary").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("terms").alias("terms"))
    chosen = chosen.select("y", "terms").withColumn("tag", F.monotonically_increasing_id())
    chosen = tables.stored(chosen, "sample")
    found = {r["y"]: r["n"] for r in chosen.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(found) < 2:
        return constant(n[1] / (n[0] + n[1]))
    counts = chosen.mapInArrow(_counted, "term bigint, with_1 bigint, with_0 bigint, rows bigint").groupBy("term")
    counts = counts.agg(F.sum("with_1").alias("with_1"), F.sum("with_0").alias("with_0"), F.bit_xor("rows").alias("rows"))
    total, split = F.col("with_1") + F.col("with_0"), _xlogx(F.col("with_1")) + _xlogx(F.col("with_0"))
    # no pair can gain more than its members' rows leave open
    counts = counts.select("*", association(found[1], found[0]).alias("g"), (2 * (_xlogx(total) - split)).alias("open"))
    columns = counts.where((F.col("g") > LEAST_G) | (F.col("open") > PAIR_G)).groupBy("with_1", "with_0", "rows")
    columns = columns.agg(F.max("g").alias("g"), F.sort_array(F.collect_list("term")).alias("terms")).toArrow()
    terms = columns["terms"].combine_chunks()
    members = np.split(terms.flatten().to_numpy().astype(np.uint32), np.cumsum(terms.value_lengths().to_numpy())[:-1]) if len(terms) else []
    order = np.argsort([m[0] for m in members]) if members else np.zeros(0, np.int64)
    members, single = [members[k] for k in order], columns["g"].to_numpy()[order]
    known = np.array([m[0] for m in members], np.uint32)
    del columns, terms

    def screened(batches):
        for b in batches:
            at = [places(known, np.frombuffer(t, np.uint32)).astype(np.int32).tobytes() for t in b["terms"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["y"], b["tag"], pa.array(at, pa.binary())], names=["y", "tag", "at"])

    # stored, as two Python functions in one stage take two workers a task, which executors then keep
    data = tables.stored(chosen.mapInArrow(screened, "y int, tag bigint, at binary"), "screened")
    g = single
    if len(known):
        rows_y = chosen.select("tag", "y").toArrow().sort_by("tag")  # 2 * rows rows
        blocks = column_blocks(data, rows_y["tag"].to_numpy()).toArrow().sort_by("block")["bits"].to_pylist()
        g = np.maximum(single, pair_bests(chosen.sparkSession, blocks, rows_y["y"].to_numpy(), len(known)))
        del blocks
    g[(single <= LEAST_G) & (g <= PAIR_G)] = 0
    best = np.argsort(-g, kind="stable")[:TERMS]
    best = np.sort(best[g[best] > 0])

    def picked(batches):
        for b in batches:
            at = [places(best, np.frombuffer(t, np.int32)).astype(np.int32).tobytes() for t in b["at"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["y"], pa.array(at, pa.binary())], names=["y", "at"])

    # only the chosen columns come to the driver; rows are in one order, so that sums round alike in every run
    data = data.orderBy("y", "at").mapInArrow(picked, "y int, at binary").toArrow()
    y = data["y"].to_numpy().astype(np.float64)
    x = np.zeros((len(y), len(best)), np.uint8, order="F")
    for i, at in enumerate(data["at"]):
        x[i, np.frombuffer(at.as_py(), np.int32)] = 1
    weight = np.where(y == 1, n[1] / found[1], n[0] / found[0])
    return spread([members[k] for k in best], *fit(x, y, weight))


def scored(docs: DataFrame, machine: Machine, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def work(batches):
        for b in batches:
            for at, texts in slices(b["text"], SLICE):
                s = np.array([machine.score(t) for t in terms_of(texts)])
                rows = slice(at, at + len(texts))
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"][rows], b["held_out"][rows], pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), held_out(folds).alias("held_out"), "text")
    return rows.mapInArrow(work, "doc_id bigint, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows whose score is below 0.5, with all their columns."""
    names = docs.columns

    def work(batches):
        for b in batches:
            keep = [machine.score(t) < 0.5 for _, texts in slices(b["text"], SLICE) for t in terms_of(texts)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema).select(*names)
