"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words: words at its ones are hashed, those at its zeros may differ. Seeds of
all benchmark and corpus texts are joined on their hash; around each hit the words are compared along the hit's
diagonal. A text is contaminated where a window of ``WINDOW`` words (the whole item, if it is shorter) agrees with
an item in ``SHARE`` of its words, in place: substitutions are tolerated, up to two in 13. The masks hit every such
window (tests/llm checks all patterns).

A Bloom filter of the benchmark's seeds, 4 to 32 MB by their number, lets most corpus positions go at once; those that
stay go to the join by hash with WINDOW words to either side. Benchmark seeds that come very often are spread by the
corpus side's salt. Beyond the filter's size more positions go to the join, with the same result.

In scripts without blanks a run of letters is no word. Texts and items with such letters are read in two ways: by words,
and by units, where each such letter is a word. Each reading of an item is compared with each reading of a text.

Items with fewer units than ``LEAST`` are too short for the masks and must occur whole, unit for unit. The runs of a
text with an item's length are hashed, filtered like seeds, joined on the hash and compared in full.

Null texts count as empty and are clean, items without any letter or digit match nothing; an empty table on either side
gives no overlaps. Repeated rows and ids are treated alike; rows without an id count as one document in judged(),
as rows of one id do, and by their text in clean_rows(). Very long texts are read in parts and handed on in bounded
batches. Other columns are not read, so their names don't matter; clean_rows() returns them.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrail.llm import tables
from studytrail.llm.words import BASE, SLICE, mixed, powers, slices, words_of

WINDOW, SHARE, LEAST = 13, 0.8, 8
MASKS = ("111011", "11010011", "11111")  # five words each
LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 25, 1 << 28, 1 << 10
ROWS = 20_000  # of a batch
SEEDS = "item_id bigint, hash bigint, item_at int, item_words binary"
HITS = "doc_id bigint, hash bigint, at int, context binary"
#: Letters of scripts without blanks: Thai, Lao, Burmese, Khmer, Tai, kana, Bopomofo, Chinese characters.
UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u3005-\u3007\u3040-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff])")
RUNS = "doc_id bigint, hash bigint, run binary"
WHOLE = "item_id bigint, hash bigint, run binary, n int"


def needed(length: int) -> int:
    """Words that must agree in a window of that length."""
    return int(np.ceil(SHARE * length - 1e-9))


def seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of every mask at every position of a text."""
    hashes, places = [], []
    for number, mask in enumerate(MASKS):
        n = len(words) - len(mask) + 1
        if n <= 0:
            continue
        h = np.full(n, np.uint64(number + 1))
        for k in (k for k, c in enumerate(mask) if c == "1"):
            h = h * np.uint64(BASE) + words[k : k + n]
        hashes.append(mixed(h))
        places.append(np.arange(n, dtype=np.int32))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    return np.concatenate(hashes), np.concatenate(places)


def _bits(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    return (h & np.uint64(size - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(size - 1)).astype(np.int64)


def passed(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter lets through."""
    one, two = _bits(h, 8 * len(bloom))
    return np.flatnonzero((bloom[one >> 3] >> (one & 7)) & (bloom[two >> 3] >> (two & 7)) & 1)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))


def _batches(rows, schema: str):
    """Record batches of at most ROWS of the rows of an iterator."""
    while part := list(itertools.islice(rows, ROWS)):
        yield _batch(part, schema)


def units_of(texts: list[str | None]):
    """Word hashes of each text, where every letter of a script without blanks is a word."""
    return words_of([UNSPACED.sub(r" \1 ", t) if t else t for t in texts])


def readings(texts: list[str | None]):
    """Of each text its word hashes and, where it has letters of scripts without blanks, its units."""
    unspaced = [bool(t) and not t.isascii() and UNSPACED.search(t) is not None for t in texts]
    units = units_of([t for t, u in zip(texts, unspaced, strict=True) if u])
    for words, also in zip(words_of(texts), unspaced, strict=True):
        yield [words, next(units)] if also else [words]


def overlap(item: np.ndarray, item_at: int, context: np.ndarray, at: int) -> int:
    """Most agreeing words of a window along the diagonal through item[item_at] and context[at]; 0 if too few."""
    length = min(WINDOW, len(item))
    first = max(0, item_at - at)
    last = min(len(item), item_at + len(context) - at)
    if last - first < length:
        return 0
    shift = at - item_at
    same = (item[first:last] == context[first + shift : last + shift]).astype(np.int32)
    total = np.concatenate(([0], np.cumsum(same)))
    most = int((total[length:] - total[:-length]).max())
    return most if most >= needed(length) else 0


def item_seeds(benchmark: DataFrame) -> DataFrame:
    """SEEDS rows: each seed with WINDOW words of its item to either side, or all of a shorter item."""

    def rows_of(ids, texts):
        for item, forms in zip(ids, readings(texts)):  # noqa: B905
            for words in forms:
                if len(words) < LEAST:
                    continue
                for h, p in zip(*seeds(words), strict=True):
                    # whether the item is shorter than a window shows in the context's length
                    lo, hi = (0, len(words)) if len(words) <= WINDOW else (max(0, p - WINDOW), p + 2 * WINDOW)
                    yield item, int(h.view(np.int64)), int(p - lo), words[lo:hi].tobytes()

    def work(batches):
        for b in batches:
            ids = b["item_id"].to_pylist()
            for at, texts in slices(b["text"], SLICE):
                yield from _batches(rows_of(ids[at:], texts), SEEDS)

    return benchmark.select(F.col("item_id").cast("bigint"), "text").mapInArrow(work, SEEDS)


def seed_filter(items: DataFrame) -> np.ndarray:
    """The Bloom filter as bytes, sized by the number of items: partitions send words of 64 bits that are not empty, added up
    before the driver sees them (MOST_BITS / 64 rows at most)."""
    size = LEAST_BITS
    wanted = BITS_EACH * items.count()
    while size < min(wanted, MOST_BITS):
        size *= 2

    def work(batches):
        filled = np.zeros(size // 8, np.uint8)
        for b in batches:
            h = b["hash"].to_numpy(zero_copy_only=False).view(np.uint64)
            for place in _bits(h, size):
                np.bitwise_or.at(filled, place >> 3, np.left_shift(1, place & 7).astype(np.uint8))
        words = filled.view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], names=["word", "bits"])

    found = items.select("hash").mapInArrow(work, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = found.toPandas()
    out = np.zeros(size // 64, np.int64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def _id_kind(docs: DataFrame) -> tuple[str, pa.DataType]:
    """The type of doc_id: binary (a hash of the text) stays, all others are numbers."""
    return ("binary", pa.binary()) if dict(docs.dtypes)["doc_id"] == "binary" else ("bigint", pa.int64())


def hits(docs: DataFrame, bloom: np.ndarray) -> DataFrame:
    """HITS rows: the corpus's seeds that the filter lets through, with the words around them."""
    name, _ = _id_kind(docs)
    schema = HITS.replace("bigint", name, 1)

    def rows_of(ids, texts):
        for doc, forms in zip(ids, readings(texts)):  # noqa: B905
            for words in forms:
                h, p = seeds(words)
                for k in passed(bloom, h):
                    lo = max(0, int(p[k]) - WINDOW)
                    yield doc, int(h[k].view(np.int64)), int(p[k]) - lo, words[lo : int(p[k]) + 2 * WINDOW].tobytes()

    def work(batches):
        for b in batches:
            ids = b["doc_id"].to_pylist()
            for at, texts in slices(b["text"], SLICE):
                yield from _batches(rows_of(ids[at:], texts), schema)

    return docs.select(F.col("doc_id").cast(name), "text").mapInArrow(work, schema)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_words): the best agreeing window of each document and item of LEAST units or more."""
    name, kind = _id_kind(docs)
    items = tables.stored(item_seeds(benchmark), "seeds")
    found = hits(docs, seed_filter(items))

    def verify(batches):
        for b in batches:
            out: dict[tuple, int] = {}
            columns = [b[c].to_pylist() for c in ("doc_id", "item_id", "item_at", "item_words", "at", "context")]
            for doc, item, item_at, item_words, at, context in zip(*columns, strict=True):
                n = overlap(np.frombuffer(item_words, np.uint64), item_at, np.frombuffer(context, np.uint64), at)
                if n:
                    out[doc, item] = max(n, out.get((doc, item), 0))
            keys = list(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], kind), pa.array([k[1] for k in keys], pa.int64()), pa.array(list(out.values()), pa.int32())],
                names=["doc_id", "item_id", "n_words"],
            )

    # the hits are salted on their own; each item seed goes to every salt, as benchmarks are the small side
    salts = 16
    found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "at"), F.lit(salts)).cast("int"))
    items = items.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    pairs = found.join(items, ["hash", "salt"]).drop("hash", "salt")
    checked = pairs.mapInArrow(verify, f"doc_id {name}, item_id bigint, n_words int")
    return checked.groupBy("doc_id", "item_id").agg(F.max("n_words").alias("n_words"))


class Runs:
    """Hashes of the runs of a text's words, of any length, from one pass over the text."""

    def __init__(self, words: np.ndarray):
        n = 1 << max(10, len(words).bit_length())
        up, self.down = powers(n)
        self.total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=self.total[1:])

    def of(self, n: int, at: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the runs of n words, at all places or at the given ones."""
        at = np.arange(max(0, len(self.total) - n)) if at is None else at
        return mixed((self.total[at + n] - self.total[at]) * self.down[at] + np.uint64(n * BASE % (1 << 64)))


def whole_items(benchmark: DataFrame) -> DataFrame:
    """WHOLE rows: items that must occur whole, with the hash of all their units."""

    def rows_of(ids, texts):
        for item, units in zip(ids, units_of(texts)):  # noqa: B905
            if 0 < len(units) < LEAST:
                yield item, int(Runs(units).of(len(units)).view(np.int64)[0]), units.tobytes(), len(units)

    def work(batches):
        for b in batches:
            ids = b["item_id"].to_pylist()
            for at, texts in slices(b["text"], SLICE):
                yield from _batches(rows_of(ids[at:], texts), WHOLE)

    return benchmark.select(F.col("item_id").cast("bigint"), "text").mapInArrow(work, WHOLE)


def whole_runs(docs: DataFrame, bloom: np.ndarray, lengths: list[int]) -> DataFrame:
    """RUNS rows: the corpus's runs of these lengths that the filter lets through, each once a document."""
    name, _ = _id_kind(docs)
    schema = RUNS.replace("bigint", name, 1)

    def rows_of(ids, texts):
        for doc, units in zip(ids, units_of(texts)):  # noqa: B905
            runs = Runs(units)
            for n in lengths:
                h = runs.of(n)
                places = passed(bloom, h)
                values, first = np.unique(h[places], return_index=True)
                for value, at in zip(values.view(np.int64), places[first], strict=True):
                    yield doc, int(value), units[at : at + n].tobytes()

    def work(batches):
        for b in batches:
            ids = b["doc_id"].to_pylist()
            for at, texts in slices(b["text"], SLICE):
                yield from _batches(rows_of(ids[at:], texts), schema)

    return docs.select(F.col("doc_id").cast(name), "text").mapInArrow(work, schema)


def all_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """As overlaps(), with the items that must occur whole; for these n_words is the number of all their units."""
    found = overlaps(docs, benchmark)
    items = tables.stored(whole_items(benchmark), "items")
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())  # below LEAST
    if not lengths:
        return found
    runs = whole_runs(docs, seed_filter(items), lengths)
    salts = 16  # as in overlaps(); an item of one word may be in most documents
    runs = runs.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    items = items.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    whole = runs.join(items, ["hash", "salt", "run"]).select("doc_id", "item_id", F.col("n").alias("n_words"))
    return found.unionByName(whole).groupBy("doc_id", "item_id").agg(F.max("n_words").alias("n_words"))


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_items and most_words of every contaminated document."""
    found = all_overlaps(docs, benchmark)
    return found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_items"), F.max("n_words").alias("most_words"))


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without any overlap, with all their columns, whatever their ids: rows are judged by their text's hash."""
    sha = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    found = all_overlaps(docs.select(sha.alias("doc_id"), "text"), benchmark)
    return _without(docs, found, sha)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Drops by doc_id and by overlaps() alone: not items that must occur whole, nor rows without an id."""
    return _without(docs, overlaps(docs, benchmark), F.col("doc_id"))


def _without(docs: DataFrame, found: DataFrame, key) -> DataFrame:
    """The rows whose key is not found; only those that may be found shuffle, copies of a text spread by their ids."""
    bad = tables.stored(found.select(F.col("doc_id").alias("_id")).distinct(), "contaminated")
    blocks = tables.blocks_for(bad.count())
    bits = tables.stored(tables.filter_of(bad, "_id", blocks), "bits")
    salts = 16
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")
    marked = tables.maybe(tables.packed(docs, key.alias("_key"), salt.alias("_salt")), "_key", bits, blocks)
    bad = bad.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    same = (F.col("_key") == F.col("_id")) & (F.col("_salt") == F.col("_part"))
    kept = marked.where("maybe").join(bad, same, "left_anti").select("row")
    return tables.unpacked(marked.where(~F.col("maybe")).select("row").unionByName(kept))


def uncovered_patterns() -> list[tuple[int, ...]]:
    """Windows of agreement, by places of their substitutions, that no mask hits; for the tests."""
    out = []
    for length in range(LEAST, WINDOW + 1):
        for wrong in itertools.combinations(range(length), length - needed(length)):
            if not any(
                all(m == "0" or at + k not in wrong for k, m in enumerate(mask))
                for mask in MASKS
                for at in range(length - len(mask) + 1)
            ):
                out.append((length, *wrong))
    return out
