"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

A is a byte-level BPE file of the ``tokenizers`` library over a blank and the text, B a ``sentencepiece`` model over the
text, which adds the blank itself. Character offsets of A and spans of B's result message (the library's ``proto``, which
took the place of its immutable one) give coarse cuts; tokens inside one character, and byte fallback, whose spans cover
a whole character or nothing, are cut by the number of their decoded bytes. Both must join to the bytes of
the text, else the text has no tokens.

Neither tokenizer joins anything across the border between a word and a blank, nor across the one between a letter or digit and
a mark (a comma, say) or a line's end, which is proven from both vocabularies when they are read; where the second does not hold,
texts are cut at blanks alone, and where the first does not, they are encoded whole. So a text is a row of chunks (blanks and a word,
or what follows it), and each distinct chunk of a block of texts is encoded and aligned once. Of a block are stored its texts by chunk
number, links by chunk and link counts, in rows of one text or up to ``PART`` numbers. Counts are added up over the corpus by id pair, and
go back to the blocks that hold the pair, where they meet links and texts in this order.

Null and empty texts, and texts whose joined bytes differ (a literal U+2581 for example), have no tokens and all figures are 0.
Rows with null or repeated ids are aligned like all others, and repeated texts count as often as they are there. A text of any length is
one text; other columns are ignored; an empty table gives an empty one. Equal counts of a B id are all its highest.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import operator
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from studytrail.llm.bpe import SPACE, byte_letters
from studytrail.llm.tables import stored
from studytrail.llm.words import points
from studytrail.session import bounded_batches

OTHER = SPACE.replace(" ", "", 1)  # white space but for the blank
CHUNK = re.compile(rf"[{SPACE}]*[^{SPACE}]+(?:[{OTHER}][{SPACE}]*[^{SPACE}]+)*(?:[{OTHER}][{SPACE}]*\Z)?|[{SPACE}]+")
LETTER = "0-9A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ώЀ-ҁҊ-ӿ"  # letters and digits in every version of Unicode in use
AFTER = r"!-/:-@\[-`{-~\n"  # never in one pre-token of A with a letter or digit before it
PARTS = re.compile(
    rf"[{SPACE}]*+(?:(?:[^{SPACE}{LETTER}]++|[{LETTER}]++(?![{AFTER}])|[{OTHER}][{SPACE}]*+)+[{LETTER}]*|[{LETTER}]+)|[{SPACE}]+"
)
WHOLE = re.compile(r"(?s).+")
MARK = "▁"  # a blank in B's pieces
BLOCK = 6 << 20  # bytes of texts that are aligned together
LONG = 1 << 20  # code points of a text that is cut lazily
BATCH = 1 << 12  # chunks encoded at once
KEPT = 300_000  # distinct chunks after which a worker lets go of those that came once
PART = 1 << 15  # pairs, or chunks with their links, in one row of a block
PAIRS, TYPES, TEXTS = range(3)  # kinds of rows, as they are read
BLOCKS = (
    "block bigint, kind int, place int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, sha string, chunks binary, "
    "type_links binary, links binary, pairs array<bigint>, counts array<bigint>"
)
ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
COLUMNS = {name: ARROW[kind] for name, kind in (c.split() for c in BLOCKS.split(","))}
RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


class Pair:
    """Both tokenizers with the bytes of every token."""

    def __init__(self, a: str, b: str):
        with open(a, encoding="utf-8") as f:
            data = json.load(f)
        letters = byte_letters()
        names, special = data["model"]["vocab"], {t["content"] for t in data["added_tokens"]}
        names = {n: i for n, i in names.items()} | {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.bytes_a[i] = name.encode() if name in special else bytes(letters[c] for c in name)
        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        before = data.get("pre_tokenizer") or {}
        byte_level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and data.get("normalizer") is None
        inner = re.compile(rf"[^{SPACE}{MARK}]{MARK}")
        self.chunk = CHUNK if byte_level and not any(inner.search(p) for p in pieces) else WHOLE
        joint, named = re.compile(rf"[{LETTER}][{AFTER}]"), (self.b.is_byte, self.b.is_control, self.b.is_unknown)
        if self.chunk is CHUNK and not any(joint.search(p) and not any(f(i) for f in named) for i, p in enumerate(pieces)):
            self.chunk = PARTS
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # ids of A, then of B, each with what follows it in a group, and as the last of its side
        self.written = [f"{i}{mark}" for n, last in ((len(self.bytes_a), "|"), (len(self.bytes_b), ";")) for i in range(n) for mark in (",", last)]

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """(ids of A, their byte ends, ids of B, their byte ends, bytes before each code point) of a text with a blank
        in front, or None if either does not give the text's bytes."""
        raw, cp = text.encode(), points(text)
        at = np.zeros(len(cp) + 1, np.int64)
        np.cumsum(1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000), out=at[1:])
        coded = self.a.encode(text, add_special_tokens=False)
        ids_a = coded.ids
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != raw:
            return None
        pieces = list(self.b.encode(text[1:], return_type="proto").pieces)
        ids_b = [p.id for p in pieces]
        if b"".join(map(self.bytes_b.__getitem__, ids_b)) != raw:
            return None
        offsets = at[np.fromiter(itertools.chain.from_iterable(coded.offsets), np.int64, 2 * len(ids_a)).reshape(-1, 2)]
        ids_a, ids_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        begin, end = (np.fromiter(map(operator.attrgetter(x), pieces), np.int64, len(pieces)) + 1 for x in ("begin", "end"))
        begin[:1] = 0
        return ids_a, refined(offsets[:, 0], offsets[:, 1], self.len_a[ids_a]), ids_b, refined(begin, end, self.len_b[ids_b]), at

    def records(self, chunks: list[str]) -> list[tuple | None]:
        """(n_a, n_b, n_groups, groups, link codes) of each chunk of texts with a blank in front. None: no tokens."""
        if self.chunk is WHOLE:
            return [r for c in chunks for r in self._joined("", [c])]
        # white space at the end would join the next chunk's, and a literal mark is a blank to B
        alone = [MARK in c or c[-1].isspace() for c in chunks]
        joined = [c for c, one in zip(chunks, alone, strict=True) if not one]
        found = iter(self._joined(" a", joined) if joined else ())
        return [(None if MARK in c else self._joined(" a", [c])[0]) if one else next(found) for c, one in zip(chunks, alone, strict=True)]

    def _joined(self, first: str, chunks: list[str]) -> list[tuple | None]:
        """Records of chunks encoded in a row after ``first``; one by one if they cannot be told apart."""
        row, places = [], []
        for c in chunks:
            if first and c[0] != " ":  # stands after a letter or digit
                row.append(first)
            places.append(len(row))
            row.append(c)
        found = self.spans(first + "".join(row))
        if found is not None:
            ids_a, ends_a, ids_b, ends_b, at = found
            ends = at[np.cumsum([len(first), *map(len, row)])]
            borders = ends if first else ends[1:]
            if np.isin(borders, ends_a).all() and np.isin(borders, ends_b).all():
                return self._records(ids_a, ends_a, ids_b, ends_b, ends, places)
        if len(chunks) == 1:
            return [None]
        return [r for c in chunks for r in self._joined(first, [c])]

    def _records(self, ids_a, ends_a, ids_b, ends_b, ends, places: list[int]) -> list[tuple]:
        """Records of the chunks at these places, of all between the ends."""
        cuts = np.union1d(ends_a, ends_b)  # between two neighbouring cuts lies one token of each
        codes = ids_a[np.searchsorted(ends_a, cuts)] * len(self.bytes_b) + ids_b[np.searchsorted(ends_b, cuts)]
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        upto_a, upto_b = (np.append(0, np.searchsorted(x, common, "right")) for x in (ends_a, ends_b))
        group_a, group_b = (np.searchsorted(common, x) for x in (ends_a, ends_b))
        written = np.empty(len(ids_a) + len(ids_b), np.int64)  # of each group A's tokens, then B's
        written[np.arange(len(ids_a)) + upto_b[group_a]] = 2 * ids_a + (ends_a == common[group_a])
        written[np.arange(len(ids_b)) + upto_a[group_b + 1]] = 2 * (ids_b + len(self.bytes_a)) + (ends_b == common[group_b])
        written = list(map(self.written.__getitem__, written.tolist()))
        a, b, g, c = (np.searchsorted(x, ends, "right").tolist() for x in (ends_a, ends_b, common, cuts))
        out = []
        for i in places:
            a0, a1, b0, b1 = a[i], a[i + 1], b[i], b[i + 1]
            out.append((a1 - a0, b1 - b0, g[i + 1] - g[i], "".join(written[a0 + b0 : a1 + b1])[:-1], codes[c[i] : c[i + 1]]))
        return out


def refined(start: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: where a coarse span has as many bytes as the token it is the token's, from there on the sizes of
    the following tokens count up to the next such span."""
    total = np.cumsum(size)
    sure = np.maximum.accumulate(np.where(end - start == size, np.arange(len(size)), -1))
    return total + np.where(sure >= 0, end[sure] - total[sure], 0)


class Chunks(dict):
    """Numbers of distinct chunks and what is known of them; new ones are aligned in batches."""

    def __init__(self, pair: Pair):
        super().__init__()
        self.pair, self.new = pair, []
        self.figures, self.groups, self.codes = array("q"), [], array("q")
        self.uses = np.zeros(0, np.int64)

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number

    def numbers(self, text: str) -> np.ndarray:
        """The text's chunks by number."""
        cut = self.pair.chunk
        if len(text) <= LONG:
            return np.array(list(map(self.__getitem__, cut.findall(" " + text))), np.int64)
        out, found = array("q"), (m.group() for m in cut.finditer(" " + text))
        while part := list(itertools.islice(found, 1 << 16)):
            out.extend(map(self.__getitem__, part))
            self.align()
        return np.frombuffer(out, np.int64)

    def align(self) -> None:
        for i in range(0, len(self.new), BATCH):
            records = [r or NO_TOKENS for r in self.pair.records(self.new[i : i + BATCH])]
            self.figures.extend(itertools.chain.from_iterable((*r[:3], len(r[4])) for r in records))
            self.groups.extend(r[3] for r in records)
            self.codes.frombytes(np.concatenate([r[4] for r in records]).tobytes())
        self.new = []

    def links(self, numbers: np.ndarray) -> np.ndarray:
        """Link codes of these chunks, one after the other."""
        sizes = np.frombuffer(self.figures, np.int64)[3::4]
        starts, sizes = (np.cumsum(sizes) - sizes)[numbers], sizes[numbers]
        return np.frombuffer(self.codes, np.int64)[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]

    def used(self, times: np.ndarray) -> None:
        """Add how often each chunk came in a block."""
        times[: len(self.uses)] += self.uses
        self.uses = times

    def again(self) -> Chunks:
        """Of the chunks those that came more than once; none, if that is most of them."""
        out = Chunks(self.pair)
        if 2 * np.count_nonzero(self.uses > 1) > KEPT:
            return out
        kept = np.flatnonzero(self.uses > 1)
        for number, chunk in enumerate(itertools.compress(self, (self.uses > 1).tolist())):
            out[chunk] = number
        out.figures.frombytes(np.frombuffer(self.figures, np.int64).reshape(-1, 4)[kept].tobytes())
        out.groups = [self.groups[i] for i in kept.tolist()]
        out.codes.frombytes(self.links(kept).tobytes())
        out.uses = np.ones(len(out), np.int64)
        return out


NO_CODES = np.zeros(0, np.int64)
NO_TOKENS = (0, 0, 0, None, NO_CODES)


@functools.lru_cache(1)
def pair_of(a: str, b: str) -> Pair:
    return Pair(a, b)


def _packed(values: np.ndarray) -> bytes:
    """First bytes of all values, then second ones: zeros lie together and pack well."""
    return values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel().astype(np.int64)


def _rows(block: int, kind: int, n: int, **columns: list) -> pa.RecordBatch:
    """n rows of a block; columns that are not named are null."""
    columns |= {"block": [block] * n, "kind": [kind] * n}
    arrays = [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in COLUMNS.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(COLUMNS))


def _block(known: Chunks, number: int, ids: list, texts: list[str | None], part: int) -> Iterator[pa.RecordBatch]:
    rows = [known.numbers(t) if t else NO_CODES for t in texts]
    known.align()
    figures = np.frombuffer(known.figures, np.int64).reshape(-1, 4).copy()
    known.used(np.bincount(np.concatenate([NO_CODES, *rows]), minlength=len(known)))
    shas, kept = [], []
    for row in rows:
        if not len(row) or not figures[row, 0].all():  # a chunk without tokens: the text has none
            shas.append("")
            kept.append(NO_CODES)
            continue
        digest = hashlib.sha256()
        for i in range(0, len(row), 1 << 16):
            digest.update((";" if i else "").encode())
            digest.update(";".join(map(known.groups.__getitem__, row[i : i + (1 << 16)].tolist())).encode())
        shas.append(digest.hexdigest())
        kept.append(row)
    sums = np.array([figures[row].sum(0) for row in kept]).reshape(-1, 4)
    times = np.bincount(np.concatenate([NO_CODES, *kept]), minlength=len(known))
    types = np.flatnonzero(times)
    renumbered = np.cumsum(times > 0) - 1
    chunks = [_packed(renumbered[row]) for row in kept]
    yield _rows(
        number, TEXTS, len(ids), doc_id=ids, sha=shas, chunks=chunks, **{c: sums[:, i] for i, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
    )
    pairs, links = np.unique(known.links(types), return_inverse=True)
    type_links = figures[types, 3]
    times = np.repeat(times[types], type_links)
    counts = np.bincount(links, times, len(pairs)).astype(np.int64) if len(pairs) else NO_CODES
    for i in range(0, len(pairs), part):
        yield _rows(number, PAIRS, 1, place=[i], pairs=[pairs[i : i + part]], counts=[counts[i : i + part]])
    ends = np.append(0, np.cumsum(type_links))
    for i in range(0, len(types), part):
        some = type_links[i : i + part]
        yield _rows(number, TYPES, 1, place=[i], type_links=[_packed(some)], links=[_packed(links[ends[i] : ends[i + len(some)]])])


def _gathered(batches, size: int) -> Iterator[tuple[list, list[str | None]]]:
    """ids and texts of not much more than ``size`` bytes, whatever the batches."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            ids.append(doc_id)
            texts.append(text.as_py())
            held += len(texts[-1] or "")
            if held > size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def blocks(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Rows of blocks of texts: figures, digest and chunk numbers of each text; links of each chunk; pairs of ids with their counts."""

    def work(batches) -> Iterator[pa.RecordBatch]:
        known, number = Chunks(pair_of(a, b)), TaskContext.get().partitionId() << 32
        for number, (ids, texts) in enumerate(_gathered(batches, BLOCK), number):
            if len(known) > KEPT:
                known = known.again()
            yield from _block(known, number, ids, texts, PART)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, BLOCKS)


def pair_counts(made: DataFrame, size_b: int) -> DataFrame:
    """(pair, count, best): links of each id pair in the whole corpus, and whether no pair of its B id has more.

    Pairs of one B id are as many as A has tokens, at most.
    """
    found = made.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("p.*")
    counts = found.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("count"))
    of_b = Window.partitionBy(F.pmod("pair", F.lit(size_b)))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_b))


def link_counts(made: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, count, best): the corpus's links by token ids."""
    size_b = len(pair_of(a, b).bytes_b)
    counts = pair_counts(made, size_b)
    return counts.select(F.expr(f"pair div {size_b}").alias("a"), F.pmod("pair", F.lit(size_b)).alias("b"), "count", "best")


def aligned(docs: DataFrame, a: str, b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    bounded_batches(docs.sparkSession)
    made = stored(blocks(docs, a, b), "alignment")
    counts = pair_counts(made, len(pair_of(a, b).bytes_b))
    held = made.where(F.col("kind") == PAIRS).select("block", F.col("place").alias("first"), F.posexplode("pairs").alias("place", "pair"))
    held = held.select("block", (F.col("first") + F.col("place")).alias("place"), "pair")
    known = held.join(counts, "pair").select("block", F.lit(PAIRS).alias("kind"), "place", "count", "best")
    rows = made.where(F.col("kind") != PAIRS).drop("pairs", "counts").unionByName(known, allowMissingColumns=True)
    return rows.repartition("block").sortWithinPartitions("block", "kind", "place").mapInArrow(_figures, RESULT)


def _figures(batches) -> Iterator[pa.RecordBatch]:
    """The rows of the blocks' documents, with the corpus's counts of their links added up. Rows come by block and kind."""
    block, pairs, types, by_type = None, [], [], None
    for batch in batches:
        keys = np.stack([batch[c].to_numpy() for c in ("block", "kind")], axis=1)
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for at, end in itertools.pairwise(edges):
            rows = batch.slice(at, end - at)
            if end > at and keys[at, 0] != block:
                block, pairs, types, by_type = keys[at, 0], [], [], None
            if end > at and keys[at, 1] == PAIRS:
                pairs.append([rows[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("best", "count")])
            elif end > at and keys[at, 1] == TYPES:
                types += [[_unpacked(rows[c][i].as_py()) for c in ("type_links", "links")] for i in range(len(rows))]
            elif end > at:
                if by_type is None:
                    by_type = _by_type(pairs, types)
                yield _documents(rows, by_type)


def _by_type(pairs: list, types: list) -> np.ndarray:
    """Of each chunk: links that are the highest of their B id, and the sum of their counts."""
    if not types:
        return np.zeros((0, 2), np.int64)
    by_pair = np.stack([np.concatenate(x) for x in zip(*pairs, strict=True)], axis=1)
    return np.concatenate([np.add.reduceat(by_pair[links], np.cumsum(n) - n, axis=0) for n, links in types])


def _documents(rows: pa.RecordBatch, by_type: np.ndarray) -> pa.RecordBatch:
    chunks = [_unpacked(x.as_py()) for x in rows["chunks"]]
    sizes = np.array([len(x) for x in chunks])
    sums = np.zeros((len(sizes), 2), np.int64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        sums[filled] = np.add.reduceat(by_type[np.concatenate(chunks)], (np.cumsum(sizes) - sizes)[filled], axis=0)
    return pa.RecordBatch.from_arrays(
        [*(rows[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), pa.array(sums[:, 0]), pa.array(sums[:, 1]), rows["sha"]],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    )
