"""BPE encoding and decoding: the last token of every prefix, by dynamic programming.

An automaton over the vocabulary gives, at each byte of a pre-token, the tokens that are suffixes of the prefix read so
far. Exactly one of them can be the last token of that prefix's encoding: the one that stays apart from the last token
of the prefix before it. Back-pointers from the end give the exact ids, in time linear in the pre-token, however long.

Null texts count as empty and have no ids; an empty table gives an empty one; repeated rows are encoded alike; other
columns are ignored. Long texts are worked off in parts, so memory holds one text and its parts.
"""

from __future__ import annotations

import functools
import hashlib
from array import array

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrail.llm.bpe import CACHE, Kept, Vocabulary, vocabulary
from studytrail.llm.words import slices

PAIRS = 2  # pairs of tokens whose test a worker keeps, for each pre-token that it keeps
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Codec:
    def __init__(self, words: Vocabulary, kept: int = CACHE):
        self.words, self.pairs = words, PAIRS * kept
        self.suffixes = ahocorasick.Automaton()
        for i in words.whole:
            self.suffixes.add_word(words.text[i].decode("latin-1"), (i, len(words.text[i])))
        self.suffixes.make_automaton()
        self._apart: dict[int, bool] = {}
        self.known = Kept(self._packed, size=kept)

    def apart(self, a: int, b: int) -> bool:
        if len(self._apart) >= self.pairs:
            self._apart.clear()
        found = self._apart[a << 32 | b] = self.words.apart(a, b)
        return found

    def ids(self, word: bytes) -> list[int]:
        """The ids of one pre-token."""
        known, size_of = self._apart.get, self.words.text
        last, done = [-1] * (len(word) + 1), -1
        for end, (token, size) in self.suffixes.iter(word.decode("latin-1")):
            if end == done:
                continue
            if start := end + 1 - size:
                before = last[start]
                apart = known(before << 32 | token)
                if apart is None:
                    apart = self.apart(before, token)
                if not apart:
                    continue
            last[end + 1], done = token, end
        out, at = [], len(word)
        while at:
            token = last[at]
            out.append(token)
            at -= len(size_of[token])
        out.reverse()
        return out

    def _packed(self, word: str) -> bytes:
        return array("I", self.ids(word.encode())).tobytes()

    def encode(self, text: str):
        """Ids of the text as little-endian 32-bit integers, part by part."""
        for part in self.words.pieces(text):
            yield part.to_bytes(4, "little") if isinstance(part, int) else b"".join(map(self.known.__getitem__, part))

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the ids' text; bytes that are no text become replacement characters."""
        raw = b"".join(map(self.words.text.__getitem__, array("I", ids)))
        return raw.decode("utf-8", "replace").encode()


@functools.lru_cache(2)
def codec(path: str, kept: int = CACHE) -> Codec:
    return Codec(vocabulary(path), kept)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every text."""

    def work(batches):
        of = codec(path)
        for b in batches:
            for at, texts in slices(b["text"], 1 << 20):
                ids = [array("I", b"".join(of.encode(t or ""))).tolist() for t in texts]
                yield pa.RecordBatch.from_arrays([b["doc_id"][at : at + len(texts)], pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, "doc_id bigint, ids array<int>")


def decoded(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with ids."""

    def work(batches):
        of = codec(path)
        for b in batches:
            texts = [of.decode(array("I", x or []).tobytes()).decode() for x in (v.as_py() for v in b["ids"])]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select(F.col("doc_id").cast("bigint"), "ids").mapInArrow(work, "doc_id bigint, text string")


def digests(docs: DataFrame, path: str, kept: int = CACHE) -> DataFrame:
    """Number of tokens, and digests of the ids and of the text decoded from them; ids never leave the worker.

    ``kept``: pre-tokens whose ids a worker keeps (twice at most, some 200 bytes each); more of them cost less time.
    """

    def work(batches):
        of = codec(path, kept)
        for b in batches:
            for at, texts in slices(b["text"]):
                out = []
                for text in texts:
                    n, ids, back = 0, hashlib.sha256(), hashlib.sha256()
                    for part in of.encode(text or ""):
                        n += len(part) // 4
                        ids.update(part)
                        back.update(of.decode(part))
                    out.append((n, ids.hexdigest(), back.hexdigest()))
                n, ids, back = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"][at : at + len(texts)], pa.array(n, pa.int64()), pa.array(ids), pa.array(back)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, DIGESTS)
