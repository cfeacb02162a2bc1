"""Token counts by a whole-token shortcut.

Which vocabulary strings encode alone as one token is proven beforehand from the merges. A pre-token that is such a
string counts as one; only the others are merged, and their counts are kept by worker up to a bound.

Null texts count as empty (no bytes, no tokens); an empty table gives an empty one; repeated rows are counted alike.
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrail.llm.bpe import CACHE, Kept, Vocabulary, vocabulary
from studytrail.llm.words import slices


class Counter:
    def __init__(self, words: Vocabulary, kept: int = CACHE):
        self.words = words
        strings = {}
        for i in words.whole:
            try:
                strings[words.text[i].decode("utf-8")] = 1
            except UnicodeDecodeError:
                pass  # part of a letter, never a pre-token
        self.known = Kept(lambda word: len(words.merged(word.encode())), strings, kept)

    def count(self, text: str) -> int:
        known = self.known.__getitem__
        return sum(1 if isinstance(part, int) else sum(map(known, part)) for part in self.words.pieces(text))


@functools.lru_cache(2)
def counter(path: str, kept: int = CACHE) -> Counter:
    return Counter(vocabulary(path), kept)


def token_counts(docs: DataFrame, path: str, limit: int = 1024, kept: int = CACHE) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text; ``kept`` as in ``bpe_codec.digests``."""

    def work(batches):
        of = counter(path, kept)
        for b in batches:
            for at, texts in slices(b["text"]):
                n = [of.count(t or "") for t in texts]
                rows = slice(at, at + len(texts))
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"][rows], b["n_bytes"][rows], pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("bigint").alias("n_bytes")
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", size)
    return rows.mapInArrow(work, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
