"""Hashed words of texts, by numpy over whole batches.

A word is a run of letters and digits of the lower-cased text; everything else separates words. A word's hash is a
64-bit polynomial over its code points, so equal words have equal hashes in every task.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np

PIECE = 1 << 19  # code points of a text handled at once
JOINED = 1 << 17  # code points of short texts handled together
SLICE = 1 << 20  # bytes of texts whose hashed words are held together
PLANES = 1 << 18  # code points from here on (no letters in use) separate words
BASE = 0x9E3779B97F4A7C15 | 1


@functools.cache
def word_table() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(PLANES)), bool, PLANES)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(BASE, -1, 1 << 64))
    up, down = np.full(n, np.uint64(BASE)), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_kept = _powers(1 << 10)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n. A worker keeps one table, the longest one up to 4 * JOINED."""
    global _kept
    if n > 4 * JOINED:
        return _powers(n)
    if n > len(_kept[0]):
        _kept = _powers(n)
    return _kept[0][:n], _kept[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in order, cut at blanks into parts of about ``size``; a longer run without blanks stays whole."""
    at = 0
    while len(text) - at > size:
        cut = text.rfind(" ", at, at + size)
        if cut < at:
            cut = text.find(" ", at + size)
        if cut < 0:
            break
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:] if at else text


def _hashes(text: str, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the words of a lower-cased text; with prefixes a row of hashes for each word."""
    cp = points(text)
    inside = np.zeros(len(cp) + 2, bool)
    inside[1:-1] = word_table()[np.minimum(cp, PLANES - 1)]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros((0, 1 + len(prefixes)) if prefixes else 0, np.uint64), start
    n = 1 << max(10, int(len(cp)).bit_length())
    up, down = powers(n)
    total = np.zeros(len(cp) + 1, np.uint64)
    np.cumsum((cp.astype(np.uint64) + np.uint64(1)) * up[: len(cp)], out=total[1:])
    h = mixed((total[end] - total[start]) * down[start])
    if not prefixes:
        return h, start
    out = np.repeat(h[:, None], 1 + len(prefixes), axis=1)
    for k, m in enumerate(prefixes, 1):
        longer = np.flatnonzero(end - start > m)
        out[longer, k] = mixed((total[start[longer] + m] - total[start[longer]]) * down[start[longer]] + np.uint64(m << 56))
    return out, start


def words_of(texts: list[str | None], prefixes: tuple[int, ...] = ()) -> Iterator[np.ndarray]:
    """Word hashes of each text, in order; null counts as empty.

    With prefixes each word is a row: its hash, and for each length the hash of that many first letters, or the word's
    own hash if it isn't longer.
    """
    batch, size = [], 0

    def flush():
        if not batch:
            return
        joined = "\n".join(batch)
        h, start = _hashes(joined, prefixes)
        ends = np.cumsum([len(t) + 1 for t in batch])
        cuts = np.searchsorted(start, ends)
        at = 0
        for cut in cuts:
            yield h[at:cut]
            at = cut

    for text in texts:
        text = (text or "").lower()
        if len(text) > PIECE:
            yield from flush()
            batch, size = [], 0
            yield np.concatenate([_hashes(p, prefixes)[0] for p in pieces(text)])
            continue
        if size + len(text) > JOINED:
            yield from flush()
            batch, size = [], 0
        batch.append(text)
        size += len(text)
    yield from flush()


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of runs of n words; a shorter text is one run of all its words, no words give none."""
    if not len(words):
        return words
    n = min(n, len(words))
    h = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        h = h * np.uint64(BASE) + words[k : len(words) - n + 1 + k]
    return np.unique(mixed(h))


def slices(column, size: int = 4 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of an Arrow string column, cut so that no list holds much more than ``size`` bytes."""
    at, held, values = 0, 0, []
    for i, value in enumerate(column):
        value = value.as_py()
        values.append(value)
        held += len(value or "")
        if held > size:
            yield at, values
            at, held, values = i + 1, 0, []
    if values:
        yield at, values
