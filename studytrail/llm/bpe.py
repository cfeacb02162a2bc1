"""Byte-level BPE of a published vocabulary file: pre-tokens, merges, and which strings are one token alone.

The file is the one of the ``tokenizers`` library (a path, read by every worker); special tokens in it are found in
texts first and are never split, as that library does by default.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
from collections.abc import Callable, Iterator

import regex

# fixed value: the pre-token pattern of byte-level vocabularies; \s spelt out, as the library takes Unicode's White_Space
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?=[{SPACE}]|\Z)|[{SPACE}]+"
)
LONG = 1 << 20  # code points of a text that is cut lazily
PART = 1 << 16  # pre-tokens handled at once
CACHE = 1 << 16  # pre-tokens of each of the two generations whose results a worker keeps, unless the caller has more room
LARGE = 1 << 18  # the same for a worker that does nothing else
NEVER = 1 << 60
NONE = (NEVER, -1)
SHORT = 64  # bytes


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes: printable ones for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = byte_letters()
        names = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.text = [b""] * (max([*names.values(), *self.special.values()]) + 1)
        for name, i in names.items():
            self.text[i] = name.encode() if name in self.special else bytes(letters[c] for c in name)
        for name, i in self.special.items():
            self.text[i] = name.encode()
        self.byte = [0] * 256
        for i in names.values():
            if len(self.text[i]) == 1:
                self.byte[self.text[i][0]] = i
        #: (left, right) -> (rank, merged); of a merged token: its parts and rank
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        n = len(self.text)
        self.left, self.right, self.made = [-1] * n, [-1] * n, [-1] * n
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            key, token = (names[a], names[b]), names[a + b]
            self.merge.setdefault(key, (rank, token))
            if self.made[token] < 0:
                self.left[token], self.right[token], self.made[token] = *key, rank
        self.whole = self._whole(names.values())
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def apart(self, a: int, b: int, before: int = NEVER) -> bool:
        """Whether, until rank ``before``, no merge joins the end of a with the beginning of b.

        Goes back in time along a's last and b's first parts: a pair at the border merges if its rank comes before
        the merge that takes one of them away. Equal ranks go from left to right.
        """
        merge, made = self.merge, self.made
        while True:
            found = merge.get((a, b))
            if found is not None and found[0] < before:
                return False
            if made[a] > made[b]:
                before, a = made[a], self.right[a]
            elif made[b] >= 0:
                before, b = made[b] + 1, self.left[b]
            else:
                return True

    def _whole(self, ids) -> set[int]:
        """Tokens whose bytes encode as that token alone: both parts do and nothing joins across them before."""
        proven = {i for i in ids if len(self.text[i]) == 1}
        for i in sorted((i for i in ids if self.made[i] >= 0), key=self.made.__getitem__):
            a, b = self.left[i], self.right[i]
            if a in proven and b in proven and self.apart(a, b, self.made[i]):
                proven.add(i)
        return proven

    def merged(self, word: bytes) -> list[int]:
        """Token ids by merging the lowest rank first, the leftmost of equal ones."""
        parts = [self.byte[b] for b in word]
        return self._merged_long(parts) if len(parts) > SHORT else self._merged_short(parts)

    def _merged_short(self, parts: list[int]) -> list[int]:
        merge = self.merge
        ranks = [merge.get(pair, NONE) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best is NONE:
                break
            i = ranks.index(best)
            parts[i : i + 2] = (best[1],)
            del ranks[i]
            if i:
                ranks[i - 1] = merge.get((parts[i - 1], parts[i]), NONE)
            if i < len(ranks):
                ranks[i] = merge.get((parts[i], parts[i + 1]), NONE)
        return parts

    def _merged_long(self, parts: list[int]) -> list[int]:
        """The same with a linked list of parts and a heap of pairs, for words of any length."""
        merge, n = self.merge, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merge.get((parts[i], parts[i + 1]))
            if found:
                heap.append((found[0], i, parts[i], parts[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, token = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = token, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := merge.get((token, parts[k])):
                    heapq.heappush(heap, (found[0], i, token, parts[k], found[1]))
            if (h := before[i]) >= 0 and (found := merge.get((parts[h], token))):
                heapq.heappush(heap, (found[0], h, parts[h], token, found[1]))
        return [p for p in parts if p >= 0]

    def pieces(self, text: str) -> Iterator[list[str] | int]:
        """Lists of pre-tokens and ids of special tokens, in order; together the whole text."""
        at = 0
        for found in self._special.finditer(text) if self._special else ():
            yield from pre_tokens(text[at : found.start()])
            yield self.special[found.group()]
            at = found.end()
        yield from pre_tokens(text[at:] if at else text)


def pre_tokens(text: str) -> Iterator[list[str]]:
    if len(text) <= LONG:
        if text:
            yield PATTERN.findall(text)
        return
    found = (m.group() for m in PATTERN.finditer(text))
    while part := list(itertools.islice(found, PART)):
        yield part


@functools.lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Kept(dict):
    """Results by pre-token, worked out when first asked for.

    Bounded by two generations: a full one becomes the old one, and what is asked for again moves to the new one.
    """

    def __init__(self, work: Callable, given: dict | None = None, size: int = CACHE):
        super().__init__()
        self.work, self.given, self.old, self.size = work, given or {}, {}, size

    def __missing__(self, word: str):
        found = self.old.get(word)
        if found is None:
            found = self.given.get(word)
            if found is None:
                found = self.work(word)
            if len(word) >= 256:
                return found
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found
