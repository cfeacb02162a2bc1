"""Language identification by inferring each document's mixture of languages.

Learnt: how often each hashed trigram of letters (with word borders) comes in the texts of each language, over all labelled
rows. A document's words have a likelihood under each language, the product over their trigrams. Expectation
maximisation finds the proportions of languages that explain the words best; languages are left out one by one as long
as the penalised likelihood (log likelihood less half the log of the number of words per language) gains by it. The language with
the largest proportion is predicted, the score is its proportion.

Null texts and texts without a letter give ``und`` with score 0, as does everything if nothing was learnt. Ties go to the
first language by name. Languages beyond ``max_languages`` (those with the fewest trigrams) are not learnt.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrail.llm.words import PIECE, PLANES, pieces, points, slices

BUCKETS = 1 << 16
COMMON = 0.1  # share of the languages' common distribution in each, so that what none has seen speaks for none
MAX_LANGUAGES = 256
STEPS = 8
FOLDS, FOLD = 4, 2


@functools.cache
def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(PLANES)), bool, PLANES)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each trigram that ends in a letter, first trigram of each word, place of each word's first letter)."""
    cp = points(text.lower())
    letter = letter_table()[np.minimum(cp, PLANES - 1)]
    x = np.zeros(len(cp) + 2, np.uint32)
    np.multiply(cp, letter, out=x[2:])
    h = x[2:] * np.uint32(0x9E3779B1)
    h ^= x[1:-1] * np.uint32(0x85EBCA77)
    h = (h << np.uint32(13)) | (h >> np.uint32(19))
    before = np.where(x[1:-1] > 0, x[:-2], np.uint32(0))  # nothing before a word counts
    h = (h ^ before * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    bucket = ((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1))[letter].astype(np.int32)
    begins = np.flatnonzero(letter & (x[1:-1] == 0))
    first = (np.cumsum(letter, dtype=np.int64)[begins] - 1) if len(begins) else begins
    return bucket, first, begins


def batches_of(texts: list[str | None]):
    """(numbers of the texts, joined text, place where each ends): texts together up to PIECE, longer ones cut."""
    group, size = [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if len(text) > PIECE:
            for piece in pieces(text):
                yield [i], [piece]
            continue
        if size + len(text) > PIECE and group:
            yield [g[0] for g in group], [g[1] for g in group]
            group, size = [], 0
        group.append((i, text))
        size += len(text)
    if group:
        yield [g[0] for g in group], [g[1] for g in group]


@dataclass(frozen=True)
class Languages:
    names: tuple[str, ...]
    logp: np.ndarray  # (BUCKETS, languages), float32


def learn(docs: DataFrame, max_languages: int = MAX_LANGUAGES) -> Languages:
    """docs: text and lang, all of them learnt from."""

    def counted(batches):
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b["lang"].to_pylist()
            for at, texts in slices(b["text"]):
                by: dict[str, list] = {}
                for lang, text in zip(langs[at : at + len(texts)], texts, strict=True):
                    by.setdefault(lang, []).append(text)
                for lang, own in by.items():
                    for _, group in batches_of(own):
                        n = np.bincount(trigrams("\n".join(group))[0], minlength=BUCKETS)
                        seen[lang] = seen[lang] + n if lang in seen else n
                if len(seen) > 2 * MAX_LANGUAGES:
                    yield from emitted(seen)
        yield from emitted(seen)

    def emitted(seen):
        for lang, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bucket", "n"])
        seen.clear()

    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    counts = rows.mapInArrow(counted, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    names = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages)
    counts = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("bins"))  # BUCKETS entries at most
    found = counts.join(F.broadcast(names.select("lang")), "lang").orderBy("lang")
    columns, langs = [], []
    for row in found.toLocalIterator():  # max_languages rows
        n = np.zeros(BUCKETS)
        for bucket, count in row["bins"]:
            n[bucket] = count
        columns.append((n / n.sum()).astype(np.float32))
        langs.append(row["lang"])
    if not columns:
        return Languages((), np.zeros((BUCKETS, 0), np.float32))
    share = np.stack(columns, 1)
    common = 0.5 * share.mean(1, keepdims=True) + 0.5 / BUCKETS
    return Languages(tuple(langs), np.log((1 - COMMON) * share + COMMON * common).astype(np.float32))


def mixtures(loglik: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Proportions (n_docs, languages) by EM with backward selection. loglik: a row per word; doc: its document, ascending."""
    n_lang = loglik.shape[1]
    out = np.zeros((n_docs, n_lang))
    if not len(doc):
        return out
    present, start = np.unique(doc, return_index=True)
    size = np.diff(np.append(start, len(doc)))
    top = loglik.max(1)
    like = np.exp(loglik - top[:, None])
    on = np.ones((len(present), n_lang), bool)
    share = np.add.reduceat(like / like.sum(1, keepdims=True), start) / size[:, None]

    def em(share, rows, begin, number, like):
        for _ in range(STEPS):
            joint = share[rows] * like
            total = np.maximum(joint.sum(1), 1e-300)
            share = np.add.reduceat(joint / total[:, None], begin) / number[:, None]
        total = np.maximum((share[rows] * like).sum(1), 1e-300)
        return share, np.add.reduceat(np.log(total), begin)

    row = np.repeat(np.arange(len(present)), size)
    share, value = em(share, row, start, size, like)
    open_docs = np.arange(len(present))
    while len(open_docs):
        open_docs = open_docs[on[open_docs].sum(1) > 1]
        if not len(open_docs):
            break
        least = np.where(on[open_docs], share[open_docs], np.inf)
        drop = n_lang - 1 - np.argmin(least[:, ::-1], axis=1)
        fewer = share[open_docs].copy()
        fewer[np.arange(len(open_docs)), drop] = 0
        fewer = np.where(fewer.sum(1, keepdims=True) > 0, fewer, on[open_docs])
        fewer[np.arange(len(open_docs)), drop] = 0
        fewer = fewer / np.maximum(fewer.sum(1, keepdims=True), 1e-300)
        number = size[open_docs]
        begin = np.append(0, np.cumsum(number)[:-1])
        take = np.repeat(start[open_docs] - begin, number) + np.arange(number.sum())
        fewer, less = em(fewer, np.repeat(np.arange(len(open_docs)), number), begin, number, like[take])
        better = less + 0.5 * np.log(number + 1) >= value[open_docs]
        won = open_docs[better]
        share[won], value[won] = fewer[better], less[better]
        on[won, drop[better]] = False
        open_docs = won
    out[present] = share
    return out


def word_likelihoods(model: Languages, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(log likelihood of each word under each language, number of its text); long words count by their mean of eight."""
    joined = "\n".join(texts)
    bucket, first, place = trigrams(joined)
    if not len(first):
        return np.zeros((0, len(model.names)), np.float32), first
    sums = np.add.reduceat(model.logp[bucket], first, axis=0)
    length = np.diff(np.append(first, len(bucket)))
    sums *= np.minimum(1, 8 / length)[:, None].astype(np.float32)
    lower = [len(t.lower()) + 1 for t in texts]
    return sums, np.searchsorted(np.cumsum(lower), place, side="right")


def predictions(model: Languages, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    share = np.zeros((len(texts), len(model.names)))
    long: dict[int, list[np.ndarray]] = {}
    for numbers, group in batches_of(texts):
        like, doc = word_likelihoods(model, group)
        if len(numbers) == 1 and len(texts[numbers[0]] or "") > PIECE:
            long.setdefault(numbers[0], []).append(like)
        elif len(model.names):
            share[numbers] = mixtures(like, doc, len(numbers))
    for i, parts in long.items():
        like = np.concatenate(parts)
        if len(model.names):
            share[i] = mixtures(like, np.zeros(len(like), np.int64), 1)[0]
    if not len(model.names):
        return ["und"] * len(texts), np.zeros(len(texts))
    best, score = share.argmax(1), share.max(1)
    return [model.names[k] if s > 0 else "und" for k, s in zip(best, score, strict=True)], np.clip(score, 0, 1)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == FOLD, F.lit(False))


def identified(docs: DataFrame, model: Languages) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""

    def work(batches):
        for b in batches:
            for at, texts in slices(b["text"]):
                langs, score = predictions(model, texts)
                rows = slice(at, at + len(texts))
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"][rows], b["held_out"][rows], pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(work, "doc_id bigint, held_out boolean, lang_pred string, score double")
