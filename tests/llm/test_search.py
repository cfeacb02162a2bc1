"""Ranked search against scores worked out for every document and item."""

import math
import random
import re
from collections import Counter

import pytest

pytest.importorskip("studytrail.llm")

from cases import documents, rows_of  # noqa: E402
from studytrail.llm import search  # noqa: E402

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=50):
    tfs = [(i, Counter(terms(t))) for i, t in docs]
    tfs = [(i, tf) for i, tf in tfs if tf]
    n_docs, n_terms = len(tfs), sum(tf.total() for _, tf in tfs)
    df = Counter(t for _, tf in tfs for t in tf)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, tf in tfs:
            m = 50 + (50 * tf.total() * n_docs) // n_terms
            score = 0
            for t in wanted & tf.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


def found(docs, items, **options):
    return rows_of(search.search(docs, items, **options), "item_id", "rank", "doc_id", "score")


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "ÀB", "中", "x_y", "Don't", "1st"]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=rng.choice([3, 10, 10, 10, 40]))) for _ in range(n)]
    return [(i // 2 if rng.random() < 0.1 else i, t) for i, t in enumerate(texts)], [(k, " ".join(rng.choices(words, k=8))) for k in range(12)]


@pytest.mark.parametrize("block", [4096, 7])
@pytest.mark.parametrize("group", [1 << 17, 20])
def test_random_corpus(spark, monkeypatch, block, group):
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "PARTITION_ROWS", 100)
    monkeypatch.setattr(search, "BOUNDS", 50)
    monkeypatch.setattr(search.item_groups, "__defaults__", (group,))
    docs, items = corpus(5, 600)
    assert found(*frames(spark, docs, items)) == brute(docs, items)


def test_bounds_hold_and_visits_end_early(spark, monkeypatch):
    """No score is above its block's bound, and blocks that cannot matter are left out."""
    docs, items = corpus(8, 400)
    visits = []
    scores = search.Block.scores
    monkeypatch.setattr(search.Block, "scores", lambda self, terms: visits.append(1) or scores(self, terms))
    monkeypatch.setattr(search, "BLOCK", 5)
    numbers = {t: i for i, t in enumerate(sorted({t for _, x in items for t in search.terms_of(x)}))}
    rows = search.postings(spark.createDataFrame(docs, "doc_id bigint, text string"), numbers)
    import numpy as np

    weights = np.arange(1, len(numbers) + 1) * 100
    blocks = [search.Block(r.asDict(), weights) for r in search.index(rows, 400, 400 * 13, 4000).collect()]
    some = [np.array(sorted(numbers[t] for t in set(search.terms_of(x))), np.int32) for _, x in items]
    flat, cuts = np.concatenate(some), np.cumsum([0, *map(len, some[:-1])])
    for block in blocks:
        assert all(block.scores(t).max(initial=0) <= b for t, b in zip(some, block.bounds(len(numbers), flat, cuts)))
    all_visits = len(visits)
    visits.clear()
    for t in some:
        best = search.Best(3)
        bounds = [b.bounds(len(numbers), t, np.array([0]))[0] for b in blocks]
        for at in np.argsort(-np.array(bounds), kind="stable"):
            if bounds[at] < best.least:
                break
            best.add(blocks[at].scores(t), blocks[at].docs)
        whole = search.Best(3)
        for b in blocks:
            whole.add(scores(b, t), b.docs)
        assert best.rows == whole.rows
    assert len(visits) < all_visits / 2


def test_cases(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(1, "quick ALPHA fox"), (1, "river"), (None, "one"), (2, None), (3, "!?"), (4, "omega bank"), (5, "nowhere")]
    item_frame = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id bigint, text string, doc_id string, score int")
    assert found(docs, item_frame) == brute(rows, items)
    assert found(docs.limit(0), item_frame) == []
    assert found(docs, item_frame.limit(0)) == []


def test_ties_go_by_id(spark):
    docs = [(i, "same text here") for i in range(200)] + [(None, "same text here")] + [(500 + i, "other words") for i in range(300)]
    items = [(0, "same text")]
    assert found(*frames(spark, docs, items)) == brute(docs, items)
    assert [r[2] for r in sorted(found(*frames(spark, docs, items), top=201), key=lambda r: r[1])][-1] is None
