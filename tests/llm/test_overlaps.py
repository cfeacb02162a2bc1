"""Jaccard join, decontamination, components and the pipeline against brute force."""

import random

import numpy as np
import pytest

pytest.importorskip("studytrail.llm")

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from cases import ROWS, documents, rows_of  # noqa: E402
from studytrail.llm import components, decontamination, exact_dedup, near_dups, queries, toxicity  # noqa: E402
from studytrail.llm.words import words_of  # noqa: E402

VOCABULARY = [a + b + c for a in ("ka", "lo", "mi", "ter", "nu") for b in ("ra", "so", "vi", "pel") for c in ("n", "st", "x", "do")]


def prose(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


@pytest.fixture(scope="module")
def near_rows():
    """Bases with copies that differ more and more, a large group of near copies, and shared passages."""
    rng = random.Random(4)
    rows = []
    for _ in range(25):
        base = prose(rng, rng.randrange(8, 120))
        for changes in (0, 0, 1, 2, 3, 5, 8):
            text = list(base)
            for _ in range(changes):
                text[rng.randrange(len(text))] = rng.choice(VOCABULARY)
            rows.append(" ".join(text))
    base, passage = prose(rng, 300), prose(rng, 60)
    for _ in range(90):
        text = list(base)
        for _ in range(rng.randrange(1, 6)):
            text[rng.randrange(len(text))] = rng.choice(VOCABULARY)
        rows.append(" ".join(text))
    rows += [" ".join(prose(rng, 40) + passage) for _ in range(40)]
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)] + [(r[0], r[1]) for r in ROWS]


def test_jaccard_join_is_exact(spark, near_rows, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 32)  # so that groups take several blocks
    docs = documents(spark, [(d, t, "en", None, 0) for d, t in near_rows])
    got = rows_of(near_dups.near_duplicates(docs), "doc_id", "class_id", "n_links")
    # rows without words are alone and have their own id
    want = [(d, c if brute.runs(t) else d, n) for (d, t), (c, n) in zip(near_rows, brute.near(near_rows), strict=True)]
    assert got == sorted(want, key=repr)


def test_one_row_of_each_group_stays(spark, near_rows):
    docs = documents(spark, [(d, t, "en", None, 0) for d, t in near_rows])
    kept = near_dups.drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    want = []
    for (d, t), (c, _) in zip(near_rows, brute.near(near_rows), strict=True):
        if not brute.runs(t) or d == c and (d, t) not in want:
            want.append((d, t))
    assert rows_of(kept, "doc_id", "text") == sorted(want, key=repr)
    assert near_dups.near_duplicates(docs.limit(0)).count() == near_dups.drop_near_duplicates(docs.limit(0)).count() == 0


def test_forest():
    assert near_dups.recall(near_dups.shortest_prefix()) >= near_dups.RECALL > near_dups.recall(near_dups.shortest_prefix() + 1)
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 900, np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 63, 100, np.uint64)])
    x, y = near_dups.signatures([a, b])
    assert abs((x == y).mean() - 0.8) < 0.12  # Jaccard 0.8, three deviations
    same = near_dups.intersections([np.sort(a), np.sort(b), np.sort(a[:3])])
    assert same.tolist() == [[same[0][0], 800, 3], [800, same[1][1], 3], [3, 3, same[2][2]]]


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)]
    comp = {v: v for e in edges for v in e if e[0] != e[1]}
    for _ in range(400):
        for a, b in edges:
            if a != b:
                comp[a] = comp[b] = min(comp[a], comp[b])
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.key: r.comp for r in got.collect()} == comp
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_seeds_hit_every_tolerated_pattern():
    assert decontamination.uncovered_patterns() == []


@pytest.fixture(scope="module")
def leaks():
    rng = random.Random(6)
    items = [" ".join(prose(rng, n)) for n in (5, 8, 10, 13, 14, 25, 60)] + [None, "", "!!"]
    rows = []
    for k, item in enumerate(items[:7] * 6):
        words, changes = item.split(), k // 7
        for _ in range(changes):
            words[rng.randrange(len(words))] = "other"
        if k % 3 == 0:
            words = words[: max(10, len(words) // 2)]
        rows.append(" ".join(prose(rng, rng.randrange(30)) + words + prose(rng, rng.randrange(30))).upper())
    rows += [" ".join(prose(rng, 80)) for _ in range(30)]
    return items, list(enumerate(rows)) + [(r[0], r[1]) for r in ROWS if r[0] != 6]


def test_decontamination_is_exact(spark, leaks):
    items, rows = leaks
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id bigint, text string, hash string")
    docs = documents(spark, [(d, t, "en", None, 0) for d, t in rows if d is not None])
    got = rows_of(decontamination.overlaps(docs, benchmark), "doc_id", "item_id")
    want = {(d, i) for d, t in rows if d is not None for i in brute.contaminated(t, items)}
    assert len(want) > 20 and got == sorted(want, key=repr)
    kept = decontamination.drop_contaminated(docs, benchmark)
    bad = {d for d, _ in want}
    assert kept.schema == docs.schema
    assert rows_of(kept, "doc_id", "text") == sorted(((d, t) for d, t in rows if d is not None and d not in bad), key=repr)
    for a, b in ((docs.limit(0), benchmark), (docs, benchmark.limit(0))):
        assert decontamination.judged(a, b).count() == 0
        assert decontamination.drop_contaminated(a, b).count() == a.count()
    with_null = documents(spark)
    assert decontamination.drop_contaminated(with_null, benchmark).count() == len(ROWS)


def test_overlap_at_borders():
    item, text = (next(words_of([" ".join(map(str, r))])) for r in (range(20), [99, 99, *range(15, 20)]))
    assert decontamination.overlap(item, 15, text, 2) == 0  # only five words lie side by side
    assert decontamination.overlap(item, 3, item, 3) == 13


@pytest.fixture(scope="module")
def piped(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(near_dups.tables.stored(stage(spark, out[-1], sf_dir), "stage"))
    return out


def test_pipeline_stages(spark, sf_dir, piped):
    names = [n for n, _ in corpus_pipeline.STAGES]
    rows = [{r.doc_id: r.text for r in df.select("doc_id", "text").collect()} for df in piped[:-1]]
    assert all(df.schema == piped[0].schema for df in piped[:-1])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    gone = rows[0].keys() - rows[1].keys()
    scores = {r.doc_id for r in toxicity.scored(piped[0], toxicity.train(piped[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))).where("predicted = 1").collect()}
    assert gone == scores and all(labels.get(d, 1) for d in gone)
    best = {}
    for d, t in rows[1].items():
        best[t or ""] = max(d, best.get(t or "", d))
    assert set(rows[2]) == set(best.values())
    listed = sorted(rows[2].items())
    want = {d for (d, t), (c, _) in zip(listed, brute_near(listed), strict=True) if c == d}
    assert set(rows[3]) == want
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hashes = set()
    for w in words_of(items):
        hashes |= set(w.tolist())
    left = rows[3].keys() - rows[4].keys()
    assert left == {r.doc_id for r in decontamination.judged(piped[3], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    short = {d: t for d, t in rows[3].items() if len(t or "") < 1500}
    assert {d for d, t in short.items() if brute.contaminated(t, items)} == left & short.keys()
    assert {r.doc_id for r in piped[5].collect()} == rows[4].keys() and names[-1] == "bpe_codec"
    assert piped[5].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def brute_near(rows):
    """As brute.near, comparing only rows of near sizes that share a run at all."""
    from collections import defaultdict

    sets, by = [brute.runs(t) for _, t in rows], defaultdict(list)
    for i, s in enumerate(sets):
        for run in s:
            by[run].append(i)
    comp = list(range(len(rows)))
    pairs = {(i, j) for own in by.values() for i in own for j in own if i < j and 10 * min(len(sets[i]), len(sets[j])) >= 8 * max(len(sets[i]), len(sets[j]))}
    linked = [(i, j) for i, j in pairs if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]) - 1e-6]
    changed = True
    while changed:
        changed = False
        for i, j in linked:
            if comp[i] != comp[j]:
                comp[i] = comp[j] = min(comp[i], comp[j])
                changed = True
    return [(rows[c][0], 0) for c in comp]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_bear_hostile_and_empty_tables(spark, sf_dir, stage):
    docs = documents(spark)
    for df in (docs, docs.limit(0)):
        got = stage(spark, df, sf_dir)
        assert got.count() <= df.count()
        if stage is not corpus_pipeline.bpe_stage:
            assert got.schema == df.schema


def test_copies_of_the_whole_table(spark, sf_dir):
    assert exact_dedup.drop_copies(documents(spark)).count() == len({r[1] or "" for r in ROWS})
    assert queries.op9_jaccard_join(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
