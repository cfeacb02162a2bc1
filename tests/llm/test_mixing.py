"""Mixing: targets against the rule done round by round, rates against the tilts' definition, copies against both."""

import math
import random
import re
from collections import defaultdict

import pytest

pytest.importorskip("studytrail.llm")

from cases import documents, rows_of  # noqa: E402
from studytrail.llm import mixing  # noqa: E402

NAMES = ("doc_id", "source", "size", "source_size", "target", "taken", "copies", "rate")


def target_rounds(sizes, weights=(5, 2, 1), most=3):
    """Share by weight; what is above a source's limit is shared again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {s: share.get(s, most * sizes[s]) for s in order}
        full |= over


def check(rows, docs, most=3):
    sizes, of, taken = {}, {}, defaultdict(int)
    for _, source, text in docs:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = target_rounds(sizes)
    by = defaultdict(list)
    for doc_id, source, size, source_size, target, words, copies, rate in rows:
        assert source_size == sizes[source] and math.isclose(target, want[source], rel_tol=1e-9, abs_tol=1e-6)
        assert words == copies * size and 0 <= copies <= most
        taken[source] += words
        by[source].append((size, rate, copies))
    assert len(rows) == len(docs)
    for source, members in by.items():
        smallest = min((s for s, _, _ in members if s), default=0)
        filled = [(s, r) for s, r, _ in members if s]
        assert abs(taken[source] - want[source]) <= max(1, smallest), source
        if filled and want[source] < most * sizes[source] * (1 - 1e-9):
            assert math.isclose(sum(s * r for s, r in filled), want[source], rel_tol=1e-4, abs_tol=0.5)
            tilts = [math.log(r) / s for s, r in filled if 1e-9 < r < most * (1 - 1e-9)]
            assert max(tilts) - min(tilts) <= 1e-6 * max(map(abs, tilts)) + 1e-12
    return want


def docs_of(seed, sources, n):
    rng = random.Random(seed)
    return [(i, rng.choice(sources), " ".join(["w"] * min(400, int(rng.paretovariate(0.9))))) for i in range(n)]


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id bigint, source string, text string")


@pytest.mark.parametrize("seed", [1, 2])
def test_near_targets(spark, seed):
    docs = docs_of(seed, ["a", "b", "", "Z", "é", "\U0001f600", "ﬁ", None], 900) + [(9000 + i, "tiny", "a b c") for i in range(3)]
    rows = rows_of(mixing.mixed(frame(spark, docs).repartition(3)), *NAMES)
    want = check(rows, docs)
    assert any(want[s] == 3 * 9 for s in ["tiny"])
    assert rows == rows_of(mixing.mixed(frame(spark, docs).repartition(5)), *NAMES)


def test_one_size_in_parts(spark, monkeypatch):
    """Many documents of one source and size are ranked in parts; copies differ by one at most."""
    monkeypatch.setattr(mixing, "PART", 16)
    docs = [(i, "hot", "a b c") for i in range(1000)] + [(2000 + i, "b", "a b") for i in range(300)] + [(3000, "c", "x")]
    rows = rows_of(mixing.mixed(frame(spark, docs)), *NAMES)
    check(rows, docs)
    hot = [r[6] for r in rows if r[1] == "hot"]
    assert max(hot) - min(hot) <= 1


def test_one_source_keeps_everything(spark):
    docs = docs_of(4, ["only"], 50)
    assert all(r[6] == 1 for r in rows_of(mixing.mixed(frame(spark, docs)), *NAMES))


def test_cases(spark):
    docs = documents(spark)
    rows = rows_of(mixing.mixed(docs), *NAMES)
    plain = docs.select("doc_id", "source", "text").collect()
    assert sorted((r[0], r[1]) for r in rows if r[0]) == sorted((r.doc_id, r.source) for r in plain if r.doc_id)
    assert {r[2] for r in rows if r[0] in (3, 4)} == {0}
    want = target_rounds({s: sum(len((r.text or "").split()) for r in plain if r.source == s) for s in ("s", None)})
    assert all(math.isclose(r[4], want[r[1]]) and r[5] == r[6] * r[2] and 0 <= r[6] <= 3 for r in rows)
    assert rows_of(mixing.mixed(docs.limit(0))) == []


def test_no_words_at_all(spark):
    rows = rows_of(mixing.mixed(frame(spark, [(1, "a", None), (2, None, " \n"), (3, "a", "")])), "doc_id", "target", "taken")
    assert rows == [(1, 0.0, 0), (2, 0.0, 0), (3, 0.0, 0)]
