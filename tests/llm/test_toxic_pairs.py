"""Toxicity that no term shows alone, learnt and judged through train()."""

import tracemalloc

import numpy as np
import pytest

pytest.importorskip("studytrail.llm")

from cases import PROSE  # noqa: E402
from studytrail.llm import toxicity  # noqa: E402


def judged(spark, rows):
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    machine = toxicity.train(table, table.select("doc_id", "toxic"))
    got = toxicity.scored(table, machine).join(table, "doc_id").where("held_out").collect()
    return machine, got


def test_pairs_of_neutral_terms(spark):
    """One pair a toxic row; each member alone is as frequent in clean rows."""
    rng = np.random.default_rng(8)
    plain, pairs, rows = PROSE.split(), [("lomur", "vashti"), ("kreb", "doonal"), ("pinzo", "wekka")], []
    for i in range(3000):
        words, toxic = list(rng.choice(plain, 30)), i % 2
        pair = pairs[int(rng.integers(3))]
        words[int(rng.integers(15))] = pair[0] if toxic or i % 4 else plain[0]
        words[15 + int(rng.integers(15))] = pair[1] if toxic or not i % 4 else plain[0]
        if not toxic and rng.random() < 0.9:  # what a pair's member lacks in these rows, another pair's brings
            words[14] = pairs[(pairs.index(pair) + 1) % 3][0 if not i % 4 else 1]
        rows.append((i, " ".join(words), toxic))
    for word in {w for p in pairs for w in p}:
        share = [np.mean([word in r[1].split() for r in rows if r[2] == y]) for y in (0, 1)]
        assert abs(share[0] - share[1]) < 0.05
    _, got = judged(spark, rows)
    assert len(got) > 400 and np.mean([r.toxic == r.predicted for r in got]) > 0.95


def test_terms_of_clean_texts(spark):
    rng = np.random.default_rng(9)
    rows = [(i, " ".join([*rng.choice(PROSE.split(), 30), *(["thanks"] if i % 2 else [])]), int(i % 2 == 0)) for i in range(800)]
    machine, got = judged(spark, rows)
    assert len(machine.terms) and np.mean([r.toxic == r.predicted for r in got]) > 0.98


def test_of_repeated_ids_one_row_is_learnt_from(spark):
    rng = np.random.default_rng(10)
    rows = [(i, " ".join([*rng.choice(PROSE.split(), 20), *(["lomur"] if i % 2 else [])]), i % 2) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    labels = table.select("doc_id", "toxic")
    many = table.unionByName(table.where("doc_id % 7 = 0").crossJoin(spark.range(20)).drop("id"))
    once, often = toxicity.train(table, labels), toxicity.train(many, labels)
    assert len(once.terms) and (once.terms == often.terms).all()
    assert often.bias == pytest.approx(once.bias) and often.weight == pytest.approx(once.weight)


def test_equal_terms_are_one_column():
    rng = np.random.default_rng(4)
    weight, factor = rng.normal(size=3), rng.normal(size=(3, toxicity.FACTORS))
    plain = toxicity.Machine(0.1, np.arange(3, dtype=np.uint32), weight, factor)
    groups = [np.array([7, 2, 30], np.uint32), np.array([5], np.uint32), np.array([9, 1], np.uint32)]
    machine = toxicity.spread(groups, 0.1, weight, factor)
    for some in ([], [0], [0, 1], [0, 2], [0, 1, 2]):
        whole = np.sort(np.concatenate([np.zeros(0, np.uint32), *(groups[k] for k in some)]))
        assert machine.score(whole) == pytest.approx(plain.score(np.array(some, np.uint32)))


def test_only_chosen_columns_come_to_the_driver(spark, monkeypatch):
    """300 words are common enough to be screened; one of them and its beginnings tell the classes apart."""
    rng = np.random.default_rng(12)
    words = ["".join(rng.choice(list("abcdefghij"), 9)) for _ in range(300)]
    rows = [(i, " ".join([*rng.choice(words, 60), *(["zzlomur"] if i % 2 else [])]), i % 2) for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    taken, to_arrow = [], type(table).toArrow

    def watched(df):
        taken.append(to_arrow(df))
        return taken[-1]

    monkeypatch.setattr(type(table), "toArrow", watched)
    monkeypatch.setattr(type(table), "toPandas", lambda df: pytest.fail("rows of the sample become objects of the driver"))
    machine = toxicity.train(table, table.select("doc_id", "toxic"))
    assert 0 < len(machine.terms) < 50
    screened = max(t.num_rows for t in taken if "terms" in t.column_names)
    assert screened > 300
    most = max(len(at.as_py()) // 4 for t in taken if {"y", "at"} <= set(t.column_names) for at in t["at"])
    assert most <= len(machine.terms)


@pytest.mark.parametrize("columns", [0, 5, 20, 33, 60])  # up to four blocks, the last one in part
def test_pairs_of_all_blocks(spark, monkeypatch, columns):
    monkeypatch.setattr(toxicity, "SIDE", 16)
    monkeypatch.setattr(toxicity, "STEP", 8)
    monkeypatch.setattr(toxicity, "PAIR_G", 0.5)
    rng = np.random.default_rng(columns)
    x, tags = rng.random((90, columns)) < 0.4, np.sort(rng.choice(1 << 40, 90, replace=False))
    y = (rng.random(90) < 0.5).astype(np.int32)
    rows = [(int(tag), bytearray(np.flatnonzero(r).astype(np.int32).tobytes())) for tag, r in zip(tags, x, strict=True)]
    data = spark.createDataFrame(rows[::-1], "tag bigint, at binary")
    blocks = toxicity.column_blocks(data, tags).toArrow().sort_by("block")
    assert blocks["block"].to_pylist() == list(range(-(-columns // 16)))
    best = toxicity.pair_scores(x.astype(np.uint8), x.astype(np.uint8), y).max(1, initial=0)
    assert toxicity.pair_bests(spark, blocks["bits"].to_pylist(), y, columns) == pytest.approx(np.where(best > 0.5, best, 0))


def test_fitting_takes_rows_in_parts():
    x = np.zeros((20_000, 200), np.uint8, order="F")
    x[::2, 0] = 1
    tracemalloc.start()
    toxicity.fit(x, x[:, 0].astype(float), np.ones(len(x)), steps=1)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < x.nbytes * 2  # numbers of four bytes for all rows take four times as much
