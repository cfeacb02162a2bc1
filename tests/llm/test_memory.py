"""Bounds of what tasks hold: Arrow batches, hashed words, matrices of a block, tables kept by a worker."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("studytrail.llm")

import corpus_pipeline  # noqa: E402
from studytrail import session  # noqa: E402
from studytrail.llm import near_dups, words  # noqa: E402

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def large_batches(spark):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "64m")
    yield
    spark.conf.set(LIMIT, before)


def sizes(df):
    def work(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    return [r["n"] for r in df.mapInArrow(work, "n bigint").collect()]


def peak(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_long_texts_come_in_bounded_batches(spark, large_batches):
    docs = spark.range(0, 6000, 1, 1).selectExpr("id AS doc_id", "repeat(concat(id, ' word '), 200) AS text")
    near_dups.joined(docs.limit(3))
    found = sizes(docs)
    assert max(found) < 5 << 20 and len(found) > 1


@pytest.mark.parametrize("name", ["toxicity", "decontamination", "bpe_codec"])
def test_stages_bound_their_batches(spark, large_batches, name, monkeypatch):
    for module, f in (("toxicity", "train"), ("toxicity", "drop_toxic"), ("decontamination", "clean_rows"), ("bpe_codec", "digests"), ("tables", "table")):
        monkeypatch.setattr(getattr(corpus_pipeline, module), f, lambda *_: None)
    dict(corpus_pipeline.STAGES)[name](spark, None, "")
    assert spark.conf.get(LIMIT) == str(4 << 20)


def test_smaller_limits_stay(spark, large_batches):
    for limit, then in (("1m", "1m"), ("65536b", "65536b"), ("1g", str(4 << 20))):
        spark.conf.set(LIMIT, limit)
        session.bounded_batches(spark)
        assert spark.conf.get(LIMIT) == then


def test_words_of_short_texts_take_little_memory():
    texts = [f"{i} " + "some words of a text " * 60 for i in range(800)]
    found, most = peak(lambda: [len(w) for w in words.words_of(texts)])
    assert found == [301] * 800
    assert most < 12 << 20


def test_words_do_not_depend_on_texts_beside_them():
    texts = ["a b", None, "", "x " * 100_000, "long" * 50_000, "y z " * 200_000, "a b"]
    for text, found in zip(texts, words.words_of(texts), strict=True):
        assert np.array_equal(found, next(words.words_of([text])))


def test_powers_are_those_of_any_length():
    long = words.powers(1 << 20)
    for n in (1 << 12, 1 << 10, 1 << 18, 1 << 11):
        for a, b in zip(words.powers(n), long, strict=True):
            assert len(a) == n and np.array_equal(a, b[:n])
    up, down = long
    assert (up * down == 1).all()


def test_a_block_of_near_copies_takes_little_memory():
    rng = np.random.default_rng(1)
    base, n = rng.integers(0, 1 << 63, 60, np.uint64), 1000
    sets = [np.unique(np.concatenate([base[rng.permutation(60)[:58]], rng.integers(0, 1 << 63, k % 20, np.uint64)])) for k in range(n)]
    keys = [k.to_bytes(4, "big") for k in range(n)]
    (links, label), most = peak(lambda: near_dups.block_links(keys, sets, np.ones(n, np.int64), np.arange(n) % 2, False))
    assert most < 16 * n * n
    lengths = np.array([len(s) for s in sets])
    for i in (0, 19, 500, 999):
        inter = np.array([len(np.intersect1d(sets[i], s)) for s in sets])
        assert links[i] == (inter >= 0.8 * (lengths[i] + lengths - inter) - 1e-9).sum() - 1
    assert {name for name, count in zip(label, links, strict=True) if count} == {keys[0]}
