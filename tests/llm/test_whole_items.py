"""Benchmark items that are too short for windows must be found word for word; those in scripts without blanks by windows of letters."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("studytrail.llm")

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from cases import documents, rows_of  # noqa: E402
from studytrail.llm import decontamination  # noqa: E402

CHINESE = "".join(chr(0x4E00 + 37 * k) for k in range(300))
ITEMS = ["Blue whale", "name the capital of France", "yes", "one two three four five six seven", "今天天气很好", CHINESE,
         "今日,は,晴,れ,で,す,ね,と,言った", "GPT是什么", "eight words are long enough for a window", None, "", "!?"]


def held(text, item):
    """All words of the item in a row, each letter of an unspaced script a word."""
    w, v = brute.units(text), brute.units(item)
    return bool(v) and any(w[i : i + len(v)] == v for i in range(len(w) - len(v) + 1))


def texts():
    rng = random.Random(2)
    plain = "small boats sail over quiet blue water while seven whales sing".split()
    some = lambda: " ".join(rng.choice(plain) for _ in range(rng.randrange(20)))
    out = [some() + " " + (i or "").upper() + ", " + some() for i in ITEMS]
    out += [f"我说{ITEMS[4]}吗", f"前{CHINESE}后", f"前{CHINESE[:-1]}后", f"彼は{ITEMS[6]}そうです", "请问gpt是什么呢", "whale blue", "yesterday"]
    out += ["one two three four five six", "the capital of France", "name the capital of france? yes", None, "", "yes " * 3000]
    return out + [some() for _ in range(20)]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(ITEMS)], "item_id bigint, text string, hash string")


def test_short_and_unspaced_items_are_found(spark, benchmark):
    rows = list(enumerate(texts()))
    docs = documents(spark, [(d, t, "en", None, 0) for d, t in rows])
    exact = {(d, i) for d, t in rows for i, item in enumerate(ITEMS) if held(t, item)}
    want = exact | {(d, i) for d, t in rows for i in brute.contaminated(t, ITEMS)}
    assert {i for _, i in exact} == set(range(9)) and len(exact) == 16
    assert rows_of(decontamination.all_overlaps(docs, benchmark), "doc_id", "item_id") == sorted(want, key=repr)
    assert {r.doc_id: r.n_items for r in decontamination.judged(docs, benchmark).collect()} == {d: sum(d == e for e, _ in want) for d, _ in want}


def test_passages_of_unspaced_scripts(spark, benchmark):
    """One letter replaced, long and short passages word for word, beside spaced words and within them."""
    item, at = CHINESE, ITEMS.index(CHINESE)
    found = [item[:150] + "错" + item[151:], "前" + item[20:170] + "后", item[100:230], "so " + item[40:52] + " it is", f"a{item[7:20]}b", "\n".join(item[:40])]
    clean = [item[:9], item[100:110] + "错错错错", "前" + item[::-1], "".join(f"{c}错" for c in item)]
    rows = list(enumerate(found + clean))
    assert [at in brute.contaminated(t, ITEMS) for _, t in rows] == [True] * len(found) + [False] * len(clean)
    docs = documents(spark, [(d, t, "zh", None, 0) for d, t in rows])
    got = rows_of(decontamination.all_overlaps(docs, benchmark), "doc_id", "item_id")
    assert got == [(d, at) for d in range(len(found))]
    assert sorted(r.doc_id for r in decontamination.clean_rows(docs, benchmark).collect()) == list(range(len(found), len(rows)))


def test_filter_grows_with_the_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "LEAST_BITS", 1 << 10)
    sizes = []
    for n in (1, 40):
        items = spark.range(n).select("id", (F.col("id") * 2654435761).alias("hash"))
        bloom = decontamination.seed_filter(items)
        sizes.append(len(bloom))
        hashes = np.array([r["hash"] for r in items.collect()], np.int64).view(np.uint64)
        assert len(decontamination.passed(bloom, hashes)) == n
    assert sizes == [128, 8192]


def test_pipeline_drops_them(spark, benchmark, tmp_path):
    rows = list(enumerate(texts()))
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, [(d, t, "en", None, 0) for d, t in rows])
    kept = corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path))
    assert kept.schema == docs.schema
    clean = [d for d, t in rows if not any(held(t, i) for i in ITEMS) and not brute.contaminated(t, ITEMS)]
    assert sorted(r.doc_id for r in kept.collect()) == clean and 20 <= len(clean) < len(rows) - 12


def test_rows_are_judged_by_their_text(spark, benchmark, tmp_path):
    """Contaminated rows without an id go; clean ones stay that share an id with a contaminated row or have none."""
    long = ITEMS[8]
    rows = [(None, long + " here"), (None, "so yes"), (None, "a clean row"), (1, long), (1, "another clean row"), (2, "yes"), (2, None), (3, long)]
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, [(d, t, "en", None, 0) for d, t in rows])
    kept = corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path))
    assert kept.schema == docs.schema
    assert rows_of(kept, "doc_id", "text") == sorted([rows[2], rows[4], rows[6]], key=repr)
