"""Document operators: hostile rows, empty tables, brute force, libraries and held-out accuracy."""

import hashlib
import struct

import numpy as np
import public_tokenizers
import pytest

pytest.importorskip("studytrail.llm")

from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from cases import COLUMNS, LONG, PROSE, ROWS, documents, rows_of  # noqa: E402
from studytrail.llm import bpe, bpe_codec, exact_dedup, language, queries, token_counts, toxicity  # noqa: E402
from studytrail.llm.words import shingles, words_of  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_words_are_alike_in_any_batch():
    texts = ["Ünder_Scored 12x, a-b", None, "", LONG, "under scored 12X a b"]
    whole = [w.tolist() for w in words_of(texts)]
    assert [len(w) for w in whole] == [5, 0, 0, 160_011, 5]
    assert whole == [next(words_of([t])).tolist() for t in texts]
    assert whole[0][1:] == whole[4][1:]
    assert len(shingles(next(words_of(["a b c"])), 5)) == 1


def test_exact_dedup_rows(spark, docs):
    got = rows_of(exact_dedup.copy_groups(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    want, groups = [], {}
    for r in ROWS:
        groups.setdefault(r[1] or "", []).append(r[0])
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        stays = ids.index(keep)
        want += [(d, keep, len(ids), i == stays, sha(text.encode())) for i, d in enumerate(ids)]
    assert got == sorted(want, key=repr)
    kept = exact_dedup.drop_copies(docs)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id or -1, sha((r.text or "").encode())) for r in kept.collect()) == sorted((w[0] or -1, w[4]) for w in want if w[3])
    assert exact_dedup.copy_groups(docs.limit(0)).count() == exact_dedup.drop_copies(docs.limit(0)).count() == 0


def test_one_text_holds_most_rows(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.copy_groups(rows).groupBy("keep_id", "group_size").agg(F.sum(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).where("n > 1").collect()
    assert [tuple(r) for r in got] == [(5999, 4000, 1, 4000)]
    assert exact_dedup.drop_copies(rows).count() == 2001


def test_codec_and_counts_on_hostile_rows(docs, library):
    ids = {t: library.encode(t or "", add_special_tokens=False).ids for t in {r[1] for r in ROWS}}
    want = [(r[0], len(ids[r[1]]), sha(struct.pack(f"<{len(ids[r[1]])}I", *ids[r[1]])), sha(library.decode(ids[r[1]], skip_special_tokens=False).encode())) for r in ROWS]
    assert rows_of(bpe_codec.digests(docs, PATH)) == sorted(want, key=repr)
    want = [(r[0], len((r[1] or "").encode()), len(ids[r[1]]), len(ids[r[1]]) > 1024) for r in ROWS]
    assert rows_of(token_counts.token_counts(docs, PATH)) == sorted(want, key=repr)
    coded = bpe_codec.encoded(docs, PATH)
    assert rows_of(bpe_codec.decoded(coded, PATH)) == sorted(((r[0], r[1] or "") for r in ROWS), key=repr)
    assert bpe_codec.digests(docs.limit(0), PATH).count() == token_counts.token_counts(docs.limit(0), PATH).count() == 0


def test_whole_tables_against_the_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    ids = dict(zip(texts, (e.ids for e in library.encode_batch(list(texts.values()), add_special_tokens=False)), strict=True))
    for r in queries.op5_bpe_codec(spark, sf_dir).collect():
        assert (r.n_tokens, r.ids_sha256) == (len(ids[r.doc_id]), sha(np.array(ids[r.doc_id], "<u4").tobytes()))
        assert r.decoded_sha256 == sha(texts[r.doc_id].encode())
    assert {r.doc_id: r.n_tokens for r in queries.op7_token_counts(spark, sf_dir).collect()} == {d: len(i) for d, i in ids.items()}


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n\x1c\x85\xa0　'strevmld<|endoftext|>ab1%é中"), st.characters(exclude_categories=("Cs",), max_codepoint=0xD7FF)), max_size=60))
def test_any_text_encodes_as_the_library_does(library, text):
    want = library.encode(text, add_special_tokens=False).ids
    codec = bpe_codec.codec(PATH)
    got = b"".join(codec.encode(text))
    assert np.frombuffer(got, "<u4").tolist() == want
    assert codec.decode(got) == text.encode()
    assert token_counts.counter(PATH).count(text) == len(want)


def test_whole_tokens_are_proven(library):
    words = bpe.vocabulary(PATH)
    for i in range(0, 50_256, 37):
        assert (words.merged(words.text[i]) == [i]) == (i in words.whole)
    long = b"ab cd" * 40
    assert words.merged(long) == words._merged_short([words.byte[b] for b in long]) == bpe_codec.codec(PATH).ids(long)


def test_language_of_hostile_rows(spark, docs):
    model = language.learn(docs)
    got = {(r.doc_id, r.lang_pred, r.score > 0) for r in language.identified(docs, model).collect()}
    assert {(3, "und", False), (4, "und", False), (7, "und", False)} <= got
    assert (1, "en", True) in got and (8, "fr", True) in got
    empty = language.learn(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in language.identified(docs, empty).collect()} == {("und", 0.0)}
    assert language.identified(docs.limit(0), model).count() == 0


def test_language_mixture():
    rng = np.random.default_rng(1)
    like = np.log(rng.dirichlet([1, 1, 1], 400))
    like[:300] = np.log([0.9, 0.05, 0.05])
    like[300:] = np.log([0.05, 0.05, 0.9])
    share = language.mixtures(like.astype(np.float32), np.zeros(400, int), 2)
    assert share[0].round(2).tolist() == pytest.approx([0.75, 0.0, 0.25], abs=0.05)
    assert share[0][1] == 0 and share[1].sum() == 0


def test_language_accuracy_on_held_out_rows(spark, sf_dir):
    got = queries.op1_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_on_hostile_rows(spark, docs):
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, None), (None, 1), (6, 0), (99, 1), (4, 5)], "doc_id bigint, toxic int")
    got = toxicity.scored(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    none = toxicity.train(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.scored(docs, none).collect()} == {0}
    assert toxicity.drop_toxic(docs, none).schema == docs.schema and toxicity.drop_toxic(docs, none).count() == len(ROWS)
    assert toxicity.scored(docs.limit(0), none).count() == 0


def test_factors_learn_pairs():
    """Insult and group mention together are toxic, each alone is not, nor are many single ones."""
    rng = np.random.default_rng(3)
    x = (rng.random((4000, 12)) < 0.3).astype(np.uint8)
    y = ((x[:, 0] & x[:, 1]) | (x[:, 2] & x[:, 3])).astype(float)
    bias, weight, factor = toxicity.fit(x, y, np.ones(len(x)), steps=400)
    machine = toxicity.Machine(bias, np.arange(12, dtype=np.uint32), weight, factor)
    got = np.array([machine.score(np.flatnonzero(r).astype(np.uint32)) >= 0.5 for r in x])
    assert (got == (y > 0)).mean() > 0.99
    linear = np.linalg.lstsq(np.c_[x, np.ones(len(x))], y, rcond=None)[0]
    assert ((np.c_[x, np.ones(len(x))] @ linear >= 0.5) == (y > 0)).mean() < 0.97


def test_toxicity_on_held_out_rows(spark):
    """Planted insults, inflected in one language, against prose without them."""
    rng = np.random.default_rng(5)
    plain, rows = PROSE.split(), []
    for i in range(1200):
        words, toxic = list(rng.choice(plain, 60)), int(i % 8 == 0)
        if toxic:
            words[int(rng.integers(60))] = "Moron!"
            words[int(rng.integers(60))] = "lowei" + "".join(rng.choice(list("abcdefg"), 3))
        rows.append((i, " ".join(words), toxic))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    got = toxicity.scored(table, toxicity.train(table, table.select("doc_id", "toxic"))).join(table.select("doc_id", "toxic"), "doc_id")
    held = got.where("held_out").collect()
    assert len(held) > 150 and np.mean([r.toxic == r.predicted for r in held]) > 0.98


def test_extra_columns_keep_their_place(docs):
    assert docs.columns[:5] == [c.split()[0] for c in COLUMNS.split(", ")]
    assert exact_dedup.drop_copies(docs).columns == docs.columns
