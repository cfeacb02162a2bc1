"""Token groups, links and their corpus counts against a walk over both tokenizers' whole encodings."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("studytrail.llm")

import public_tokenizers  # noqa: E402
from cases import documents, rows_of  # noqa: E402
from studytrail.llm import alignment  # noqa: E402

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
PARTS = [
    " ", "  ", "\n", "\t", "\r\n", ";\r", "a", "b", "the", "walking", "é", "ж", "🙂", "中", "​", "\x1c", "\x00", "▁", "　", "'s", "1", ".",
    "<s>", "<|endoftext|>", "<0x0A>", "x" * 50, "ﬁ", "é", "<unk>", " ",
]


def walked(pair, text):
    """(ids of A, ids of B, groups, links) of one text, or None."""
    if not text:
        return None
    raw = (" " + text).encode()
    ids = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    tables = pair.bytes_a, pair.bytes_b
    if any(b"".join(t[i] for i in side) != raw for side, t in zip(ids, tables)):
        return None
    (a, b), groups, links = ids, [], []
    i = j = first_i = first_j = end_a = end_b = 0
    end_a, end_b = len(tables[0][a[0]]), len(tables[1][b[0]])
    while i < len(a) and j < len(b):
        links.append((a[i], b[j]))
        here_a, here_b = end_a <= end_b, end_b <= end_a
        if here_a and here_b:
            groups.append(",".join(map(str, a[first_i : i + 1])) + "|" + ",".join(map(str, b[first_j : j + 1])))
            first_i, first_j = i + 1, j + 1
        if here_a:
            i += 1
            end_a += len(tables[0][a[i]]) if i < len(a) else 0
        if here_b:
            j += 1
            end_b += len(tables[1][b[j]]) if j < len(b) else 0
    return a, b, groups, links


def brute(pair, rows):
    found = [(i, walked(pair, t)) for i, t in rows]
    counts = Counter(link for _, f in found if f for link in f[3])
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        best = sum(counts[x] == highest[x[1]] for x in links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((i, len(a), len(b), len(groups), len(links), best, sum(counts[x] for x in links), sha))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [alignment.BLOCK, 2000])
def test_random_texts(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 30))) for _ in range(400)]
    texts += [t.replace("▁", "") for t in texts] + [None, "", " ", "\n"]
    rows = list(enumerate(texts)) + [(None, "the the"), (None, None), (3, "again the"), (3, "again the")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert rows_of(alignment.aligned(docs, A, B), *NAMES) == brute(alignment.pair_of(A, B), rows)


def test_cases(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = alignment.aligned(docs, A, B)
    assert rows_of(got, *NAMES) == brute(alignment.pair_of(A, B), rows)
    assert rows_of(alignment.aligned(docs.limit(0), A, B)) == []


def test_whole_texts_give_the_same(spark, monkeypatch):
    """Where the border before a blank cannot be proven, texts are encoded whole."""
    pair = alignment.pair_of(A, B)
    text = "one  two\r\n three 🙂🙂 жж;\r <s> end \n"
    by_chunk = pair.records(pair.chunk.findall(" " + text))
    monkeypatch.setattr(pair, "chunk", alignment.WHOLE)
    (whole,) = pair.records([" " + text])
    assert ";".join(r[3] for r in by_chunk) == whole[3]
    assert [c for r in by_chunk for c in r[4].tolist()] == whole[4].tolist()


def test_long_texts_and_a_full_cache(spark, monkeypatch):
    monkeypatch.setattr(alignment, "LONG", 100)
    monkeypatch.setattr(alignment, "KEPT", 5)
    monkeypatch.setattr(alignment, "BLOCK", 300)
    rows = [(i, f"word{i} " * 40 + "é" * i) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    assert rows_of(alignment.aligned(docs, A, B), *NAMES) == brute(alignment.pair_of(A, B), rows)


def test_links_by_token(spark):
    rows = [(1, "the cat"), (2, "the dog")]
    made = alignment.blocks(spark.createDataFrame(rows, "doc_id bigint, text string"), A, B)
    pair = alignment.pair_of(A, B)
    counts = Counter(x for _, t in rows for x in walked(pair, t)[3])
    assert {(r.a, r.b): r["count"] for r in alignment.link_counts(made, A, B).collect()} == counts


def test_words_are_encoded_once_whatever_follows_them(spark):
    """a word was encoded again with each mark behind it."""
    pair = alignment.pair_of(A, B)
    words, marks = ["the", "walking", "Zürich", "год", "x2", "1999"], [".", ",", ";", "?!", ")", "...", "'s"]
    known = alignment.Chunks(pair)
    texts = [w + m + " " + w for m in marks for w in words]
    for t in texts:
        known.numbers(t)
    assert sorted(known) == sorted([" " + w for w in words] + marks)
    texts += [w + m + v for m in [*marks, "\n", ".\n\n", "\u2028"] for w, v in zip(words, ["中文", "a_b", "http://ex.org/a?b=1", "🙂", "don't", ""])]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    assert rows_of(alignment.aligned(docs, A, B), *NAMES) == brute(pair, rows)


def test_parts_are_the_text():
    """Cuts are before blanks after a word and before marks after a letter or digit, nowhere else, and change no record."""
    pair = alignment.pair_of(A, B)
    assert pair.chunk is alignment.PARTS
    rng = random.Random(5)
    parts = [p for p in PARTS if p != "▁"] + [",", ":", "-", "\n", "Z", "ß", "7", "ª", "²", "́"]
    cut = re.compile(rf"(?<=[^{alignment.SPACE}])(?= )|(?<=[{alignment.LETTER}])(?=[{alignment.AFTER}])")
    for _ in range(500):
        text = " " + "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))
        chunks = pair.chunk.findall(text)
        assert chunks == cut.split(text) and [m.group() for m in pair.chunk.finditer(text)] == chunks
        by_part, by_word = pair.records(chunks), pair.records(alignment.CHUNK.findall(text))
        for i in range(3):
            assert sum(r[i] for r in by_part) == sum(r[i] for r in by_word)
        assert ";".join(r[3] for r in by_part) == ";".join(r[3] for r in by_word)
        assert [c for r in by_part for c in r[4].tolist()] == [c for r in by_word for c in r[4].tolist()]


@pytest.mark.parametrize("part", [alignment.PART, 7])
def test_rows_hold_one_text_or_a_part_of_a_block(spark, monkeypatch, part):
    """a block of texts was one row of some MB, which the JVM held several times over as it was shuffled and joined."""
    monkeypatch.setattr(alignment, "PART", part)
    rows = [(i, f"word{i} and some other{i % 7} words of text {i}" * (1 + i % 3)) for i in range(300)] + [(None, None), (400, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    made = alignment.blocks(docs, A, B).select("block", "chunks", "links", "pairs").collect()
    assert len({r.block for r in made}) == 2
    longest = max(len(alignment.pair_of(A, B).chunk.findall(" " + t)) for _, t in rows if t)
    assert max(len(r.chunks or b"") for r in made) == 4 * longest
    assert max(len(r.pairs or ()) for r in made) <= part
    assert rows_of(alignment.aligned(docs, A, B), *NAMES) == brute(alignment.pair_of(A, B), rows)


def test_numbers_stored_by_bytes():
    for values in ([], [0], [1, 255, 256, 1 << 20, (1 << 32) - 1]):
        assert alignment._unpacked(alignment._packed(np.array(values, np.int64))).tolist() == values
