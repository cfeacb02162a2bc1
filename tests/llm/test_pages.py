"""Page operators: hostile rows, empty tables, brute force and round trips."""

import base64
import gzip
import hashlib
import io
import re
from html import unescape

import pytest

pytest.importorskip("studytrail.llm")

from cases import PAGES, pages, rows_of  # noqa: E402
from studytrail.llm import main_text, queries, url_filter, warc  # noqa: E402
from studytrail.session import shared_folder  # noqa: E402


@pytest.fixture(scope="module")
def hostile(spark):
    return pages(spark).cache()


def test_urls(hostile):
    got = {(r.page_id, r.url_host): r for r in url_filter.judge_urls(hostile).withColumnRenamed("host", "url_host").collect()}
    assert len(got) == len(PAGES) - 1  # one row comes twice
    assert (got[1, "a.example.net"].path, got[1, "a.example.net"].rule, got[1, "a.example.net"].verdict) == ("/en/x", "example.net/en/", "allow")
    assert (got[2, "b.example.net"].path, got[2, "b.example.net"].rule, got[2, "b.example.net"].verdict) == ("", None, "allow")
    assert (got[3, ""].path, got[3, ""].verdict, got[None, "x.org"].rule) == ("", "allow", "org/fr/")
    assert (got[None, "casino.example.com"].verdict, got[7, "free-bets.example.com"].verdict) == ("block", "block")
    assert (got[7, "free-bets.example.com"].soft_hits, got[8, "y.example.com"].rule) == (3, None)
    assert got[6, "h.example.com"].rule == "example.com/de/"
    assert url_filter.judge_urls(hostile.limit(0)).count() == 0


@pytest.mark.parametrize(("url", "hits"), [
    ("http://casino.x", (1, 0)), ("http://casinos.x", (0, 0)), ("http://x/CASINO", (1, 0)), ("free", (0, 1)),
    ("free-free", (0, 1)), ("free_bet", (0, 2)), ("xfree bet1", (0, 0)), ("", (0, 0)), ("éwin", (0, 1)),
])
def test_boundaries(url, hits):
    assert url_filter.hits(url, url_filter.automaton(url_filter.STRICT, url_filter.SOFT)) == hits


def test_rules_by_length():
    rules = url_filter.by_host([("b.c/", "block"), ("a.b.c/", "allow"), ("c/x/long/path/", "block"), ("c/", "allow")])
    assert url_filter.rule_for("z.a.b.c", "/x", rules) == ("a.b.c/", "allow")
    assert url_filter.rule_for("a.b.c", "/x/long/path/y", rules) == ("c/x/long/path/", "block")
    assert url_filter.rule_for("bc", "/", rules) == (None, None)


def test_archives_of_hostile_rows(spark, hostile):
    got = rows_of(warc.archive_roundtrip(hostile), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        first = min((p for p, _, h in PAGES if (h or "") == (html or "") and p is not None), default=None)
        revisit = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((page, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(want, key=repr)
    assert warc.archive_roundtrip(hostile.limit(0)).count() == 0
    small = {r.page_id: r.record_type for r in warc.archive_roundtrip(hostile, min_bytes=10).collect()}
    assert small[5] == "response" and small[2] == "revisit"


def test_archive_is_a_valid_file(spark, hostile):
    folder = shared_folder(spark, "warc")
    warc.write_archives(hostile.coalesce(1), folder)
    found = warc.read_archives(spark, folder).collect()
    assert len(found) == len(PAGES) and all(r.intact for r in found)
    files = [r.path.removeprefix("file:") for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path").collect()]
    raw = b"".join(gzip.open(f).read() for f in files)
    at, n = 0, 0
    while at < len(raw):  # by the format alone
        head, _, _ = raw[at:].partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1" and all(": " in x for x in lines[1:]) and not any(x.startswith("Injected") for x in lines)
        at += len(head) + 4 + int(dict(x.split(": ", 1) for x in lines[1:])["Content-Length"])
        assert raw[at : at + 4] == b"\r\n\r\n"
        at, n = at + 4, n + 1
    assert n == len(PAGES)


def test_digests_are_those_of_the_payloads_read(spark):
    """A damaged payload shows in the response and in its revisits; a revisit without a response has none."""
    sha = lambda data: base64.b32encode(hashlib.sha1(data).digest()).decode()
    record = lambda name, kind, payload, *more: "\r\n".join([
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Payload-Digest: sha1:{sha(b'good')}", f"Page-Id: {name}", *more,
        f"Content-Length: {19 + len(payload)}", "", "HTTP/1.1 200 OK\r\n\r\n" + payload, "", "",
    ]).encode()
    data = record(1, "response", "good") + record(2, "response", "gone") + record(3, "revisit", "", "WARC-Refers-To: <2>")
    data += record(4, "revisit", "", "WARC-Refers-To: <1>") + record(5, "revisit", "", "WARC-Refers-To: <9>")
    read = spark.createDataFrame(list(warc.parse(io.BytesIO(data))), warc.READ)
    got = rows_of(warc.resolved(read), "page_id", "payload_bytes", "payload_digest", "refers_to", "intact")
    good, bad = sha(b"good"), sha(b"gone")
    assert got == [(1, 4, good, None, True), (2, 4, bad, None, False), (3, 4, bad, 2, False), (4, 4, good, 1, True), (5, None, None, None, False)]


def test_main_text_of_hostile_rows(hostile):
    got = {(r.page_id, r.text, r.n_chars) for r in main_text.main_text(hostile).collect()}
    long = "\n".join(["long text"] * 60_000)
    assert got == {
        (1, "a", 1), (2, "a", 1), (3, "", 0), (4, "", 0), (5, "", 0), (None, "loose & free", 12), (None, "", 0),
        (6, long, len(long)), (7, "one\ntwo", 7), (8, "é\U0001f600", 2),
    }
    assert main_text.main_text(hostile).count() == len(PAGES)
    assert main_text.main_text(hostile.limit(0)).count() == 0


def test_main_text_of_whole_table(spark, sf_dir):
    """These pages have one article each, of headings and paragraphs: a plain cut gives the same."""
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op3_main_text(spark, sf_dir).collect():
        inner = re.search(r"<article>(.*)</article>", html[r.page_id], re.S)[1]
        parts = (" ".join(unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


@pytest.mark.parametrize(("html", "want"), [
    ("<header>H</header><article><header><h1>T</h1></header>x<footer>f</footer></article><aside>s</aside>", ["T", "x"]),
    ("<main><p>a<b>b</b><br>c<p>d<ul><li>e<li>f</ul><form>g</form><div class='post comments'><p>h</div>i</main>", ["ab c", "d", "e", "f", "i"]),
    ("<article>a &lt;b&gt; &eacute;&#233;&nbsp;c<script>if (a<b) x('</p>')</script><style>y</style><!-- <p>z --></article>", ["a <b> éé c"]),
    ("<article><div id=cookie-notice>n</div><div role='navigation'>m</div><div class=ad>o</div><div class=adapt>p</div></article>", ["p"]),
    ("<article><section class='related-work'>r</section><p id='widget-theory'>w</p><div class='story share-of-market'>s</div></article>", ["r", "w", "s"]),
    ("<main><div class='related-posts'>r</div><div id='comment-list-2'>c</div><div class='x social-share'>s</div><div class=ad-slot>a</div>t</main>", ["t"]),
    ("<article>x < y <p title='a>b' class=\"c\">z</article", ["x < y", "z"]),
])
def test_structure(html, want):
    assert [t for t, k in main_text.blocks_of(html) if k == main_text.MAIN_TEXT] == want


def test_repeated_runs_go_and_unique_ones_stay(spark):
    """Pages without structure: a host's repeated words are boilerplate, copies of a page and other hosts are not."""
    menu = "start here news sport weather travel culture science opinion contact imprint help"
    body = [" ".join(f"{w}{i}" for w in "own words of this page which no other page of the host has in it".split()) for i in range(6)]
    rows = [(i, f"http://h.example/{i}", f"<div>{menu}</div><div>{b}</div>") for i, b in enumerate(body)]
    rows += [(10 + i, f"http://copies.example/{i}", f"<div>{body[0]} once more and again</div>") for i in range(4)]
    rows += [(20, "http://other.example/", f"<div>{menu}</div>")]
    got = {r.page_id: r.text for r in main_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [got[i] for i in range(6)] == body
    assert {got[10 + i] for i in range(4)} == {body[0] + " once more and again"}
    assert got[20] == menu


def test_repetition_decides_beside_a_main_part_too(spark):
    """pages with an article never met the array: whatever stood outside it went, repeated or not."""
    menu = "start here news sport weather travel culture science opinion contact imprint help"
    intro = [" ".join(f"{w}{i}" for w in "a long unmarked introduction that stands before the article of this page".split()) for i in range(4)]
    page = "<nav>home</nav><div>{}</div><p>{} {}</p><article><p>own text {}</article><div>few words {}</div>"
    rows = [(i, "http://h.example/", page.format(menu, intro[i], menu, i, i)) for i in range(4)]
    rows += [(10 + i, "http://h.example/", f"<div>{menu}</div><article>{a}</article>") for i, a in enumerate((menu, "b"))]  # one page but for the article
    rows += [(20, "http://h.example/", f"<div>{menu}</div>other words"), (30, "http://other.example/", page.format(menu, intro[0], menu, 0, 0))]
    got = {r.page_id: r.text for r in main_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [got[i] for i in range(4)] == [f"{intro[i]}\nown text {i}" for i in range(4)]
    assert (got[10], got[11], got[20]) == (menu, "b", "other words")
    assert got[30] == f"{menu}\n{intro[0]} {menu}\nown text 0"


def test_pages_with_the_same_words_outside_different_articles_count_apart(spark):
    notice = "we set some small files on your machine so that these pages work as they should"
    rows = [(i, "http://h.example/", f"<div>{notice}</div><article>text {i}</article>") for i in range(3)]
    rows += [(10 + i, "http://g.example/", f"<div>{notice}</div><article>text</article>") for i in range(3)]  # copies
    got = {r.page_id: r.text for r in main_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: f"text {i}" for i in range(3)} | {10 + i: f"{notice}\ntext" for i in range(3)}


def test_suffixes_are_sorted_and_compared_with_their_neighbours(spark):
    """The array holds every suffix of ten words or more; brute force over all windows finds the same repeats."""
    shared = [f"s{i}" for i in range(14)]
    words = [["a"] * 12, ["x", *shared, "y"], [*shared, *shared], ["z", "z", *shared[:11]], shared[:9], ["b", *["a"] * 11]]
    rows = [(h, p, w) for h in ("h", "g") for p, w in enumerate(words) if h == "h" or p < 3]
    array = main_text.suffix_array(spark.createDataFrame(rows, "host string, page bigint, words array<string>"))
    got = array.collect()
    heads = [(h, p, i, w[i : i + 10]) for h, p, w in rows for i in range(len(w) - 9)]
    assert sorted((r.host, r.page, r.place, r.head) for r in got) == sorted(heads)
    for h in ("h", "g"):
        inside = [w for host, _, _, w in heads if host == h]
        assert sum(r.common == 10 for r in got if r.host == h) == len(inside) - len(set(map(tuple, inside)))
    pages_of = lambda h, w: {p for host, p, _, x in heads if host == h and x == w}
    want = sorted((h, p, i) for h, p, i, w in heads if len(pages_of(h, w)) >= main_text.PAGES)
    assert want and rows_of(main_text.repeats(array), "host", "page", "place") == want
