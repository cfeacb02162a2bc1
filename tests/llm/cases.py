"""Rows that every operator must bear: nulls, empty and long texts, ties, repeats, clashing extra columns."""

from pyspark.sql import types as T

CLASHING = ("key", "row", "maybe", "sha", "n", "tag", "score", "held_out", "kept", "hash", "comp", "bits", "block")
LONG = "alpha beta gamma delta " * 40_000 + "x" * 600_000 + " " + "omega " * 10
PROSE = "the quick brown fox jumps over the lazy dog while seven small birds sing above the quiet river bank today"
ROWS = [
    (1, PROSE, "en", "s", 5),
    (2, PROSE, "en", "s", 5),
    (2, PROSE, "en", "s", 5),
    (3, None, None, None, None),
    (4, "", "en", "s", 0),
    (5, "", None, "s", 0),
    (None, "no id " + PROSE, "en", None, 1),
    (None, PROSE, None, "s", 1),
    (6, LONG, "en", "s", len(LONG)),
    (7, "?!", "de", "s", 2),
    (8, "one two", "fr", "s", 7),
    (9, "One, two!", "fr", "s", 9),
    (10, PROSE + " again", "en", "s", 1),
]
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PAGES = [
    (1, "http://A.example.net/en/x?q#f", "<article><p>a</article>"),
    (2, "HTTP://b.example.net", "<article><p>a</article>"),
    (2, "HTTP://b.example.net", "<article><p>a</article>"),
    (3, None, None),
    (4, "no scheme", ""),
    (5, "", ""),
    (None, "http://x.org/fr/\r\nInjected: 1", "<p>loose &amp; free"),
    (None, "http://casino.example.com/", None),
    (6, "http://h.example.com/de/", "<main>" + "<p>long text " * 60_000 + "</main>"),
    (7, "http://free-bets.example.com/?win", "<p>one\r\n\r\n<p>two"),
    (8, "http://y.example.com/?q=://z.net/", "<article>é\U0001f600</article>"),
]
PAGE_COLUMNS = "page_id bigint, url string, html string"


def frame(spark, rows, columns):
    """A frame of these rows with extra columns of clashing names, one of them null."""
    schema = T.StructType.fromDDL(columns + "".join(f", {c} string" for c in CLASHING))
    return spark.createDataFrame([(*r, *("x" if i % 2 else None for i in range(len(CLASHING)))) for r in rows], schema)


def documents(spark, rows=ROWS):
    return frame(spark, rows, COLUMNS)


def pages(spark, rows=PAGES):
    return frame(spark, rows, PAGE_COLUMNS)


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) if names else tuple(r) for r in df.collect()), key=repr)
