"""Main text of web pages: page structure, and a host suffix array for what has no structure.

A page is cut into blocks of text. Blocks inside ``article`` or ``main`` are the main text, unless they stand in a menu,
header, footer, sidebar, notice, advert, form or reader comments, by element, role, class or id. Of every page, the blocks outside
both the main part and those elements are candidates, and repetition decides: the words outside the main parts
of a host's pages are taken page by page, their suffixes sorted by host and first ``RUN`` words, and each is compared with
its neighbour in that array. Suffixes between neighbours that share ``RUN`` words, if they come from ``PAGES`` or more
different pages, mark repeated substrings (a longer one is the union of its windows). Words that such substrings cover are
boilerplate; the unique runs stay, beside a main part those of ``RUN`` words or more: shorter ones have no suffix to judge them by.

Suffixes are dealt by their first words and sorted in Spark's tasks, so a host may be of any size. Pages with the same words count once
there, so copies of a page do not turn its text into boilerplate.

Null html is empty and gives an empty text; null urls belong to one host without name; repeated rows are extracted
alike; an empty table gives an empty one; other columns are ignored. Very long pages are worked off one at a time.
"""

from __future__ import annotations

import hashlib
import html as references
import itertools
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from studytrail.llm.words import slices
from studytrail.session import BATCH, bounded_batches

RUN, PAGES = 10, 3
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody tfoot thead tr ul".split()
)
CELLS = frozenset(("td", "th", "br"))  # stand apart inside a block
ASIDE = frozenset("nav footer aside form dialog menu head button select svg canvas object audio video".split())
MAIN = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header masthead menu modal nav navbar navigation newsletter notice notices notification pagination popup promo related "
    "replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: words that say how an element is laid out, not what it holds (fixed values)
LAYOUT = frozenset(
    "area articles bar block box btn button buttons container content form group icons inline inner item items left link links list main "
    "outer panel posts right row section slot thread title top bottom unit wrap wrapper zone".split()
)
MASTHEADS = frozenset("header banner masthead".split())  # inside the main part they are the article's own
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)|([^<]++|<)", re.S
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
SPLIT = re.compile(r"[^a-z0-9]+")
KINDS = MAIN_TEXT, PLAIN, BOILERPLATE = range(3)


def marked(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element holds boilerplate; inside: it stands in the main part.

    There a name counts only as a whole: all its words are listed or say how the element is laid out. ``related-posts`` does,
    ``related-work`` does not."""
    if tag in ASIDE or (tag == "header" and not inside):
        return True
    if tag in ("html", "body") or not attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        if name.lower() == "role":
            if value in ROLES and not (inside and value == "banner"):
                return True
            continue
        for whole in value.split() if inside else [value]:
            parts = {p for p in SPLIT.split(whole) if p and not p.isdigit()}
            if inside and parts - MARKS - LAYOUT:
                continue
            if parts & MARKS - MASTHEADS or (parts & MARKS and not inside):
                return True
    return False


def blocks_of(html: str) -> list[tuple[str, int]]:
    """(text, kind) of the page's blocks, in order."""
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements, each with the kind of what stands in it
    kind, at = PLAIN, 0

    def flush():
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                out.append((text, kind))
            parts.clear()

    while found := TOKEN.match(html, at):
        at = found.end()
        close, tag, attributes, text = found.groups()
        if text is not None:
            parts.append(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag in CELLS:
            parts.append(" ")
            if tag == "br":
                continue
        elif tag in BLOCKS or tag in ASIDE:
            flush()
        if close:
            if any(t == tag for t, _ in reversed(stack)):
                while stack.pop()[0] != tag:
                    pass
                if stack and stack[-1][1] != kind or not stack and kind != PLAIN:
                    flush()
                kind = stack[-1][1] if stack else PLAIN
            continue
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
            at = len(html) if end is None else end.start()
            stack.append((tag, kind))
            continue
        closing = tag if tag in ("li", "tr", "td", "th", "dd", "dt", "option") else "p" if tag in BLOCKS else None
        if closing:  # their end tags may be left out
            for i in range(len(stack) - 1, -1, -1):
                name = stack[i][0]
                if name == closing:
                    flush()
                    del stack[i:]
                    kind = stack[-1][1] if stack else PLAIN
                    break
                if name in BLOCKS:
                    break
        if kind != BOILERPLATE:
            inner = BOILERPLATE if marked(tag, attributes, kind == MAIN_TEXT) else MAIN_TEXT if tag in MAIN else kind
            if inner != kind:
                flush()
                kind = inner
        stack.append((tag, kind))
    flush()
    return out


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def _identity(host: str, words: str, main: list[str]) -> int:
    """64 bits of a page's host and its words outside and inside its main part."""
    return int.from_bytes(hashlib.blake2b("\n".join([host, words, *main]).encode(), digest_size=8).digest(), "big", signed=True)


def _packed(blocks: list[tuple[str, int]]) -> bytes:
    """Blocks by line, each after its kind."""
    return zlib.compress("\n".join(f"{kind}{text}" for text, kind in blocks).encode(), 1)


def _unpacked(packed: bytes) -> list[tuple[str, int]]:
    return [(line[1:], int(line[0])) for line in zlib.decompress(packed).decode().split("\n") if line]


def _parsed(pages: DataFrame, texts: bool) -> DataFrame:
    """host and page (equal for copies) of every page; with texts also its page_id, url and packed blocks of main text and candidates, else
    the words outside the main part, candidates first."""

    def work(batches):
        for b in batches:
            for at, htmls in slices(b["html"]):
                rows = slice(at, at + len(htmls))
                page, words, blocks = [], [], []
                for host, html in zip(b["host"][rows].to_pylist(), htmls, strict=True):
                    found = blocks_of(html or "")
                    outside = " ".join([t for t, k in found if k == PLAIN] + [t for t, k in found if k == BOILERPLATE])
                    page.append(_identity(host, outside, [t for t, k in found if k == MAIN_TEXT]))
                    if texts:
                        blocks.append(_packed([x for x in found if x[1] != BOILERPLATE]))
                    else:
                        words.append(outside.split(" "))
                more = [b["page_id"][rows], b["url"][rows], pa.array(blocks, pa.binary())] if texts else [pa.array(words, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([b["host"][rows], pa.array(page, pa.int64()), *more], names=names)

    schema = "host string, page bigint, " + ("page_id bigint, url string, blocks binary" if texts else "words array<string>")
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    rows = pages.select(F.col("page_id").cast("bigint"), "url", "html", host_of(F.col("url")).alias("host"))
    return rows.mapInArrow(work, schema)


def suffix_array(pages: DataFrame) -> DataFrame:
    """The suffixes (host, page, place) of RUN words or more, ordered by host and first RUN words, each with ``common``: how many of these words
    the suffix before it shares (null: there is none). Order beyond RUN words decides nothing and is left open.

    Suffixes are dealt by the hash of these words, so a large host is spread; those that share them all stay neighbours. They are
    sorted before they are dealt, too, as equal beginnings then pack well. Words hold no blanks.
    """
    n = F.size("words") - RUN
    starts = F.sequence(F.lit(0), F.greatest(n, F.lit(0)))
    runs = F.when(n >= 0, F.transform(starts, lambda i: F.array_join(F.slice("words", i + 1, RUN), " ")))
    rows = pages.select("host", "page", F.posexplode(runs).alias("place", "run")).withColumn("start", F.xxhash64("run"))
    rows = rows.sortWithinPartitions("host", "run")
    rows = rows.withColumn("_before", F.lag("run").over(Window.partitionBy("host", "start").orderBy("run", "page", "place")))
    head, before = F.split("run", " "), F.split("_before", " ")
    differs = F.array_position(F.zip_with(head, before, lambda x, y: x.eqNullSafe(y)), False)
    common = F.when(F.col("run") == F.col("_before"), F.lit(RUN)).otherwise(differs.cast("int") - 1)
    return rows.withColumn("common", common).withColumn("head", head).drop("_before")


def repeats(array: DataFrame) -> DataFrame:
    """(host, page, place) of the suffixes in intervals of the array that share RUN words and come from PAGES or more different pages."""
    order = Window.partitionBy("host", "start").orderBy("run", "page", "place")
    opens = F.coalesce(F.col("common") < RUN, F.lit(True))
    other = opens | (F.lag("page").over(order) != F.col("page"))
    rows = array.withColumn("_other", other.cast("int")).withColumn("_interval", F.sum(opens.cast("int")).over(order))
    rows = rows.withColumn("_pages", F.sum("_other").over(Window.partitionBy("host", "start", "_interval")))
    return rows.where(F.col("_pages") >= PAGES).select("host", "page", "place")


def unique_blocks(blocks: list[tuple[str, int]], places: list[int]) -> list[str]:
    """The main part's blocks, and the candidates without the words that the repeated runs starting at these places cover."""
    covered = {p + k for p in places for k in range(RUN)}
    least = RUN if any(kind == MAIN_TEXT for _, kind in blocks) else 1
    out, at = [], 0
    for block, kind in blocks:
        if kind == MAIN_TEXT:
            out.append(block)
            continue
        words = block.split(" ")
        runs = [[w for _, w in run] for repeated, run in itertools.groupby(enumerate(words, at), lambda x: x[0] in covered) if not repeated]
        kept = [w for run in runs if len(run) >= least for w in run]
        at += len(words)
        if kept:
            out.append(" ".join(kept))
    return out


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def stripped(batches):
        for b in batches:
            at, held, texts = 0, 0, []
            for i, (blocks, places) in enumerate(zip(b["blocks"], b["places"], strict=True), 1):
                texts.append("\n".join(unique_blocks(_unpacked(blocks.as_py()), places.as_py() or [])))
                held += len(texts[-1])
                if held > BATCH or i == b.num_rows:
                    yield pa.RecordBatch.from_arrays([b["page_id"][at:i], b["url"][at:i], pa.array(texts, pa.string())], names=["page_id", "url", "text"])
                    at, held, texts = i, 0, []

    bounded_batches(pages.sparkSession)
    array = suffix_array(_parsed(pages, texts=False).dropDuplicates(["page"]))
    covered = repeats(array).groupBy("page").agg(F.collect_list("place").alias("places"))  # of one page
    rows = _parsed(pages, texts=True).join(covered, "page", "left").select("page_id", "url", "blocks", "places")
    return rows.mapInArrow(stripped, "page_id bigint, url string, text string").withColumn("n_chars", F.length("text").cast("bigint"))
