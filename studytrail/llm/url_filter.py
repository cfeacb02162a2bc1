"""URL filter: host rules first, then a weighted vocabulary found by an Aho-Corasick automaton.

Terms count where neither neighbour is an ASCII letter or digit. One strict term, or ``soft_limit`` distinct soft
terms, block a url that no rule fits. A rule fits its host and all subdomains if the path starts with the rule's path;
of several the longest wins. Null urls and urls without ``://`` have empty host and path, which no rule fits; a null
url has no terms and is allowed. Repeated rows are judged alike; an empty table gives an empty one; extra columns
are ignored.
"""

from __future__ import annotations

import functools

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRICT = ("adult", "casino", "escort", "gambling", "hentai", "malware", "phishing", "porn", "spam", "torrent", "viagra", "xxx")
SOFT = (
    "ad", "ads", "bet", "bets", "bonus", "buy", "cheap", "click", "coupon", "deal", "discount", "free", "jackpot",
    "loan", "lottery", "pill", "pills", "poker", "prize", "promo", "sex", "slots", "track", "tracker", "win", "winner",
)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
SCHEMA = "page_id bigint, host string, path string, rule string, verdict string, strict_hits int, soft_hits int"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)


@functools.cache
def automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for kind, terms in ((0, soft), (1, strict)):
        for term in terms:
            words.add_word(term, (term, kind))
    if len(words):
        words.make_automaton()
    return words


def plain(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def hits(url: str, words: ahocorasick.Automaton) -> tuple[int, int]:
    """Distinct strict and soft terms of a url."""
    url, found = url.translate(FOLD), set()
    for end, (term, kind) in words.iter(url) if len(words) else ():
        start = end - len(term)  # of the character before
        if not (start >= 0 and plain(url[start])) and not (end + 1 < len(url) and plain(url[end + 1])):
            found.add((term, kind))
    strict = sum(kind for _, kind in found)
    return strict, len(found) - strict


def by_host(rules) -> dict[str, list[tuple[str, str, str]]]:
    out: dict[str, list[tuple[str, str, str]]] = {}
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        host, slash, path = rule.partition("/")
        out.setdefault(host, []).append((slash + path, rule, verdict))
    return out


def rule_for(host: str, path: str, rules) -> tuple[str | None, str | None]:
    best, verdict, at = None, None, 0
    while True:
        for start, rule, v in rules.get(host[at:], ()):
            if path.startswith(start) and (best is None or len(rule) > len(best)):
                best, verdict = rule, v
        dot = host.find(".", at)
        if dot < 0:
            return best, verdict
        at = dot + 1


def judge_urls(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = 2) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits and soft_hits of every page."""
    url = F.col("url")
    part = lambda n: F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)([^?#]*)", n), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint"), url, F.translate(part(1), UPPER, LOWER).alias("host"), part(2).alias("path"))
    known, strict, soft = by_host(rules), tuple(strict), tuple(soft)

    def judge(batches):
        words = automaton(strict, soft)
        for b in batches:
            out = []
            for u, host, path in zip(b["url"].to_pylist(), b["host"].to_pylist(), b["path"].to_pylist(), strict=True):
                rule, verdict = rule_for(host, path, known)
                n_strict, n_soft = hits(u or "", words)
                out.append((rule, verdict or ("block" if n_strict or n_soft >= soft_limit else "allow"), n_strict, n_soft))
            rule, verdict, n_strict, n_soft = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], b["host"], b["path"], pa.array(rule, pa.string()), pa.array(verdict, pa.string()),
                 pa.array(n_strict, pa.int32()), pa.array(n_soft, pa.int32())],
                names=["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits"],
            )

    return rows.mapInArrow(judge, SCHEMA)
