"""One query per operator over its whole table, and the SQL that checks it where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from studytrail.llm import (
    alignment, bpe_codec, decontamination, exact_dedup, language, main_text, mixing, near_dups, search, token_counts, toxicity, url_filter, warc,
)
from studytrail.llm.bpe import LARGE
from studytrail.llm.tables import table


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identified(docs, language.learn(docs.where(~language.held_out())))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(table(spark, sf_dir, "documents"), VOCABULARY, LARGE)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), VOCABULARY, kept=LARGE)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_roundtrip(table(spark, sf_dir, "pages")).drop("intact")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), VOCABULARY, PIECES)


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = (
    op1_language, op2_exact_dedup, op3_main_text, op4_url_filter, op5_bpe_codec, op6_toxicity, op7_token_counts,
    op8_decontamination, op9_jaccard_join, op10_warc, op11_mixing, op12_alignment, op13_search,
)


def all_queries() -> dict:
    return {f.__name__: f for f in QUERIES}


#: a term of the search (fixed value)
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP2 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

OP4 = """
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{upper}', '{lower}') AS folded,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), '{upper}', '{lower}') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), judged AS (
  SELECT *, CASE
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
    {strict} AS strict_hits, {soft} AS soft_hits
  FROM parts
)
SELECT page_id, host, path, rule, CASE rule
    WHEN 'example.com/de/' THEN 'block' WHEN 'net/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
    ELSE CASE WHEN strict_hits > 0 OR soft_hits >= 2 THEN 'block' ELSE 'allow' END END AS verdict,
  CAST(strict_hits AS INTEGER) AS strict_hits, CAST(soft_hits AS INTEGER) AS soft_hits
FROM judged
"""

OP10 = """
WITH digests AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), coded AS (
  SELECT page_id, payload, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(hex, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1)), '') AS digest
  FROM digests
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM coded
)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""

OP13 = r"""
WITH words AS (
  SELECT rowid AS r, doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term}')) AS term
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)
), tfs AS (
  SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY r, doc_id, term
), lengths AS (
  SELECT r, sum(tf) AS n FROM tfs GROUP BY r
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term}')) AS term FROM benchmark
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term, n_docs
), impacts AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + CAST((50 * n * n_docs) // n_terms AS BIGINT)))) AS impact
  FROM tfs JOIN lengths USING (r) JOIN weights USING (term), totals WHERE term IN (SELECT term FROM asked)
), scores AS (
  SELECT item_id, r, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""


def all_statements() -> dict[str, str]:
    def counted(terms) -> str:
        match = "CAST(regexp_matches(folded, '(^|[^a-z0-9]){}($|[^a-z0-9])') AS INTEGER)"
        return "(" + " + ".join(match.format(t) for t in terms) + ")"

    op4 = OP4.format(
        upper=url_filter.UPPER, lower=url_filter.LOWER, strict=counted(url_filter.STRICT), soft=counted(url_filter.SOFT)
    )
    op13 = OP13.format(upper=url_filter.UPPER, lower=url_filter.LOWER, term=TERM)
    return {"op2_exact_dedup": OP2, "op4_url_filter": op4, "op10_warc": OP10, "op13_search": op13}
