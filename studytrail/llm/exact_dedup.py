"""Exact deduplication by a two-pass Bloom filter, with built-in functions only.

The first pass hashes every text and counts how often each bit of the filter is hit; bits hit twice or more make the
filter of possibly repeated hashes (64 MB at most; with more rows than it is made for, more unique rows are shuffled,
with the same result). In the second pass rows outside the filter go straight through; only the others shuffle.

Null texts count as empty, and empty texts are equal. Of equal texts the row with the largest doc_id stays (a null
doc_id is smallest); of rows that repeat both text and doc_id any single one stays. An empty table gives an empty one.
Identity is SHA-256 of the text in UTF-8, unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrail.llm import tables


def _sha(column: str = "text"):
    return F.sha2(F.coalesce(F.col(column), F.lit("")), 256)


def copy_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row, dropped ones too."""
    digests = docs.select("doc_id", _sha().alias("sha"), F.monotonically_increasing_id().alias("tag"))
    digests = tables.stored(digests, "digests")
    total = digests.count()
    blocks = tables.blocks_for(total)
    bits = tables.stored(tables.filter_of(digests, "sha", blocks, times=2), "bits")
    marked = tables.maybe(digests, "sha", bits, blocks)
    repeated = marked.where("maybe").drop("maybe")
    groups = repeated.groupBy("sha").agg(F.max(F.struct("doc_id", "tag")).alias("top"), F.count(F.lit(1)).alias("n"))
    joined = tables.with_group(repeated, tables.stored(groups.where("n > 1"), "groups"), "sha", "tag", total)
    rest = marked.where(~F.col("maybe")).select(
        "doc_id", "sha", "tag", F.struct("doc_id", "tag").alias("top"), F.lit(1).cast("bigint").alias("n")
    )
    out = joined.select(
        "doc_id", "sha", "tag", F.coalesce("top", F.struct("doc_id", "tag")).alias("top"), F.coalesce("n", F.lit(1)).alias("n")
    ).unionByName(rest)
    return out.select(
        "doc_id",
        F.col("top.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("top.tag") == F.col("tag")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns. Only rows whose text may be repeated are shuffled."""
    digests = tables.stored(docs.select("doc_id", _sha().alias("sha")), "digests")
    blocks = tables.blocks_for(digests.count())
    bits = tables.stored(tables.filter_of(digests, "sha", blocks, times=2), "bits")
    top = tables.maybe(digests, "sha", bits, blocks).where("maybe").groupBy("sha").agg(F.max("doc_id").alias("keep"))
    marked = tables.maybe(tables.packed(docs, "doc_id", _sha().alias("sha")), "sha", bits, blocks)
    # joined on text and id, so that a hot text is spread by its rows' ids
    rows = marked.where("maybe")
    stay = rows.join(top, (rows["sha"] == top["sha"]) & rows["doc_id"].eqNullSafe(top["keep"])).select(rows["sha"], "row")
    stay = stay.dropDuplicates(["sha"]).select("row")
    return tables.unpacked(marked.where(~F.col("maybe")).select("row").unionByName(stay))
