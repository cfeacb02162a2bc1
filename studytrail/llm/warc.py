"""WARC archives without repeated payloads.

Headers (page_id, payload digest) shuffle by digest; the first page of a payload becomes a ``response`` record, the
others ``revisit`` records that refer to it. Payloads move only where a Bloom filter says that they may be repeated.
Archives are written by Spark's text writer, one record a row with the record end as line separator, so any store that
Spark writes to will do. They are read back record by record by their Content-Length.

A null html is an empty payload. Of equal payloads of ``min_bytes`` or more the smallest page_id (null last) is the
response; rows that repeat that page_id are responses as well. Lengths and digests of the result are those of the payloads
read back, ``intact`` tells whether the headers name the same digest. Very long payloads are read whole, one at a time;
other columns are not read, so their names don't matter. Null or odd urls are written as ``urn:page:<id>`` and with
control characters escaped. An empty table gives no records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from base64 import b32encode

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrail.llm import tables
from studytrail.session import shared_folder

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = "record_id string, page_id bigint, type string, digest string, actual string, n bigint, refers string, intact boolean"
RECORDS = 20_000  # of one archive


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of SHA-1: eight digits for each ten of the hexadecimal form."""
    digest = F.sha1(F.encode(payload, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _lines(*lines: Column) -> Column:
    """Header lines that are not null, each with its end."""
    return F.concat(*(F.coalesce(F.concat(x, F.lit("\r\n")), F.lit("")) for x in lines))


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(" ", F.coalesce(page.cast("string"), F.lit("none")), digest))
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def records(df: DataFrame, date: str) -> DataFrame:
    """One record a row without its end. df: page_id, url, payload, digest, n and first (the response's page, or null)."""
    revisit = F.col("first").isNotNull()
    page, digest = F.col("page_id"), F.col("digest")
    escaped = F.regexp_replace(F.regexp_replace(F.col("url"), r"[\r\n\t ]", "%20"), r"\p{Cntrl}", "")
    target = F.when(F.coalesce(F.col("url"), F.lit("")) == "", F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("none")))).otherwise(escaped)
    http = _lines(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), _field("Content-Length", F.col("n").cast("string")), F.lit(""))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    headers = _lines(
        F.lit("WARC/1.1"),
        F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        _field("WARC-Record-ID", F.when(revisit, _record_id(page, F.concat(digest, F.lit(" revisit")))).otherwise(_record_id(page, digest))),
        F.lit(f"WARC-Date: {date}"),
        _field("WARC-Target-URI", target),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(revisit, _field("WARC-Refers-To", _record_id(F.col("first"), digest))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        _field("Page-Id", page.cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(""),
    )
    return df.select(F.concat(headers, block).alias("value"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes gzipped archives of at most RECORDS records. Only possibly repeated payloads are shuffled."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    full = pages.select(F.col("page_id").cast("bigint"), "url", payload.alias("payload"))
    full = full.withColumns({"digest": base32_sha1(F.col("payload")), "n": F.octet_length("payload").cast("bigint")})
    headers = tables.stored(full.select("page_id", "digest", "n"), "headers")
    total = headers.count()
    long = headers.where(F.col("n") >= min_bytes)
    blocks = tables.blocks_for(total)
    bits = tables.stored(tables.filter_of(long, "digest", blocks, times=2), "bits")
    repeated = tables.maybe(long, "digest", bits, blocks).where("maybe")
    groups = repeated.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = tables.stored(groups.where("n > 1 AND first IS NOT NULL"), "groups")
    marked = tables.maybe(full, "digest", bits, blocks).withColumn("maybe", F.col("maybe") & (F.col("n") >= min_bytes))
    moved = marked.where("maybe").withColumnRenamed("n", "bytes").drop("maybe")
    moved = tables.with_group(moved, groups, "digest", "page_id", total).drop("n").withColumnRenamed("bytes", "n")
    moved = moved.withColumn("first", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")))
    alone = marked.where(~F.col("maybe")).drop("maybe").withColumn("first", F.lit(None).cast("bigint"))
    out = records(alone.unionByName(moved), date)
    out.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(folder)


def parse(stream) -> list:
    """READ rows of an archive's records: ``digest`` is the header's, ``actual`` that of the payload read, intact whether they agree.

    Revisits have no payload: their actual and n are null and intact is true."""
    while line := stream.readline():
        if line.strip() == b"":
            continue
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
            fields[name] = value
        block = stream.read(int(fields["Content-Length"]))
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        whole = kind == "response"
        actual = b32encode(hashlib.sha1(payload).digest()).decode() if whole else None
        page = fields.get("Page-Id")
        yield (fields["WARC-Record-ID"], int(page) if page else None, kind, digest, actual, len(payload) if whole else None,
               fields.get("WARC-Refers-To"), not whole or actual == digest)


def _parsed(batches):
    names = [c.split()[0] for c in READ.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for b in batches:
        for content in b["content"]:
            rows = []
            for row in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                rows.append(row)
                if len(rows) == 10_000:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The archives' records, one row each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(_parsed, READ)


def resolved(found: DataFrame) -> DataFrame:
    """Records with length and digest of the payload that was read, for revisits that of the response they refer to.

    ``intact`` is whether that digest is the one that the record's header names. A revisit without its response has nulls
    and is not intact.
    """
    found = tables.stored(found, "records")
    responses = found.where("type = 'response'")
    asked = found.where("type = 'revisit'").drop("n", "actual", "intact")
    targets = asked.groupBy("refers").agg(F.count(F.lit(1)).alias("n"))
    same = F.struct("page_id", F.col("n").alias("bytes"), "actual")
    known = responses.groupBy("record_id").agg(F.min(same).alias("_first"))
    known = known.select("record_id", F.col("_first.page_id").alias("first"), "_first.bytes", "_first.actual")
    targets = targets.join(known, targets["refers"] == known["record_id"]).drop("record_id")
    out = tables.with_group(asked, tables.stored(targets, "targets"), "refers", "record_id", found.count())
    plain = responses.select("page_id", F.col("n").alias("bytes"), "actual", "digest", "type", F.lit(None).cast("bigint").alias("first"))
    both = plain.unionByName(out.select("page_id", "bytes", "actual", "digest", "type", "first"))
    return both.select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("actual").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("first").alias("refers_to"), F.col("actual").eqNullSafe(F.col("digest")).alias("intact"),
    )


def archive_roundtrip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the archives to the shared folder, reads them back and resolves the revisits."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    write_archives(pages, folder, min_bytes)
    return resolved(read_archives(spark, folder))
