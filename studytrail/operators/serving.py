"""Serving frames: per-user documents, scored members, wide-column cells, messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studytrail.functions.text import join_key
from studytrail.operators.timeline import join_same
from studytrail.session import shared_folder


def _part(part: Column | None) -> Column:
    return (F.lit(0) if part is None else part).cast("bigint").alias("part")


def _as_text(columns: Sequence[str]) -> Column:
    return F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(c) for c in columns))


def json_documents(
    rows: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str], part: Column | None = None
) -> DataFrame:
    """(keys, part, value): a JSON array of the key's rows in ``order``, every value as text.

    A document is one value, so what a key holds must be bounded by what the key is: a user's subjects of a day, say.
    Where it isn't, name a ``part`` that comes from the row, such as its day; parts follow each other if ``part`` rises
    with ``order``. The rule is the same whatever a key's size. ``document_parts`` and ``entry_rows`` need no bound.
    """
    entry = F.struct(*(F.col(c).alias(f"_o{i}") for i, c in enumerate(order)), _as_text(columns).alias("_row"))
    entries = F.array_sort(F.collect_list(entry))
    value = F.to_json(F.transform(entries, lambda e: e["_row"])).alias("value")
    return rows.groupBy(*keys, _part(part)).agg(value)


def entry_rows(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(keys, position, entry): the entries of a document as rows, numbered from 1 in ``order``.

    Rows are dealt by ranges of (key, order), so a key that holds most of them is spread over many tasks. Each range numbers its own
    rows, and the counts of the ranges before it are added. The dealt rows are written once, so that both see the same ranges.
    """
    numbered, starts = _ranges(rows, keys, columns, order)
    position = (F.col("_number") + F.col("_start")).alias("position")
    return join_same(numbered, starts, [*keys, "_range"], "inner").select(*keys, position, "entry")


def _ranges(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Entries with their ``_range`` and ``_number`` inside it, and where each range of a key starts."""
    entry = F.to_json(_as_text(columns)).alias("entry")
    marks = [F.col(c).alias(f"_o{i}") for i, c in enumerate(dict.fromkeys((*order, *columns)))]
    names = [f"_o{i}" for i in range(len(marks))]
    dealt = rows.select(*keys, *marks, entry).repartitionByRange(*keys, *names).withColumn("_range", F.spark_partition_id())
    path = shared_folder(rows.sparkSession, "entries")
    dealt.write.parquet(path)
    dealt = rows.sparkSession.read.schema(dealt.schema).parquet(path)
    own = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*names)).cast("bigint")
    counts = dealt.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return dealt.select(*keys, "_range", own.alias("_number"), "entry"), starts


def document_parts(
    rows: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str], entries: int = 1000
) -> DataFrame:
    """(keys, part, value): documents as JSON arrays of at most ``entries`` entries, whatever a key holds; parts follow each
    other in ``order``, and all but the last are full."""
    numbered = entry_rows(rows, keys, columns, order)
    part = F.expr(f"(position - 1) div {entries}").alias("part")
    held = F.array_sort(F.collect_list(F.struct("position", "entry")))
    value = F.concat(F.lit("["), F.array_join(held["entry"], ","), F.lit("]")).alias("value")
    return numbered.groupBy(*keys, part).agg(value)


def user_docs(rows: DataFrame, table: str, columns: Sequence[str], order: Sequence[str], part: Column | None = None) -> DataFrame:
    """(key, part, value) with key ``user<=>table``."""
    docs = json_documents(rows, ["user_id"], columns, order, part)
    return docs.select(join_key(F.col("user_id"), F.lit(table)).alias("key"), "part", "value")


def user_week_docs(
    rows: DataFrame, columns: Sequence[str], order: Sequence[str], week: str = "dt", part: Column | None = None
) -> DataFrame:
    """(key, part, value) with key ``user<=>week``."""
    docs = json_documents(rows, ["user_id", week], columns, order, part)
    return docs.select(join_key(F.col("user_id"), F.col(week)).alias("key"), "part", "value")


def user_week_scores(
    rows: DataFrame, table: str, columns: Sequence[str], order: Sequence[str], week: str = "dt", part: Column | None = None
) -> DataFrame:
    """(key, score, part, member): the week's document as a member scored by the week. Merge on (key, score, part)."""
    docs = json_documents(rows, ["user_id", week], columns, order, part)
    return docs.select(
        join_key(F.col("user_id"), F.lit(table)).alias("key"),
        F.col(week).try_cast("double").alias("score"),
        "part",
        F.col("value").alias("member"),
    )


def score_range(scores: DataFrame, low: float, high: float) -> DataFrame:
    """Members of every key with a score between ``low`` and ``high``."""
    return scores.where(F.col("score").between(low, high))


def columns_to_cells(rows: DataFrame, row_key: Column, family: str, columns: Sequence[str]) -> DataFrame:
    """(rowkey, cf, qualifier, value): one cell per column that is not NULL."""
    cells = F.map_from_arrays(
        F.array(*(F.lit(c) for c in columns)), F.array(*(F.col(c).cast("string") for c in columns))
    )
    return (
        rows.select(row_key.alias("rowkey"), F.lit(family).alias("cf"), F.explode(cells).alias("qualifier", "value"))
        .where(F.col("value").isNotNull())
    )


def read_cells(cells: DataFrame, row_key: str, family: str) -> DataFrame:
    """Cells of one row and family as (qualifier, value)."""
    return cells.where((F.col("rowkey") == row_key) & (F.col("cf") == family)).select("qualifier", "value")


def cells_to_map(cells: DataFrame, part: Column | None = None) -> DataFrame:
    """(rowkey, cf, part, cells): a row's family as a map; a family holds a fixed set of columns, else name a ``part``."""
    entries = F.array_sort(F.collect_list(F.struct("qualifier", "value")))
    return cells.groupBy("rowkey", "cf", _part(part)).agg(F.map_from_entries(entries).alias("cells"))


def to_messages(rows: DataFrame, topic: str, key: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """(topic, key, value) as the Kafka sink takes them; the value is the row as JSON."""
    return rows.select(
        F.lit(topic).alias("topic"),
        key.cast("string").alias("key"),
        F.to_json(F.struct(*(columns or rows.columns))).alias("value"),
    )
