"""Answer rows: delimited lines whose answers field holds a JSON document of questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studytrail.functions.text import json_elements, only_element, with_once

# Delimiter, number of fields and position of the answers.
DELIMITER = "\x01"
WIDTH = 25
ANSWERS = 22
UNANSWERED = "0"

_ANSWERS = T.MapType(T.StringType(), T.StringType())


def fields_of(value: Column, width: int = WIDTH) -> Column:
    """Fields of a line, short rows filled up with empty ones; NULL for rows that are too wide."""
    parts = F.split(F.regexp_replace(value, f"{DELIMITER}+$", ""), DELIMITER)
    missing = F.array_repeat(F.lit(""), F.greatest(F.lit(width) - F.size(parts), F.lit(0)))
    return F.when(F.size(parts) <= width, F.concat(parts, missing))


def _numbered(entries: Column) -> Column:
    """Entries by key, repeated ones in their order."""
    return F.array_sort(F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("at"), e["value"].alias("value"))))


def _pair(entry: Column) -> Column:
    return F.struct(entry["key"].alias("key"), entry["value"].alias("value"))


def _first_question(m: Column) -> Column:
    """The first key of an array element with the last of its values."""
    entries = F.map_entries(m)
    return F.element_at(F.filter(entries, lambda e: e["key"] == F.get(entries, F.lit(0))["key"]), -1)


def _questions(text: Column, lists: Column, numbered: str) -> Column:
    """(question_id, answer) pairs: the first key of each array element, or every key of one object.

    Of repeated keys of an object the last one counts; ``numbered`` names the column of its entries by key.
    """
    elements = only_element(lists)
    whole = ~F.exists(elements, lambda m: m.isNull() | (F.size(m) == 0))
    next_key = lambda i: F.get(F.col(numbered), i + 1)["key"]
    last = F.filter(F.col(numbered), lambda e, i: ~e["key"].eqNullSafe(next_key(i)))
    in_order = F.array_sort(F.transform(last, lambda e: F.struct(e["at"].alias("at"), e["key"].alias("key"), e["value"].alias("value"))))
    objects = F.transform(in_order, _pair)
    return F.when(text.startswith("["), F.when(whole, F.transform(elements, _first_question))).otherwise(objects)


def read_answers(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``fields``, ``questions`` and, for rows that cannot be exploded, ``reason``."""
    read = with_once(lines, "fields", fields_of(F.col(value)))
    text = F.trim(F.get("fields", F.lit(ANSWERS)))
    lists = json_elements(F.when(text.startswith("["), text), T.ArrayType(_ANSWERS))
    objects = json_elements(F.when(~text.startswith("["), text), _ANSWERS)
    read = with_once(read, "_found", F.struct(lists.alias("lists"), objects.alias("objects")))
    read = with_once(read, "_numbered", _numbered(F.map_entries(only_element(F.col("_found.objects")))))
    read = with_once(read, "questions", _questions(text, F.col("_found.lists"), "_numbered"))
    reason = F.when(F.col("fields").isNull(), "too many fields").when(
        F.coalesce(F.size("questions"), F.lit(0)) < 1, "no answers"
    )
    return read.withColumn("reason", reason).drop("_found", "_numbered")


def explode_answers(read: DataFrame, *keep: str | Column) -> DataFrame:
    """One row per question: the original fields, the question, its answer and whether it is right."""
    rows = read.where(F.col("reason").isNull()).select(*keep, "fields", F.explode("questions").alias("q"))
    right = F.coalesce(F.get_json_object("q.value", "$.is_right"), F.lit(UNANSWERED))
    return rows.withColumns(
        {"question_id": F.col("q.key"), "answer": F.col("q.value"), "is_right": right}
    ).drop("q")


def delimited_line() -> Column:
    """Fields, question, answer and flag, every one followed by the delimiter."""
    added = F.array(*(F.coalesce(c, F.lit("")) for c in ("question_id", "answer", "is_right")))
    return F.concat(F.array_join(F.concat("fields", added), DELIMITER), F.lit(DELIMITER))


def to_delimited(rows: DataFrame) -> DataFrame:
    """Rows as text; written with ``df.write.text``."""
    return rows.select(delimited_line().alias("value"))
