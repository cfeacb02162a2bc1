"""Text expressions: payloads inside log lines, words, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studytrail.schema import KEY_JOINER


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is evaluated once per row.

    Plain projections are merged into whatever uses them, which would parse a document once per use;
    a generator of one row is not.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def payload(value: Column) -> Column:
    """Everything from the first ``{``; NULL where there is none."""
    at = F.instr(value, "{")
    return F.when(at > 0, F.substring(value, at, F.length(value)))


def payload_of_two(value: Column) -> Column:
    """The payload of lines with exactly one blank followed by ``{``; NULL for all others.

    Separators at the end of the line separate nothing and are ignored.
    """
    parts = F.split(F.regexp_replace(value, r"(\s\{)+$", ""), r"\s\{")
    return F.when(F.size(parts) == 2, F.concat(F.lit("{"), F.get(parts, F.lit(1))))


def json_elements(text: Column, schema: T.DataType) -> Column:
    """The text parsed as the elements of a JSON array without its brackets; NULL if malformed.

    One JSON value and nothing else gives one element; text after the value gives NULL or more
    elements. Of repeated keys the last one counts.
    """
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema))


def only_element(elements: Column) -> Column:
    return F.when(F.size(elements) == 1, F.get(elements, F.lit(0)))


def words(line: Column) -> Column:
    """Words of a line: ``?`` removed, ``http`` written ``www``, cut at single blanks.

    Empty words at the end of a line are dropped, those at the start or between blanks are kept.
    """
    text = F.replace(F.replace(line, F.lit("?"), F.lit("")), F.lit("http"), F.lit("www"))
    # only blanks and question marks, at least one of them a blank; by replacing, as a pattern would go back and forth
    rest = F.replace(F.replace(line, F.lit("?"), F.lit("")), F.lit(" "), F.lit(""))
    no_words = (rest == "") & F.contains(line, F.lit(" "))
    return F.when(no_words, F.array().cast("array<string>")).otherwise(F.split(F.rtrim(text), " "))


def is_blank(line: Column) -> Column:
    return ~F.rlike(line, F.lit(r"[^\x00-\x20]"))


def md5_key(*parts: str | Column) -> Column:
    """Lower-case hex MD5 of the parts joined by ``_``."""
    return F.md5(F.concat_ws("_", *parts))


def join_key(*parts: Column) -> Column:
    return F.concat_ws(KEY_JOINER, *parts)


def split_key(key: Column) -> Column:
    return F.split(key, KEY_JOINER)
