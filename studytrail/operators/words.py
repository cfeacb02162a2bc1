"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrail.functions.text import is_blank, words


def lines_of(texts: DataFrame, column: str) -> DataFrame:
    return texts.select(F.explode(F.split(F.col(column), "\n")).alias("value"))


def word_count(lines: DataFrame, value: str = "value") -> DataFrame:
    rows = lines.where(~is_blank(F.col(value)))
    return rows.select(F.explode(words(F.col(value))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def word_count_topn(lines: DataFrame, n: int = 3, value: str = "value") -> DataFrame:
    """The ``n`` most frequent words, of equally frequent ones the last in order first."""
    return word_count(lines, value).orderBy(F.desc("n"), F.desc("word")).limit(n)
