"""Usage reports over the normalised study API log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studytrail.functions.dates import epoch_seconds
from studytrail.schema import API_GO, API_SUBMIT


def uv_by(log: DataFrame, *by: str) -> DataFrame:
    """Distinct users per group, e.g. subject and onoff; rows are reduced to (group, user) first."""
    return log.groupBy(*by).agg(F.countDistinct("user_id").alias("uv"))


def uv_levels(log: DataFrame, *by: str) -> DataFrame:
    """Distinct users per group, per first column, and in all: grouping sets over distinct (group, user) rows.

    ``level`` is the number of columns that were left out, which hold NULL; a group may be NULL itself.
    """
    users = log.select(*by, "user_id").distinct()
    sets = [list(by[: len(by) - i]) for i in range(len(by) + 1)]
    left_out = F.bit_count(F.grouping_id(*by)).cast("int").alias("level")
    return users.groupingSets(sets, *by).agg(left_out, F.countDistinct("user_id").alias("uv"))


def question_duration(
    log: DataFrame, go: str = API_GO, submit: str = API_SUBMIT, seconds: Column | None = None
) -> DataFrame:
    """Seconds from the first go to the last submit per user and question.

    Without a go the duration is NULL; without a submit the last submit counts as time 0.
    """
    return _durations(log, go, submit, seconds).drop("questions")


def _durations(log: DataFrame, go: str, submit: str, seconds: Column | None) -> DataFrame:
    at = epoch_seconds(F.col("time")) if seconds is None else seconds
    last = F.max(F.when(F.col("api") == submit, at).otherwise(F.lit(0)))
    first = F.min(F.when(F.col("api") == go, at))
    return log.groupBy("user_id", "question_id").agg(
        F.abs(last - first).cast("bigint").alias("duration"), F.count("question_id").alias("questions")
    )


def user_duration_total(durations: DataFrame) -> DataFrame:
    return durations.groupBy("user_id").agg(F.sum("duration").alias("total"))


def user_question_count(log: DataFrame) -> DataFrame:
    """Rows with a question per user; repeated questions count again."""
    return log.groupBy("user_id").agg(F.count("question_id").alias("qty"))


def user_avg_duration(
    log: DataFrame, go: str = API_GO, submit: str = API_SUBMIT, seconds: Column | None = None
) -> DataFrame:
    """Total time, number of questions and their quotient in whole seconds per user.

    Time and count come from the same pass: the count per question adds up to the count per user.
    """
    return (
        _durations(log, go, submit, seconds)
        .groupBy("user_id")
        .agg(F.sum("questions").alias("question_num"), F.sum("duration").alias("total_time"))
        .withColumn("avg_dotime", F.expr("total_time div nullif(question_num, 0)"))
    )


def hourly_logins(log: DataFrame) -> DataFrame:
    return log.groupBy("hour").agg(F.count("user_id").alias("qty"))
