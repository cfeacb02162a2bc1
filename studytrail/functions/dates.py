"""Date expressions over the log's text times (``yyyy-MM-dd HH:mm:ss``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of times and day keys.
TIME = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyyMMdd"


def epoch_seconds(time: Column) -> Column:
    return F.unix_timestamp(F.try_to_timestamp(time, F.lit(TIME)))


def epoch_millis(time: Column) -> Column:
    return epoch_seconds(time) * F.lit(1000)


def time_text(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis), TIME)


def day_key(time: Column) -> Column:
    return F.replace(F.substring(time, 1, 10), F.lit("-"), F.lit(""))


def hour_key(time: Column) -> Column:
    return F.substring(time, 1, 13)


def previous_day(date: Column) -> Column:
    return F.date_format(F.date_sub(date, 1), DAY)


def week_of_year(date: Column) -> Column:
    return F.weekofyear(date)


def earliest(times: Column) -> Column:
    """The least non-empty text of an array of times."""
    return F.array_min(F.filter(times, lambda t: t != ""))
