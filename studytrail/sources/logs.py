"""From raw log lines to typed frames, with rejected lines kept apart."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studytrail.functions.dates import day_key, epoch_seconds, hour_key
from studytrail.functions.text import json_elements, only_element, payload, payload_of_two, with_once
from studytrail.schema import API_LOG, API_LOG_INGEST, EVENT

# Numbers are read as text and cast, so that 5 and "5" both count.
_AS_TEXT = T.StructType(
    [
        T.StructField(f.name, f.dataType if isinstance(f.dataType, T.ArrayType) else T.StringType())
        for f in EVENT["data"].dataType
    ]
)
_EVENT = T.StructType([T.StructField("time", T.StringType()), T.StructField("data", _AS_TEXT)])


def parse_lines(lines: DataFrame, schema: T.StructType, text: Column) -> DataFrame:
    """Add ``record`` (NULL where the line is rejected) and ``reason`` (NULL where it is not)."""
    parsed = with_once(lines.withColumn("_text", text), "_found", json_elements(F.col("_text"), schema))
    record = only_element(F.col("_found"))
    reason = F.when(F.col("_text").isNull(), "no payload").when(record.isNull(), "malformed json")
    return parsed.withColumns({"record": record, "reason": reason}).drop("_text", "_found")


def rejected(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Dead letters: the raw line and why it was rejected."""
    return parsed.where(F.col("reason").isNotNull()).select(F.col(value).alias("raw"), "reason")


def parse_events(lines: DataFrame, value: str = "value") -> DataFrame:
    """Archive event lines. Besides malformed lines those are rejected that would be an event without meaning: no data, no
    readable time, no account, or a field whose text cannot be read as its type."""
    parsed = parse_lines(lines, _EVENT, payload(F.col(value)))
    data = F.col("record.data")
    unread = F.lit(None).cast("string")
    for f in reversed(list(EVENT["data"].dataType)):
        if isinstance(f.dataType, T.ArrayType):
            bad = data[f.name].isNull() & F.col("_arrays")[f.name].isNotNull()
        elif isinstance(f.dataType, T.StringType):
            continue
        else:
            bad = data[f.name].isNotNull() & data[f.name].try_cast(f.dataType).isNull()
        unread = F.when(bad, F.lit(f"bad field {f.name}")).otherwise(unread)
    given = [data[f.name].isNotNull() for f in EVENT["data"].dataType]
    empty = ~functools.reduce(Column.__or__, given)
    arrays = [f.name for f in EVENT["data"].dataType if isinstance(f.dataType, T.ArrayType)]
    no_arrays = ~functools.reduce(Column.__or__, (F.col("_arrays")[n].isNotNull() for n in arrays))
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(data.isNull() | (empty & no_arrays), "no data")
        .when(epoch_seconds(F.col("record.time")).isNull(), "bad time")
        .when(data["account_id"].isNull(), "no account")
        .otherwise(unread)
    )
    return _with_array_text(parsed, value).withColumn("reason", reason).drop("_arrays")


def _with_array_text(parsed: DataFrame, value: str) -> DataFrame:
    """Add ``_arrays``: the text of array fields, read only where one of them is missing; other rows have NULL."""
    arrays = [f.name for f in EVENT["data"].dataType if isinstance(f.dataType, T.ArrayType)]
    schema = T.StructType([T.StructField("data", T.StructType([T.StructField(n, T.StringType()) for n in arrays]))])
    missing = functools.reduce(Column.__or__, (F.col("record.data")[n].isNull() for n in arrays))
    text = F.when(F.col("reason").isNull() & missing, payload(F.col(value)))
    return with_once(parsed, "_arrays", F.from_json(text, schema)["data"])


def event_columns() -> list[Column]:
    """Columns of an archive event. A submit names its section ``module_type``, an end ``section_id``.

    An unreadable time is kept as text, with neither day nor seconds.
    """
    data = F.col("record.data")
    cols = []
    for f in EVENT["data"].dataType:
        if f.name == "section_id":
            cols.append(F.coalesce(data["module_type"], data["section_id"]).alias("section_id"))
        elif f.name != "module_type":
            plain = isinstance(f.dataType, (T.StringType, T.ArrayType))
            cols.append((data[f.name] if plain else data[f.name].try_cast(f.dataType)).alias(f.name))
    time = F.col("record.time")
    seconds = epoch_seconds(time)
    day = F.when(seconds.isNotNull(), day_key(time))
    return [time.alias("time"), day.alias("dt"), seconds.alias("epoch_s"), *cols]


def events_of(parsed: DataFrame, *keep: str | Column) -> DataFrame:
    """Accepted archive events; ``keep`` adds columns of the line, such as its offset as ``seq``."""
    return parsed.where(F.col("reason").isNull()).select(*keep, *event_columns())


def parse_api_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Study API log lines: exactly one payload after a blank, nested application document in ``edApp``."""
    schema = T.StructType([*API_LOG.fields, T.StructField("edApp", T.StringType())])
    return parse_lines(lines, schema, payload_of_two(F.col(value)))


def parse_ingest_log(lines: DataFrame, value: str = "value") -> DataFrame:
    return parse_lines(lines, API_LOG_INGEST, payload_of_two(F.col(value)))


def records_of(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).select("record.*")


def normalize(log: DataFrame, offline_suffix: str, online_suffix: str) -> DataFrame:
    """Derive ``onoff`` from the host's suffix, ``subject`` from the application and ``hour`` from the time."""
    env = F.col("env")
    onoff = F.when(env.endswith(offline_suffix), "off").when(env.endswith(online_suffix), "on").otherwise("-1")
    return log.withColumns(
        {
            "onoff": onoff,
            "subject": F.get_json_object("edApp", "$.appId"),
            "hour": hour_key(F.col("time")),
        }
    ).drop("edApp")


def parse_calls(lines: DataFrame, time_field: int = 0, value: str = "value") -> DataFrame:
    """``##``-separated call log, with ``reason`` for lines that are too short or have no readable time.

    Level is field 2, milliseconds field 6, url field 8.
    """
    f = F.split(F.col(value), "##")
    read = lines.select(
        F.get(f, F.lit(time_field)).try_cast("timestamp_ntz").alias("ts"),
        F.lower(F.get(f, F.lit(2))).alias("level"),
        F.trim(F.get(f, F.lit(6))).try_cast("bigint").alias("use_time"),
        F.get(f, F.lit(8)).alias("url"),
        F.col(value).alias("line"),
        F.size(f).alias("_size"),
    )
    reason = F.when(F.coalesce(F.col("_size"), F.lit(0)) < 9, "too few fields").when(F.col("ts").isNull(), "bad time")
    return read.withColumn("reason", reason).drop("_size")


def alert_calls(lines: DataFrame, time_field: int = 0, value: str = "value") -> DataFrame:
    """The readable calls; ``rejected(parse_calls(lines), "line")`` has the others."""
    return parse_calls(lines, time_field, value).where(F.col("reason").isNull()).drop("reason")
