"""Whole jobs: ingest lines, write all archives, usage reports, user documents, answers, archive streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from studytrail.operators import answers, archives, serving, usage
from studytrail.operators.merge import merge_insert_if_absent
from studytrail.schema import API_GO, API_SUBMIT, INDICATORS, WEEKLY_INDICATORS
from studytrail.sources import logs
from studytrail.sources.tables import of_previous_day
from studytrail.streaming.archives import ArchiveStream, keys_of
from studytrail.streaming.sinks import EVERY

ACCEPTED = "accepted"

# Report tables, their keys and measures.
REPORTS = {
    "study_sub_onoff_num": (("ymd", "subject", "onoff"), ("user_num",)),
    "study_user_question_num": (("ymd", "user_id", "question_id"), ("dotime",)),
    "study_user_num": (("ymd", "user_id"), ("dotime",)),
    "study_question_avg_num": (("ymd", "user_id"), ("question_num", "total_time", "avg_dotime")),
    "study_hour_login_num": (("hour",), ("user_num",)),
}


def ingest_lines(lines: DataFrame, path: str, *keep: str | Column, mode: str = "append") -> None:
    """Parse event lines once and write accepted events and rejected lines side by side."""
    parsed = logs.parse_events(lines)
    status = F.coalesce("reason", F.lit(ACCEPTED)).alias("status")
    raw = F.when(F.col("reason").isNotNull(), F.col("value")).alias("raw")
    rows = parsed.select(*keep, *logs.event_columns(), raw, status)
    # gathered by folder, large ones in several parts: one file or a few for each status and day
    rows.hint("rebalance", "status", "dt").write.mode(mode).partitionBy("status", "dt").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path).where(F.col("status") == ACCEPTED)
    return rows.withColumn("dt", F.col("dt").cast("string")).drop("raw", "status")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path).where(F.col("status") != ACCEPTED)
    return rows.select("raw", F.col("status").alias("reason"))


def write_archives(events: DataFrame, path: str, names: Sequence[str] | None = None) -> None:
    """Write every archive under ``path``. ``events`` is read once: what the archives need of it is kept in memory, and on
    disk beyond; lost blocks are read again."""
    names = [*archives.ARCHIVES, *archives.FACTORS] if names is None else names
    held = events.select(*_archived(names)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name in names:
            result = archives.archive_factors(held, name) if name in archives.FACTORS else archives.archive(held, name)
            result.write.mode("overwrite").parquet(f"{path}/{name}")
    finally:
        held.unpersist()


def _archived(names: Sequence[str]) -> list[str]:
    """Columns of the log that these archives are made of."""
    columns = ["account_id", "epoch_s", "seq", "src_type", "is_right", "is_view_analyze"]
    for name in names:
        spec = archives.ARCHIVES.get(name)
        columns += [k for k in keys_of(name) if k != "factor"]
        columns += ["factor_codes"] if spec is None else ["cost_time"] if spec.answer_time else []
        columns += ["question_id", "ability", "lo_status"] if spec and spec.visits == "runs" else []
    return list(dict.fromkeys(columns))


def usage_reports(
    log: DataFrame, ymd: str, go: str = API_GO, submit: str = API_SUBMIT, seconds: Column | None = None
) -> dict[str, DataFrame]:
    """The day's rows of every report table, from the normalised API log."""
    durations = usage.question_duration(log, go, submit, seconds)
    reports = {
        "study_sub_onoff_num": usage.uv_by(log, "subject", "onoff").withColumnRenamed("uv", "user_num"),
        "study_user_question_num": durations.withColumnRenamed("duration", "dotime"),
        "study_user_num": usage.user_duration_total(durations).withColumnRenamed("total", "dotime"),
        "study_question_avg_num": usage.user_avg_duration(log, go, submit, seconds),
        "study_hour_login_num": usage.hourly_logins(log).withColumnRenamed("qty", "user_num"),
    }
    return {
        name: reports[name].withColumn("ymd", F.lit(ymd)).select(*keys, *measures)
        for name, (keys, measures) in REPORTS.items()
    }


def merge_reports(
    current: Mapping[str, DataFrame], new: Mapping[str, DataFrame], run_time: str
) -> dict[str, DataFrame]:
    """Next version of each report table: values already there are kept and only their update time moves."""
    return {
        name: merge_insert_if_absent(current[name], rows, REPORTS[name][0], run_time) for name, rows in new.items()
    }


def user_documents(indicators: Mapping[str, DataFrame], run_date: str) -> dict[str, DataFrame]:
    """(key, part, value) of each daily table's previous day and (key, score, member) of each weekly table."""
    out = {}
    for table, rows in indicators.items():
        columns = INDICATORS[table]
        order = [c for c in columns if c not in ("user_id", "dt")]
        if table in WEEKLY_INDICATORS:
            out[table] = serving.user_week_scores(rows, table, columns, order)
        else:
            out[table] = serving.user_docs(of_previous_day(rows, run_date), table, columns, order)
    return out


def write_answers(lines: DataFrame, path: str, rejected_path: str) -> None:
    """Exploded answers as delimited text, rejected rows as a table; lines are read and parsed once.

    Both kinds are first written side by side next to the rejected rows.
    """
    read = answers.read_answers(lines)
    right = F.coalesce(F.get_json_object("q.value", "$.is_right"), F.lit(answers.UNANSWERED))
    rows = read.select("value", "reason", "fields", F.explode_outer("questions").alias("q"))
    rows = rows.withColumns({"question_id": F.col("q.key"), "answer": F.col("q.value"), "is_right": right})
    bad = F.col("reason").isNotNull()
    both = rows.select(
        F.when(bad, "rejected").otherwise(ACCEPTED).alias("status"),
        F.when(bad, F.struct(F.col("value").alias("raw"), "reason")).alias("letter"),
        F.when(~bad, answers.delimited_line()).alias("line"),
    )
    parsed = f"{rejected_path.rstrip('/')}-parsed"
    both.write.mode("overwrite").partitionBy("status").parquet(parsed)
    stored = lines.sparkSession.read.schema(both.schema).parquet(parsed)
    stored.where(F.col("status") == ACCEPTED).select(F.col("line").alias("value")).write.mode("overwrite").text(path)
    stored.where(F.col("status") != ACCEPTED).select("letter.*").write.mode("overwrite").parquet(rejected_path)


def start_archives(
    events: DataFrame, root: str, names: Sequence[str], every: str | None = EVERY
) -> tuple[list[StreamingQuery], dict[str, ArchiveStream]]:
    """Streams that keep several archives: one for all lifetime archives, one for all daily ones, each a single pass."""
    queries, streams = [], {}
    for kind in ("lifetime", "daily"):
        own = [n for n in names if ("dt" in keys_of(n)) == (kind == "daily")]
        if own:
            stream = ArchiveStream(f"{root}/{kind}", own)
            queries.append(stream.start(events, every))
            streams |= {n: stream for n in own}
    return queries, streams
