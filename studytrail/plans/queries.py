"""The registered queries: one per operator, over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrail.functions import dates, text
from studytrail.operators import alerts, answers, archives, merge, serving, usage, words
from studytrail.plans import rendered
from studytrail.plans.streams import stream_queries
from studytrail.plans.study_log import API_GO, OFFLINE_SUFFIX, ONLINE_SUFFIX, study_log
from studytrail.schema import API_SUBMIT, INDICATORS, WEEKLY_INDICATORS
from studytrail.session import shared_folder
from studytrail.sources import logs, tables

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = "2024-01-11"
LATER = "2024-01-08"
RUN_TIME = "2024-02-01 00:00:00"
BUCKETS = 16


def _over_log(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: build(study_log(spark, sf))


def _archive(name: str) -> Query:
    return _over_log(lambda log: archives.archive(log, name))


def _factors(name: str) -> Query:
    return _over_log(lambda log: archives.archive_factors(log, name))


def archive_rollup(log: DataFrame) -> DataFrame:
    spec = archives.ARCHIVES["question"]
    return archives.roll_up(archives.archive(log, "question_daily"), spec.keys)


# Ingest


def parse_log(log: DataFrame) -> DataFrame:
    seq = F.regexp_extract("value", r"^\S+ \S+ (\d+)", 1).cast("bigint").alias("seq")
    events = logs.events_of(logs.parse_events(rendered.event_lines(log)), seq)
    return events.drop("epoch_s").withColumn("factor_codes", F.array_join("factor_codes", ","))


def quarantine(log: DataFrame) -> DataFrame:
    bad = logs.rejected(logs.parse_events(rendered.damaged_lines(log)))
    return bad.select(F.regexp_extract("raw", r"^\S+ \S+ (\d+)", 1).cast("bigint").alias("seq"), "reason")


def normalize_study(log: DataFrame) -> DataFrame:
    records = logs.records_of(logs.parse_api_log(rendered.api_lines(log)))
    return logs.normalize(records, OFFLINE_SUFFIX, ONLINE_SUFFIX).select(
        "event", "user_id", "question_id", "api", "time", "onoff", "subject", "hour"
    )


def ingest_log(log: DataFrame) -> DataFrame:
    records = logs.records_of(logs.parse_ingest_log(rendered.api_lines(log)))
    return records.select("env", "time", "user_id", "api", "folw_id")


def archive_factor_rollup(log: DataFrame) -> DataFrame:
    """Daily parts of the ability archive, rolled up to the lifetime one."""
    return archives.roll_up_factors(archives.factor_days(log))


def event_routes(log: DataFrame) -> DataFrame:
    return log.groupBy("src_type").agg(F.count("*").alias("n"))


def scan_previous_day(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "up_total")
    tables.write_by_day(rendered.indicator(study_log(spark, sf), "up_total"), path)
    rows = tables.of_previous_day(spark.read.parquet(path), RUN_DATE)
    return rows.withColumn("dt", F.col("dt").cast("string")).select(*INDICATORS["up_total"])


def scan_layout(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "layout")
    rows = study_log(spark, sf).select("account_id", "seq", "dt", F.col("event_type").alias("source"))
    tables.write_by_day(rows, path, ("source", "dt"))
    return tables.of_date(spark.read.parquet(path), "20240110").select("source", "account_id", "seq")


def scan_database_table(spark: SparkSession, sf: str) -> DataFrame:
    """The log as a catalog table clustered by account, and the section archive from it without a shuffle of the log."""
    root = shared_folder(spark, "database")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS studytrail LOCATION '{root}'")
    name = f"events_{uuid.uuid4().hex}"
    columns = ["account_id", "epoch_s", "seq", "src_type", "is_right", "is_view_analyze", "cost_time"]
    rows = study_log(spark, sf).select(*columns, *archives.ARCHIVES["section"].keys)
    tables.write_clustered(rows, "studytrail", name, f"{root}/{name}", buckets=BUCKETS)
    return archives.archive(tables.read_database_table(spark, "studytrail", name), "section")


def scan_text(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines written as text and read back line by line."""
    path = shared_folder(spark, "lines")
    rendered.call_lines(study_log(spark, sf)).write.text(path)
    return tables.read_text(spark, path)


# Answers


def explode_answers(log: DataFrame) -> DataFrame:
    rows = answers.explode_answers(answers.read_answers(rendered.answer_lines(log)))
    width = F.size("fields").cast("bigint").alias("width")
    return rows.select(F.get("fields", F.lit(0)).alias("seq"), width, "question_id", "answer", "is_right")


def rejected_answers(log: DataFrame) -> DataFrame:
    read = answers.read_answers(rendered.answer_lines(log))
    return logs.rejected(read).select(F.split("raw", answers.DELIMITER)[0].alias("seq"), "reason")


def delimited_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Exploded answers written as delimited text; the lines as read back."""
    path = shared_folder(spark, "answers")
    read = answers.read_answers(rendered.answer_lines(study_log(spark, sf)))
    answers.to_delimited(answers.explode_answers(read)).write.text(path)
    return spark.read.text(path).select(F.replace("value", F.lit(answers.DELIMITER), F.lit("|")).alias("line"))


# Usage


def question_duration(log: DataFrame) -> DataFrame:
    return usage.question_duration(rendered.usage_log(log), API_GO, API_SUBMIT, F.col("epoch_s"))


def user_avg_duration(log: DataFrame) -> DataFrame:
    return usage.user_avg_duration(rendered.usage_log(log), API_GO, API_SUBMIT, F.col("epoch_s"))


# Serving


def _previous_day(log: DataFrame, table: str) -> DataFrame:
    """The indicator's rows of the day before; the time range reaches the scan of the log."""
    day = F.lit(RUN_DATE).cast("timestamp_ntz")
    of_day = log.where((F.col("ts") >= day - F.expr("interval 1 day")) & (F.col("ts") < day))
    return tables.of_previous_day(rendered.indicator(of_day, table), RUN_DATE)


def user_docs(log: DataFrame) -> DataFrame:
    table = "up_subject_total"
    return serving.user_docs(_previous_day(log, table), table, INDICATORS[table], ["subject_id"])


def multi_table_docs(log: DataFrame) -> DataFrame:
    """Documents of every daily table of the catalogue."""
    docs = {}
    for table in (t for t in INDICATORS if t not in WEEKLY_INDICATORS):
        columns = INDICATORS[table]
        # a user's rows of one day: one, or one for each subject
        docs[table] = serving.user_docs(_previous_day(log, table), table, columns, columns[1:2])
    return tables.union_tables(docs)


def _week(log: DataFrame) -> DataFrame:
    """One row per user and week."""
    return rendered.indicator(log, "up_week")


def user_entries(log: DataFrame) -> DataFrame:
    """All days of a user as numbered rows."""
    columns = INDICATORS["up_total"]
    return serving.entry_rows(rendered.indicator(log, "up_total"), ["user_id"], columns, ["dt"])


def user_doc_parts(log: DataFrame) -> DataFrame:
    """All days of a user as documents of seven days each."""
    columns = INDICATORS["up_total"]
    return serving.document_parts(rendered.indicator(log, "up_total"), ["user_id"], columns, ["dt"], 7)


def user_week_docs(log: DataFrame) -> DataFrame:
    return serving.user_week_docs(_week(log), INDICATORS["up_week"], ["question_time"])


def user_week_scores(log: DataFrame) -> DataFrame:
    columns = INDICATORS["up_week"]
    return serving.user_week_scores(_week(log), "up_week", columns, ["question_time"])


def user_week_range(log: DataFrame) -> DataFrame:
    return serving.score_range(user_week_scores(log), 2, 3)


def columns_to_cells(log: DataFrame) -> DataFrame:
    columns = ["question_time", "question_amt", "video_amt"]
    key = F.concat_ws("_", "user_id", "dt")
    return serving.columns_to_cells(rendered.indicator(log, "up_rank_day"), key, "cf", columns)


def cells_to_map(log: DataFrame) -> DataFrame:
    return serving.cells_to_map(columns_to_cells(log)).withColumn("cells", F.to_json("cells"))


def to_message_frame(log: DataFrame) -> DataFrame:
    rows = log.select("seq", "account_id", "src_type", "course_id", "time")
    return serving.to_messages(rows, "study", F.col("account_id"))


# Merges: the log up to a day is the target, the rest is new


def _early(log: DataFrame) -> DataFrame:
    return log.where(F.col("ts") < F.lit(LATER).cast("timestamp_ntz"))


def _late(log: DataFrame) -> DataFrame:
    return log.where(F.col("ts") >= F.lit(LATER).cast("timestamp_ntz"))


def merge_additive(log: DataFrame) -> DataFrame:
    spec = archives.ARCHIVES["question"]
    old, new = (archives.archive(part, spec) for part in (_early(log), _late(log)))
    return merge.merge_additive(old, new, spec.keys, spec.measures)


def merge_replace(log: DataFrame) -> DataFrame:
    def last(rows: DataFrame) -> DataFrame:
        state = rows.select("account_id", "epoch_s", "seq", "course_id", "tag_code")
        return merge.pick(state, ["account_id"], ["epoch_s", "seq"])

    return merge.merge_replace(last(_early(log)), last(_late(log)), ["account_id"])


def merge_insert_if_absent(log: DataFrame) -> DataFrame:
    def subjects(rows: DataFrame) -> DataFrame:
        users = rows.groupBy("account_id", "tag_code").agg(F.count("*").alias("qty"))
        return users.withColumn("update_time", F.lit(None).cast("string"))

    return merge.merge_insert_if_absent(
        subjects(_early(log)), subjects(_late(log)), ["account_id", "tag_code"], RUN_TIME
    )


# Words, keys and dates


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return words.lines_of(spark.read.parquet(f"{sf}/documents.parquet"), "text")


def md5_key(log: DataFrame) -> DataFrame:
    parts = ("account_id", "course_id", "topic_id")
    return log.select("seq", text.md5_key(*parts).alias("key"))


def date_keys(log: DataFrame) -> DataFrame:
    time = F.col("time")
    date = F.substring("time", 1, 10).cast("date")
    return log.select(
        "seq",
        dates.day_key(time).alias("day"),
        dates.hour_key(time).alias("hour"),
        dates.previous_day(date).alias("day_before"),
        dates.week_of_year(date).cast("bigint").alias("week"),
        dates.time_text(dates.epoch_millis(time)).alias("again"),
    )


def earliest_time(log: DataFrame) -> DataFrame:
    noon = F.concat(F.substring("time", 1, 10), F.lit(" 12:00:00"))
    return log.select("seq", dates.earliest(F.array(F.lit(""), "time", noon)).alias("earliest"))


# Alerts


def _calls(log: DataFrame) -> DataFrame:
    return logs.alert_calls(rendered.call_lines(log))


def _text_time(alert: DataFrame) -> DataFrame:
    return alert.withColumn("at", F.date_format("at", dates.TIME))


def alert_slow(log: DataFrame) -> DataFrame:
    return _text_time(alerts.slow_calls(_calls(log)))


def alert_error(log: DataFrame) -> DataFrame:
    return _text_time(alerts.error_calls(_calls(log)))


def alert_warn(log: DataFrame) -> DataFrame:
    return _text_time(alerts.warn_bursts(_calls(log), 3, "12 hours"))


def alert_traffic(log: DataFrame) -> DataFrame:
    return _text_time(alerts.traffic_jumps(_calls(log), "6 hours", 20, 2.0))


def alert_limited(log: DataFrame) -> DataFrame:
    calls = _calls(log)
    every = alerts.slow_calls(calls).unionByName(alerts.error_calls(calls))
    return _text_time(alerts.limit_rate(every, "6 hours"))


def all_queries() -> dict[str, Query]:
    out = {f"archive_{n}": _archive(n) for n in archives.ARCHIVES}
    out |= {f"archive_{n}": _factors(n) for n in archives.FACTORS}
    over_log = (
        archive_rollup, archive_factor_rollup, parse_log, quarantine, normalize_study, ingest_log, event_routes,
        explode_answers, rejected_answers, question_duration, user_avg_duration,
        user_docs, multi_table_docs, user_entries, user_doc_parts, user_week_docs, user_week_scores, user_week_range,
        columns_to_cells, cells_to_map, to_message_frame,
        merge_additive, merge_replace, merge_insert_if_absent,
        md5_key, date_keys, earliest_time,
        alert_slow, alert_error, alert_warn, alert_traffic, alert_limited,
    )
    out |= {f.__name__: _over_log(f) for f in over_log}
    out |= {f.__name__: f for f in (scan_previous_day, scan_layout, scan_database_table, scan_text, delimited_answers)}
    out |= {
        "uv_by_subject_onoff": _over_log(lambda log: usage.uv_by(rendered.usage_log(log), "subject", "onoff")),
        "uv_levels": _over_log(lambda log: usage.uv_levels(rendered.usage_log(log), "subject", "onoff")),
        "user_duration_total": _over_log(lambda log: usage.user_duration_total(question_duration(log))),
        "user_question_count": _over_log(lambda log: usage.user_question_count(rendered.usage_log(log))),
        "hourly_logins": _over_log(lambda log: usage.hourly_logins(rendered.usage_log(log))),
        "word_count": lambda spark, sf: words.word_count(_documents(spark, sf)),
        "word_count_topn": lambda spark, sf: words.word_count_topn(_documents(spark, sf), 20),
    }
    return out | stream_queries()
