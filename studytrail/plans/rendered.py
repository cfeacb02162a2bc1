"""Raw inputs rendered from the study log: log lines, answer rows, call logs, indicator tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studytrail.functions.text import with_once
from studytrail.operators.answers import ANSWERS, DELIMITER, WIDTH
from studytrail.operators.archives import is_submit
from studytrail.plans.study_log import OFFLINE_SUFFIX, ONLINE_SUFFIX
from studytrail.schema import INDICATORS
from studytrail.sources.logs import normalize


def _prefix() -> Column:
    return F.concat(F.substring("time", 12, 8), F.lit(".000000 192.0.2.7 "), F.col("seq").cast("string"), F.lit(" "))


def _lines(rows: DataFrame, line: Column) -> DataFrame:
    return with_once(rows, "_line", line).select(F.col("_line").alias("value"))


def event_lines(log: DataFrame) -> DataFrame:
    """Archive event lines; submits carry their section as ``module_type``."""
    data = F.struct(
        "src_type", "account_id", "course_id", "lesson_id", "topic_id",
        F.when(~is_submit(), F.col("section_id")).alias("section_id"),
        F.when(is_submit(), F.col("section_id")).alias("module_type"),
        "stage", "tag_code", "question_id", "factor_codes", "is_right", "is_view_analyze", "cost_time",
        "ability", "lo_status",
    )
    body = F.to_json(F.struct("time", data.alias("data")))
    return _lines(log, F.concat(_prefix(), body))


def damaged_lines(log: DataFrame) -> DataFrame:
    """All event lines, some of them cut off, followed by other text, without a payload, data, readable time or account,
    or with a field that cannot be read."""
    seq = F.regexp_extract("value", r"^\S+ \S+ (\d+)", 1).cast("bigint")
    line = F.col("value")
    damaged = (
        F.when(seq % 97 == 0, F.substring(line, F.lit(1), F.length(line) - 1))
        .when(seq % 101 == 0, F.concat(line, F.lit(" tail")))
        .when(seq % 103 == 0, F.concat(F.substring_index(line, "{", 1), F.lit("noise")))
        .when(seq % 107 == 0, F.concat(F.substring_index(line, ',"data":', 1), F.when(seq % 2 == 0, "}").otherwise(',"data":"oops"}')))
        .when(seq % 109 == 0, F.replace(line, F.lit('"time":"2024-'), F.lit('"time":"2024-13-')))
        .when(seq % 113 == 0, F.replace(line, F.lit('"account_id":'), F.lit('"account":')))
        .when(seq % 127 == 0, F.replace(line, F.lit('"ability":'), F.lit('"ability":"x","was":')))
        .when(seq % 131 == 0, F.regexp_replace(line, r'"factor_codes":\[[^]]*\]', '"factor_codes":"g"'))
        .otherwise(line)
    )
    return with_once(event_lines(log), "damaged", damaged).select(F.col("damaged").alias("value"))


def api_log(log: DataFrame) -> DataFrame:
    """The study API log before normalisation."""
    return log.select(
        "env", "time", F.col("account_id").cast("string").alias("user_id"), "api",
        F.when(F.col("seq") % 13 != 0, F.col("question_id").cast("string")).alias("question_id"),
        F.col("seq").cast("string").alias("event"),
        F.to_json(F.struct(F.col("subject").alias("appId"))).alias("edApp"),
        "epoch_s",
    )


def api_lines(log: DataFrame) -> DataFrame:
    """API log lines; now and then a second object follows a blank, which makes the line unreadable."""
    rows = api_log(log).drop("epoch_s")
    body = F.to_json(F.struct(*rows.columns))
    tail = F.when(F.col("event").cast("bigint") % 89 == 0, ' {"a":1}').otherwise("")
    return _lines(rows, F.concat(F.substring("time", 12, 8), F.lit(" 192.0.2.7 1 "), body, tail))


def usage_log(log: DataFrame) -> DataFrame:
    return normalize(api_log(log), OFFLINE_SUFFIX, ONLINE_SUFFIX)


def answer_lines(log: DataFrame) -> DataFrame:
    """Delimited answer rows: array, object and broken answers, short rows."""
    q = F.col("question_id").cast("string")
    one = F.concat(F.lit('{"q'), q, F.lit('":{"is_right":'), F.col("is_right"), F.lit(',"t":"a b"}}'))
    bare = F.concat(F.lit('{"r'), q, F.lit('":{}}'))
    both = F.concat(F.expr("substring(one, 1, length(one) - 1)"), F.lit(","), F.expr("substring(bare, 2)"))
    form = F.col("seq") % 7
    rows = log.select("seq", one.alias("one"), bare.alias("bare")).withColumn(
        "answers",
        F.when(form == 0, F.concat(F.lit("["), "one", F.lit("]")))
        .when(form == 1, F.concat(F.lit(" ["), "one", F.lit(","), "bare", F.lit("]")))
        .when(form == 2, both)
        .when(form == 3, F.col("bare"))
        .when(form == 4, F.lit(""))
        .when(form == 5, F.lit("[]"))
        .otherwise(F.expr("substring(one, 1, length(one) - 1)")),
    )
    fields = [F.col("seq").cast("string"), *(F.lit(f"f{i}") for i in range(1, ANSWERS)), F.col("answers")]
    short = F.concat_ws(DELIMITER, *fields)
    full = F.concat_ws(DELIMITER, *fields, *(F.lit(f"f{i}") for i in range(ANSWERS + 1, WIDTH)))
    return _lines(rows, F.when(F.col("seq") % 10 == 0, short).otherwise(full))


def call_lines(log: DataFrame) -> DataFrame:
    level = (
        F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "signup", "Warn").otherwise("info")
    )
    url = F.concat(F.lit("/api/"), (F.col("seq") % 37).cast("string"))
    use_time = F.floor(F.col("value") * 20).cast("string")
    blank = F.lit("-")
    fields = [F.col("time"), F.col("seq").cast("string"), level, blank, blank, blank, use_time, blank, url]
    return _lines(log, F.concat_ws("##", *fields))


def indicator(log: DataFrame, table: str) -> DataFrame:
    """One of the indicator tables as an aggregate of the study log."""
    by = {
        "up_subject_total": ["user_id", "subject_id", "dt"],
        "up_total": ["user_id", "dt"],
        "up_week": ["user_id", "dt"],
        "up_rank_day": ["user_id", "dt"],
    }[table]
    rows = log.withColumnsRenamed({"account_id": "user_id", "subject": "subject_id"})
    if table == "up_week":
        rows = rows.withColumn("dt", F.weekofyear("ts").cast("string"))
    submit = is_submit()
    right = F.count_if(submit & (F.col("is_right") == "1"))
    measures = {
        "question_time": F.coalesce(F.sum(F.when(submit, F.col("cost_time"))), F.lit(0)),
        "question_amt": F.count_if(submit),
        "wrong_amt": F.count_if(submit & (F.col("is_right") == "0")),
        "video_amt": F.count_if(F.col("event_type") == "view"),
        "tagcode_amt": F.countDistinct("tag_code"),
    }
    wanted = [c for c in INDICATORS[table] if c not in by and c != "right_radio"]
    out = rows.groupBy(*by).agg(*(measures[c].alias(c) for c in wanted), right.alias("_right"))
    if "right_radio" in INDICATORS[table]:
        out = out.withColumn("right_radio", F.coalesce(F.expr("100 * _right div nullif(question_amt, 0)"), F.lit(0)))
    return out.select(*INDICATORS[table])
