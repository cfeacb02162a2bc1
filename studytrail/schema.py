"""Event and log schemas, and the catalogue of indicator tables."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


# Event types, answer flags, learning-object states.
SUBMIT = "SUBMIT_QUESTION"
TOPIC_END = "TOPIC_END"
SECTION_END = "SECTION_END"
RIGHT, WRONG, UNABLE = "1", "0", "2"
VIEWED = "1"
LO_STATUS = ("PASSED", "FAILED", "INPROCESS", "DEALED", "NODEALED", "UNCERTAIN", "NOITEM")

# Fields of an archive event. Ids arrive as numbers or strings.
EVENT_DATA = T.StructType(
    [
        T.StructField("src_type", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("course_id", T.StringType()),
        T.StructField("lesson_id", T.StringType()),
        T.StructField("topic_id", T.StringType()),
        T.StructField("section_id", T.StringType()),
        T.StructField("module_type", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("tag_code", T.StringType()),
        T.StructField("question_id", T.StringType()),
        T.StructField("factor_codes", T.ArrayType(T.StringType())),
        T.StructField("is_right", T.StringType()),
        T.StructField("is_view_analyze", T.StringType()),
        T.StructField("cost_time", T.IntegerType()),
        T.StructField("ability", T.DoubleType()),
        T.StructField("lo_status", T.StringType()),
    ]
)
EVENT = T.StructType([T.StructField("time", T.StringType()), T.StructField("data", EVENT_DATA)])

# Fields of the study API log and of its ingestion variant (spelled as logged).
API_LOG = strings(
    "env time exec_time user_id topic_id course_id section_id course_name section_name topic_name "
    "flow_id client_id api question_id event"
)
API_LOG_INGEST = strings(
    "env time exec_time user_id topic_id course_id section_id cource_name section_name topic_name "
    "folw_id token client_id api in out error"
)

# Indicator tables and their columns.
INDICATORS = {
    "up_subject_total": (
        "user_id", "subject_id", "question_time", "question_amt", "wrong_amt", "video_amt", "tagcode_amt", "dt",
    ),
    "up_total": ("user_id", "question_time", "question_amt", "wrong_amt", "video_amt", "tagcode_amt", "dt"),
    "up_week": (
        "user_id", "question_time", "question_amt", "wrong_amt", "video_amt", "tagcode_amt", "right_radio", "dt",
    ),
    "up_rank_day": ("user_id", "question_time", "question_amt", "video_amt", "tagcode_amt", "dt"),
}
WEEKLY_INDICATORS = frozenset({"up_week"})
KEY_JOINER = "<=>"

# API names that start and finish a question.
API_GO = "/flow/go&&out.data.component.source.question"
API_SUBMIT = "/flow/submit"
