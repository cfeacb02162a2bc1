"""The study log: a deterministic view over the ``events`` table, as a frame and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = {
    "account_id": "user_id",
    "seq": "event_id",
    "time": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "dt": "date_format(ts, 'yyyyMMdd')",
    "epoch_s": "unix_date(cast(ts as date)) * 86400L + hour(ts) * 3600 + minute(ts) * 60 + second(ts)",
    "src_type": "case event_type when 'error' then 'TOPIC_END' when 'signup' then 'SECTION_END' "
    "else 'SUBMIT_QUESTION' end",
    "course_id": "(event_id div 700) % 3",
    "lesson_id": "cast(1 as bigint)",
    "topic_id": "(event_id div 300) % 4",
    "section_id": "(event_id div 150) % 3",
    "tag_code": "(event_id div 40) % 3",
    "question_id": "event_id % 50",
    "stage": "1 + event_id % 3",
    "is_right": "cast(event_id % 3 as string)",
    "is_view_analyze": "cast((event_id div 3) % 2 as string)",
    "cost_time": "cast(floor(value) as bigint)",
    "ability": "cast(event_id % 100 as double) / cast(100 as double)",
    "lo_status": "case event_id % 7 when 0 then 'PASSED' when 1 then 'FAILED' when 2 then 'INPROCESS' "
    "when 3 then 'DEALED' when 4 then 'NODEALED' when 5 then 'UNCERTAIN' else 'NOITEM' end",
    "factor_codes": "filter(split(case when event_id % 11 = 0 then '' else concat('g', cast(event_id % 4 as string), "
    "',g', cast(event_id % 5 as string)) end, ','), x -> x <> '')",
    "api": "case event_type when 'purchase' then '/flow/submit' when 'click' then '/flow/go' else '/flow/other' end",
    "subject": "concat('app', cast(event_id % 3 as string))",
    "env": "case when event_id % 5 = 0 then 'x.other.org' when event_id % 5 < 3 then 'a.offline.example' "
    "else 'b.online.example' end",
    "ts": "ts",
    "value": "value",
    "event_type": "event_type",
}
API_GO = "/flow/go"
OFFLINE_SUFFIX, ONLINE_SUFFIX = ".offline.example", ".online.example"

SQL = """log AS (
  SELECT user_id AS account_id, event_id AS seq,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, strftime(ts, '%Y%m%d') AS dt,
    cast(floor(epoch(ts)) AS BIGINT) AS epoch_s,
    CASE event_type WHEN 'error' THEN 'TOPIC_END' WHEN 'signup' THEN 'SECTION_END'
      ELSE 'SUBMIT_QUESTION' END AS src_type,
    (event_id // 700) % 3 AS course_id, cast(1 AS BIGINT) AS lesson_id, (event_id // 300) % 4 AS topic_id,
    (event_id // 150) % 3 AS section_id, (event_id // 40) % 3 AS tag_code,
    event_id % 50 AS question_id, 1 + event_id % 3 AS stage,
    cast(event_id % 3 AS VARCHAR) AS is_right, cast((event_id // 3) % 2 AS VARCHAR) AS is_view_analyze,
    cast(floor(value) AS BIGINT) AS cost_time, cast(event_id % 100 AS DOUBLE) / cast(100 AS DOUBLE) AS ability,
    CASE event_id % 7 WHEN 0 THEN 'PASSED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'INPROCESS' WHEN 3 THEN 'DEALED'
      WHEN 4 THEN 'NODEALED' WHEN 5 THEN 'UNCERTAIN' ELSE 'NOITEM' END AS lo_status,
    CASE WHEN event_id % 11 = 0 THEN [] ELSE ['g' || (event_id % 4), 'g' || (event_id % 5)] END AS factor_codes,
    CASE event_type WHEN 'purchase' THEN '/flow/submit' WHEN 'click' THEN '/flow/go' ELSE '/flow/other' END AS api,
    'app' || (event_id % 3) AS subject,
    CASE WHEN event_id % 5 = 0 THEN 'x.other.org' WHEN event_id % 5 < 3 THEN 'a.offline.example'
      ELSE 'b.online.example' END AS env,
    ts, value, event_type
  FROM events)"""


def study_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_study_log(spark.read.parquet(f"{sf_dir}/events.parquet"))


def as_study_log(events: DataFrame) -> DataFrame:
    return events.select(*(F.expr(e).alias(n) for n, e in COLUMNS.items()))
