"""Independent SQL statements of the registered queries, in DuckDB's dialect."""

from __future__ import annotations

from studytrail.plans.study_log import SQL as LOG

COUNTERS = """count(*) AS answers,
  count(*) FILTER (is_right = '1') AS "right", count(*) FILTER (is_right = '0') AS wrong,
  count(*) FILTER (is_right = '2') AS unable, count(*) FILTER (is_view_analyze = '1') AS viewed,
  count(*) FILTER (is_view_analyze = '1' AND is_right = '1') AS viewed_right,
  count(*) FILTER (is_view_analyze = '1' AND is_right = '0') AS viewed_wrong,
  count(*) FILTER (is_view_analyze = '1' AND is_right = '2') AS viewed_unable"""
ANSWER_TIME = "cast(sum(cost_time) AS BIGINT) AS answer_time"
TAG = "course_id, lesson_id, topic_id, section_id, tag_code"
STATUSES = ("PASSED", "FAILED", "INPROCESS", "DEALED", "NODEALED", "UNCERTAIN", "NOITEM")


def archive_course(day: str = "") -> str:
    counters = COUNTERS
    if day:
        counters = counters.replace(" count(*) FILTER (is_view_analyze = '1') AS viewed,\n", "\n")
    return f"""WITH {LOG}, submits AS (
  SELECT *, lag(course_id) OVER (PARTITION BY account_id{day} ORDER BY epoch_s, seq) AS before
  FROM log WHERE src_type = 'SUBMIT_QUESTION')
SELECT course_id{day}, {counters}, {ANSWER_TIME},
  count(*) FILTER (before IS NULL OR before <> course_id) AS entries
FROM submits GROUP BY course_id{day}"""


def archive_closed(keys: str, end: str) -> str:
    return f"""WITH {LOG}, rows_ AS (
  SELECT *, coalesce(sum(CASE WHEN src_type = '{end}' THEN 1 ELSE 0 END) OVER (
      PARTITION BY account_id, {keys} ORDER BY epoch_s, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run
  FROM log WHERE src_type IN ('SUBMIT_QUESTION', '{end}')),
visits AS (
  SELECT account_id, {keys}, run, min(CASE WHEN src_type = 'SUBMIT_QUESTION' THEN epoch_s END) AS first_s,
    max(CASE WHEN src_type = '{end}' THEN epoch_s END) AS end_s
  FROM rows_ GROUP BY account_id, {keys}, run),
v AS (
  SELECT {keys}, count(*) AS entries, count(end_s) AS completions,
    cast(coalesce(sum(end_s - first_s), 0) AS BIGINT) AS completion_time
  FROM visits WHERE first_s IS NOT NULL GROUP BY {keys}),
a AS (
  SELECT {keys}, {COUNTERS}, {ANSWER_TIME} FROM log WHERE src_type = 'SUBMIT_QUESTION' GROUP BY {keys})
SELECT * FROM a JOIN v USING ({keys})"""


def archive_tag(day: str = "", until: str = "next_s - first_s") -> str:
    place = f"account_id, course_id, lesson_id, topic_id, section_id{day}"
    lo = ", ".join(f"count(*) FILTER (next_s IS NOT NULL AND status = '{s}') AS lo_{s}" for s in STATUSES)
    return f"""WITH {LOG}, s AS (
  SELECT *, lag(tag_code) OVER w AS pt, lag(question_id) OVER w AS pq
  FROM log WHERE src_type = 'SUBMIT_QUESTION'
  WINDOW w AS (PARTITION BY {place} ORDER BY epoch_s, seq)),
n AS (
  SELECT *, sum(CASE WHEN pt IS NULL OR pt <> tag_code THEN 1 ELSE 0 END) OVER w AS visit,
    sum(CASE WHEN pt IS NULL OR pt <> tag_code OR pq <> question_id THEN 1 ELSE 0 END) OVER w AS ask
  FROM s WINDOW w AS (PARTITION BY {place} ORDER BY epoch_s, seq)),
asks AS (
  SELECT {place}, tag_code, visit, ask, min(epoch_s) AS first_s, max(epoch_s) AS last_s,
    arg_min(ability, (epoch_s, seq)) AS ability, arg_min(lo_status, (epoch_s, seq)) AS status
  FROM n GROUP BY {place}, tag_code, visit, ask),
visits AS (
  SELECT {place}, tag_code, visit, min(first_s) AS first_s, max(last_s) AS last_s,
    arg_max(ability, ask) AS ability, arg_max(status, ask) AS status
  FROM asks GROUP BY {place}, tag_code, visit),
nexts AS (
  SELECT *, lead(first_s) OVER (PARTITION BY {place} ORDER BY visit) AS next_s FROM visits),
v AS (
  SELECT {TAG}{day}, count(*) AS entries, count(next_s) AS completions,
    cast(coalesce(sum(CASE WHEN next_s IS NOT NULL THEN {until} END), 0) AS BIGINT) AS completion_time,
    cast(coalesce(sum(CASE WHEN next_s IS NOT NULL THEN cast(round(ability * 100) AS BIGINT) END), 0) AS DOUBLE)
      / cast(100 AS DOUBLE) AS ability_sum, {lo}
  FROM nexts GROUP BY {TAG}{day}),
a AS (
  SELECT {TAG}{day}, {COUNTERS}, {ANSWER_TIME}
  FROM log WHERE src_type = 'SUBMIT_QUESTION' GROUP BY {TAG}{day})
SELECT * FROM a JOIN v USING ({TAG}{day})"""


def archive_question(day: str = "") -> str:
    return f"""WITH {LOG} SELECT {TAG}, question_id{day}, {COUNTERS}
FROM log WHERE src_type = 'SUBMIT_QUESTION' GROUP BY {TAG}, question_id{day}"""


def archive_factor(keys: str) -> str:
    return f"""WITH {LOG}, f AS (
  SELECT * EXCLUDE (factor_codes), unnest(factor_codes) AS factor FROM log WHERE src_type = 'SUBMIT_QUESTION')
SELECT {keys}, count(DISTINCT account_id) AS triggers, {COUNTERS},
  cast(count(*) FILTER (is_right = '1') AS DOUBLE) / cast(count(*) AS DOUBLE) AS ability
FROM f GROUP BY {keys}"""


def archives() -> dict[str, str]:
    section = "course_id, topic_id, section_id"
    return {
        "archive_course": archive_course(),
        "archive_topic": archive_closed("course_id, topic_id", "TOPIC_END"),
        "archive_section": archive_closed(section, "SECTION_END"),
        "archive_tag": archive_tag(),
        "archive_question": archive_question(),
        "archive_factor": archive_factor("course_id, lesson_id, topic_id, section_id, factor"),
        "archive_factor_rollup": archive_factor("course_id, lesson_id, topic_id, section_id, factor"),
        "scan_database_table": archive_closed(section, "SECTION_END"),
        "archive_course_daily": archive_course(", dt"),
        "archive_topic_daily": archive_closed("course_id, topic_id, dt", "TOPIC_END"),
        "archive_section_daily": archive_closed(f"{section}, dt", "SECTION_END"),
        "archive_tag_daily": archive_tag(", dt", "last_s - first_s"),
        "archive_question_daily": archive_question(", dt"),
        "archive_factor_daily": archive_factor("course_id, lesson_id, topic_id, stage, factor, dt"),
    }


USAGE = """u AS (
  SELECT env, time, cast(account_id AS VARCHAR) AS user_id, api, epoch_s, subject,
    CASE WHEN seq % 13 <> 0 THEN cast(question_id AS VARCHAR) END AS question_id, cast(seq AS VARCHAR) AS event,
    CASE WHEN env LIKE '%.offline.example' THEN 'off' WHEN env LIKE '%.online.example' THEN 'on' ELSE '-1' END AS onoff,
    substr(time, 1, 13) AS hour
  FROM log)"""
DURATIONS = """d AS (
  SELECT user_id, question_id, abs(max(CASE WHEN api = '/flow/submit' THEN epoch_s ELSE 0 END)
    - min(CASE WHEN api = '/flow/go' THEN epoch_s END)) AS duration
  FROM u GROUP BY user_id, question_id)"""


def usage() -> dict[str, str]:
    head = f"WITH {LOG}, {USAGE}"
    return {
        "uv_by_subject_onoff": f"""{head} SELECT subject, onoff, count(DISTINCT user_id) AS uv
FROM u GROUP BY subject, onoff""",
        "uv_levels": f"""{head} SELECT subject, onoff,
  cast(CASE grouping(subject, onoff) WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS INTEGER) AS level, count(DISTINCT user_id) AS uv
FROM u GROUP BY GROUPING SETS ((subject, onoff), (subject), ())""",
        "question_duration": f"{head}, {DURATIONS} SELECT * FROM d",
        "user_duration_total": f"""{head}, {DURATIONS}
SELECT user_id, cast(sum(duration) AS BIGINT) AS total FROM d GROUP BY user_id""",
        "user_question_count": f"{head} SELECT user_id, count(question_id) AS qty FROM u GROUP BY user_id",
        "user_avg_duration": f"""{head}, {DURATIONS},
t AS (SELECT user_id, cast(sum(duration) AS BIGINT) AS total_time FROM d GROUP BY user_id),
c AS (SELECT user_id, count(question_id) AS question_num FROM u GROUP BY user_id)
SELECT user_id, question_num, total_time, total_time // nullif(question_num, 0) AS avg_dotime
FROM t JOIN c USING (user_id)""",
        "hourly_logins": f"{head} SELECT hour, count(user_id) AS qty FROM u GROUP BY hour",
        "normalize_study": f"""{head} SELECT event, user_id, question_id, api, time, onoff, subject, hour
FROM u WHERE cast(event AS BIGINT) % 89 <> 0""",
        "ingest_log": f"""{head} SELECT env, time, user_id, api, cast(NULL AS VARCHAR) AS folw_id
FROM u WHERE cast(event AS BIGINT) % 89 <> 0""",
    }


def ingest() -> dict[str, str]:
    return {
        "archive_rollup": f"WITH {LOG} SELECT {TAG}, question_id, {COUNTERS} "
        f"FROM log WHERE src_type = 'SUBMIT_QUESTION' GROUP BY {TAG}, question_id",
        "parse_log": f"""WITH {LOG} SELECT seq, time, dt, src_type, cast(account_id AS VARCHAR) AS account_id,
  cast(course_id AS VARCHAR) AS course_id, cast(lesson_id AS VARCHAR) AS lesson_id,
  cast(topic_id AS VARCHAR) AS topic_id, cast(section_id AS VARCHAR) AS section_id, cast(stage AS VARCHAR) AS stage,
  cast(tag_code AS VARCHAR) AS tag_code, cast(question_id AS VARCHAR) AS question_id,
  array_to_string(factor_codes, ',') AS factor_codes, is_right, is_view_analyze,
  cast(cost_time AS INTEGER) AS cost_time, ability, lo_status FROM log""",
        "quarantine": f"""WITH {LOG} SELECT seq, reason FROM (SELECT seq, CASE
  WHEN seq % 97 = 0 OR seq % 101 = 0 THEN 'malformed json' WHEN seq % 103 = 0 THEN 'no payload'
  WHEN seq % 107 = 0 THEN 'no data' WHEN seq % 109 = 0 THEN 'bad time' WHEN seq % 113 = 0 THEN 'no account'
  WHEN seq % 127 = 0 THEN 'bad field ability' WHEN seq % 131 = 0 THEN 'bad field factor_codes' END AS reason FROM log)
WHERE reason IS NOT NULL""",
        "event_routes": f"WITH {LOG} SELECT src_type, count(*) AS n FROM log GROUP BY src_type",
        "scan_layout": f"""WITH {LOG} SELECT event_type AS source, account_id, seq FROM log WHERE dt = '20240110'""",
        "scan_text": f"""WITH {LOG} SELECT time || '##' || seq || '##' || CASE event_type WHEN 'error' THEN 'ERROR'
    WHEN 'signup' THEN 'Warn' ELSE 'info' END || '##-##-##-##' || cast(floor(value * 20) AS BIGINT)
    || '##-##/api/' || (seq % 37) AS value FROM log""",
        "scan_previous_day": f"""WITH {LOG}, {INDICATORS} SELECT * FROM up_total WHERE dt = '20240110'""",
    }


ANSWERS = """a AS (
  SELECT seq, seq % 7 AS form, 'q' || question_id AS q, '{"is_right":' || is_right || ',"t":"a b"}' AS one,
    'r' || question_id AS r FROM log),
e AS (
  SELECT seq, form, q AS question_id, one AS answer,
    substr(one, 13, 1) AS is_right, q, one, r FROM a WHERE form IN (0, 1, 2)
  UNION ALL
  SELECT seq, form, r, '{}', '0', q, one, r FROM a WHERE form IN (1, 2, 3))"""


def answers() -> dict[str, str]:
    fields = " || '|' || ".join(f"'f{i}'" for i in range(1, 22))
    return {
        "explode_answers": f"""WITH {LOG}, {ANSWERS}
SELECT cast(seq AS VARCHAR) AS seq, cast(25 AS BIGINT) AS width, question_id, answer, is_right FROM e""",
        "rejected_answers": f"""WITH {LOG}, {ANSWERS}
SELECT cast(seq AS VARCHAR) AS seq, 'no answers' AS reason FROM a WHERE form > 3""",
        "delimited_answers": f"""WITH {LOG}, {ANSWERS}
SELECT seq || '|' || {fields} || '|' || CASE form WHEN 0 THEN '[{{"' || q || '":' || one || '}}]'
    WHEN 1 THEN ' [{{"' || q || '":' || one || '}},{{"' || r || '":{{}}}}]'
    WHEN 2 THEN '{{"' || q || '":' || one || ',"' || r || '":{{}}}}' ELSE '{{"' || r || '":{{}}}}' END || '|'
  || CASE WHEN seq % 10 = 0 THEN '||' ELSE 'f23|f24|' END
  || question_id || '|' || answer || '|' || is_right || '|' AS line FROM e""",
    }


def _indicator(by: str, measures: str, dt: str = "dt") -> str:
    submit = "FILTER (src_type = 'SUBMIT_QUESTION')"
    known = {
        "question_time": f"cast(coalesce(sum(cost_time) {submit}, 0) AS BIGINT) AS question_time",
        "question_amt": f"count(*) {submit} AS question_amt",
        "wrong_amt": "count(*) FILTER (src_type = 'SUBMIT_QUESTION' AND is_right = '0') AS wrong_amt",
        "video_amt": "count(*) FILTER (event_type = 'view') AS video_amt",
        "tagcode_amt": "count(DISTINCT tag_code) AS tagcode_amt",
        "right_radio": "coalesce((100 * count(*) FILTER (src_type = 'SUBMIT_QUESTION' AND is_right = '1')) "
        f"// nullif(count(*) {submit}, 0), 0) AS right_radio",
    }
    cols = ", ".join(known[m] for m in measures.split())
    groups = by.replace(" AS user_id", "").replace(" AS subject_id", "")
    return f"SELECT {by}, {cols}, {dt} AS dt FROM log GROUP BY {groups}, {dt}"


INDICATORS = ",\n".join(
    f"{name} AS ({sql})"
    for name, sql in {
        "up_subject_total": _indicator(
            "account_id AS user_id, subject AS subject_id",
            "question_time question_amt wrong_amt video_amt tagcode_amt",
        ),
        "up_total": _indicator("account_id AS user_id", "question_time question_amt wrong_amt video_amt tagcode_amt"),
        "up_week": _indicator(
            "account_id AS user_id",
            "question_time question_amt wrong_amt video_amt tagcode_amt right_radio",
            "cast(weekofyear(ts) AS VARCHAR)",
        ),
        "up_rank_day": _indicator("account_id AS user_id", "question_time question_amt video_amt tagcode_amt"),
    }.items()
)


def _object(columns: str) -> str:
    pairs = " || ',' || ".join(f"""'"{c}":"' || {c} || '"'""" for c in columns.split())
    return f"'{{' || {pairs} || '}}'"


TOTAL = "user_id question_time question_amt wrong_amt video_amt tagcode_amt dt"
SUBJECT = "user_id subject_id question_time question_amt wrong_amt video_amt tagcode_amt dt"
WEEK = "user_id question_time question_amt wrong_amt video_amt tagcode_amt right_radio dt"
RANK = "user_id question_time question_amt video_amt tagcode_amt dt"


def _docs(table: str, columns: str, order: str) -> str:
    return f"""SELECT user_id || '<=>{table}' AS key, cast(0 AS BIGINT) AS part,
  '[' || string_agg({_object(columns)}, ',' ORDER BY {order}) || ']' AS value
FROM {table} WHERE dt = '20240110' GROUP BY user_id"""


def serving() -> dict[str, str]:
    head = f"WITH {LOG}, {INDICATORS}"
    week = f"'[' || {_object(WEEK)} || ']'"
    scores = f"SELECT user_id || '<=>up_week' AS key, cast(dt AS DOUBLE) AS score, cast(0 AS BIGINT) AS part, {week} AS member FROM up_week"
    cells = " UNION ALL ".join(
        f"SELECT user_id || '_' || dt AS rowkey, 'cf' AS cf, '{c}' AS qualifier, cast({c} AS VARCHAR) AS value "
        "FROM up_rank_day"
        for c in ("question_time", "question_amt", "video_amt")
    )
    tables = (
        ("up_subject_total", SUBJECT, "subject_id"), ("up_total", TOTAL, "question_time"),
        ("up_rank_day", RANK, "question_time"),
    )
    entries = f"SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY dt) AS position, {_object(TOTAL)} AS entry FROM up_total"
    union = " UNION ALL ".join(f"SELECT *, '{t}' AS \"table\" FROM ({_docs(t, c, o)})" for t, c, o in tables)
    return {
        "user_docs": f"{head} {_docs('up_subject_total', SUBJECT, 'subject_id')}",
        "multi_table_docs": f"{head} {union}",
        "user_entries": f"{head} {entries}",
        "user_doc_parts": f"""{head} SELECT user_id, (position - 1) // 7 AS part,
  '[' || string_agg(entry, ',' ORDER BY position) || ']' AS value FROM ({entries}) GROUP BY 1, 2""",
        "user_week_docs": f"""{head} SELECT user_id || '<=>' || dt AS key, cast(0 AS BIGINT) AS part,
  {week} AS value FROM up_week""",
        "user_week_scores": f"{head} {scores}",
        "user_week_range": f"{head} {scores} WHERE cast(dt AS DOUBLE) BETWEEN 2 AND 3",
        "columns_to_cells": f"{head} {cells}",
        "cells_to_map": f"""{head} SELECT user_id || '_' || dt AS rowkey, 'cf' AS cf, cast(0 AS BIGINT) AS part,
  {_object("question_amt question_time video_amt")} AS cells FROM up_rank_day""",
        "to_message_frame": f"""WITH {LOG} SELECT 'study' AS topic, cast(account_id AS VARCHAR) AS key,
  '{{"seq":' || seq || ',"account_id":' || account_id || ',"src_type":"' || src_type || '","course_id":' || course_id
  || ',"time":"' || time || '"}}' AS value FROM log""",
    }


def merges() -> dict[str, str]:
    return {
        "merge_additive": archive_question(),
        "merge_replace": f"""WITH {LOG} SELECT account_id, arg_max(epoch_s, (epoch_s, seq)) AS epoch_s,
  arg_max(seq, (epoch_s, seq)) AS seq, arg_max(course_id, (epoch_s, seq)) AS course_id,
  arg_max(tag_code, (epoch_s, seq)) AS tag_code FROM log GROUP BY account_id""",
        "merge_insert_if_absent": f"""WITH {LOG},
g AS (SELECT account_id, tag_code, count(*) FILTER (dt < '20240108') AS old, count(*) FILTER (dt >= '20240108') AS new_
  FROM log GROUP BY account_id, tag_code)
SELECT account_id, tag_code, CASE WHEN old > 0 THEN old ELSE new_ END AS qty,
  CASE WHEN old > 0 AND new_ > 0 THEN '2024-02-01 00:00:00' END AS update_time FROM g""",
    }


WORDS = """l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT unnest(CASE WHEN rtrim(t, ' ') = '' AND t <> '' THEN [] ELSE string_split(rtrim(t, ' '), ' ') END) AS word
  FROM (SELECT replace(replace(line, '?', ''), 'http', 'www') AS t FROM l
    WHERE regexp_matches(line, '[^\\x00-\\x20]')))"""


def words_and_dates() -> dict[str, str]:
    return {
        "word_count": f"WITH {WORDS} SELECT word, count(*) AS n FROM w GROUP BY word",
        "word_count_topn": f"""WITH {WORDS} SELECT word, count(*) AS n FROM w GROUP BY word
ORDER BY n DESC, word DESC LIMIT 20""",
        "md5_key": f"WITH {LOG} SELECT seq, md5(account_id || '_' || course_id || '_' || topic_id) AS key FROM log",
        "date_keys": f"""WITH {LOG} SELECT seq, dt AS day, substr(time, 1, 13) AS hour,
  strftime(ts - INTERVAL 1 DAY, '%Y%m%d') AS day_before, cast(weekofyear(ts) AS BIGINT) AS week, time AS again
FROM log""",
        "earliest_time": f"""WITH {LOG} SELECT seq, CASE WHEN time < substr(time, 1, 10) || ' 12:00:00' THEN time
  ELSE substr(time, 1, 10) || ' 12:00:00' END AS earliest FROM log""",
    }


CALLS = """c AS (
  SELECT time, epoch_s, CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warn' ELSE 'info' END AS level,
    cast(floor(value * 20) AS BIGINT) AS use_time, '/api/' || (seq % 37) AS url FROM log)"""


def _at(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds}) * 1000000), '%Y-%m-%d %H:%M:%S')"


def alerts() -> dict[str, str]:
    head = f"WITH {LOG}, {CALLS}"
    slow = "SELECT 'slow' AS rule, url, time AS at, use_time AS amount FROM c WHERE use_time > 1000"
    error = "SELECT 'error' AS rule, url, time AS at, cast(1 AS BIGINT) AS amount FROM c WHERE level = 'error'"
    return {
        "alert_slow": f"{head} {slow}",
        "alert_error": f"{head} {error}",
        "alert_warn": f"""{head}, s AS (SELECT url, epoch_s, count(*) AS n FROM c WHERE level = 'warn' GROUP BY url, epoch_s),
w AS (SELECT *, sum(n) OVER (PARTITION BY url ORDER BY epoch_s RANGE BETWEEN 43200 PRECEDING AND CURRENT ROW) AS m FROM s)
SELECT 'warn' AS rule, url, {_at("min(epoch_s)")} AS at, cast(max(m) AS BIGINT) AS amount
FROM w WHERE m >= 3 GROUP BY url, epoch_s // 43200""",
        "alert_traffic": f"""{head}, n AS (
  SELECT epoch_s // 21600 AS w, url, count(*) AS n FROM c GROUP BY epoch_s // 21600, url),
r AS (
  SELECT n.*, coalesce(p.n, 0) AS before, row_number() OVER (PARTITION BY n.w ORDER BY n.n DESC, n.url) AS place
  FROM n LEFT JOIN n p ON p.url = n.url AND p.w = n.w - 1)
SELECT 'traffic' AS rule, url, {_at("w * 21600")} AS at, n AS amount FROM r WHERE place <= 20 AND n > 2 * before""",
        "alert_limited": f"""{head}, b AS ({slow.replace("amount", "amount, epoch_s // 21600 AS w")}
  UNION ALL {error.replace("amount", "amount, epoch_s // 21600 AS w")})
SELECT rule, url, min("at") AS "at", arg_min(amount, {{'t': "at", 'n': amount}}) AS amount, count(*) - 1 AS suppressed
FROM b GROUP BY rule, url, w""",
    }


def streams() -> dict[str, str]:
    batch = archives() | usage() | ingest() | alerts()
    out = {f"stream_{n}": sql for n, sql in batch.items() if n.startswith("archive_") and not n.endswith("_rollup")}
    out |= {f"stream_{n}": batch[n] for n in ("alert_slow", "alert_error", "alert_warn", "alert_traffic")}
    return out | {"stream_append": batch["ingest_log"], "stream_pass_through": batch["scan_text"]}


def all_statements() -> dict[str, str]:
    groups = (archives, usage, ingest, answers, serving, merges, words_and_dates, alerts, streams)
    return {name: sql for group in groups for name, sql in group().items()}
