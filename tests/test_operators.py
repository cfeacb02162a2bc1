"""Parsers, answers, merges, documents, words, alerts and sinks on small inputs."""

import datetime as dt
import hashlib
import json
import time

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from studytrail.functions import dates, text
from studytrail.operators import alerts, answers, merge, serving, usage, words
from studytrail.operators import archives as ar
from studytrail.operators.answers import DELIMITER
from studytrail.plans import jobs
from studytrail.plans.study_log import study_log
from studytrail.sources import logs, messages, tables
from studytrail.streaming import alerts as stream_alerts
from studytrail.streaming import sinks


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_event_lines(spark):
    good = '1 ip 0 {"time":"2024-01-02 00:00:01","data":{"account_id":11,"account_id":"12","cost_time":"5","ability":1,"module_type":3}}'
    at = '"time":"2024-01-02 00:00:01"'
    parsed = logs.parse_events(
        lines(spark, good, 'x {"time":"t"} junk', 'x {"time":"t"}{"a":1}', "nothing", 'x {"time":', None,
              f"x {{{at}}} ", f'x {{{at},"data":"oops"}}', 'x {"a":1}', f'x {{{at},"data":{{}}}}',
              'x {"time":"2024-13-01 00:00:00","data":{"account_id":1}}', 'x {"data":{"account_id":1}}', f'x {{{at},"data":{{"stage":1}}}}',
              f'x {{{at},"data":{{"account_id":1,"cost_time":"5.5"}}}}', f'x {{{at},"data":{{"account_id":1,"factor_codes":"g"}}}}')
    )
    first, = logs.events_of(parsed).collect()
    assert (first.account_id, first.cost_time, first.ability, first.section_id, first.dt) == ("12", 5, 1.0, "3", "20240102")
    assert first.epoch_s is not None and first.factor_codes is None
    reasons = [r.reason for r in logs.rejected(parsed).collect()]
    assert sorted(reasons) == sorted(
        ["malformed json"] * 3 + ["no payload"] * 2 + ["no data"] * 4 + ["bad time"] * 2
        + ["no account", "bad field cost_time", "bad field factor_codes"]
    )


def test_api_lines(spark):
    parsed = logs.parse_api_log(
        lines(spark, 'a {"env":"h.off","edApp":{"appId":"q"}}', 'a {"env":"h.on","edApp":"{\\"appId\\":\\"z\\"}"}',
              'a {"time":"2024-01-01 10:20:30"} {', 'a {"env": {"b":1}}', "b {")
    )
    rows = logs.normalize(logs.records_of(parsed), ".off", ".on").select("subject", "onoff", "hour")
    assert spark_rows(rows) == sorted(
        [("2024-01-01 10", "-1", None), (None, "off", "q"), (None, "on", "z")], key=repr
    )
    assert logs.rejected(parsed).count() == 2


def answer_row(field, width=25):
    cells = [f"f{i}" for i in range(width)]
    if width > 22:
        cells[22] = field
    return DELIMITER.join(cells)


def test_answers(spark):
    rows = [
        answer_row('[{"q1":{"is_right":1,"x":[1,2]}}]'),
        answer_row('[{"q1":{"is_right":1}},{"q2":{}},{"q3":"zz"}]'),
        answer_row('{"q1":{"is_right":"2"},"q2":5}'),
        answer_row('[{"q1":{}}]', 23),
        answer_row('{"q":{}}') + DELIMITER,
        answer_row(""), answer_row("[]"), answer_row("{}"), answer_row("[{}]"), answer_row('{"a":'),
        answer_row('[{"q":{}}] z'), answer_row("[1,2]"), answer_row('{"q":{}}', 26),
    ]
    read = answers.read_answers(lines(spark, *rows))
    out = answers.explode_answers(read)
    got = sorted((r.question_id, r.answer, r.is_right) for r in out.collect())
    assert got == sorted(
        [("q1", '{"is_right":1,"x":[1,2]}', "1"), ("q1", '{"is_right":1}', "1"), ("q2", "{}", "0"), ("q3", "zz", "0"),
         ("q1", '{"is_right":"2"}', "2"), ("q2", "5", "0"), ("q1", "{}", "0"), ("q", "{}", "0")]
    )
    assert all(len(r.fields) == 25 for r in out.collect())
    assert read.where("reason is not null").count() == 8
    written = [r.value for r in answers.to_delimited(out).collect()]
    assert all(v.endswith(DELIMITER) and v.count(DELIMITER) == 28 for v in written)


def test_last_of_repeated_questions_counts(spark):
    rows = [answer_row('{"q1":{"is_right":1},"q2":{},"q1":{"is_right":2}}'), answer_row('[{"q3":{},"q3":{"is_right":1}},{"q3":{}}]')]
    out = answers.explode_answers(answers.read_answers(lines(spark, *rows)))
    got = [(r.question_id, r.is_right) for r in out.collect()]
    assert sorted(got) == [("q1", "2"), ("q2", "0"), ("q3", "0"), ("q3", "1")]


def test_words_of_a_long_blank_line(spark):
    df = lines(spark, " " * 100_000 + "x", "? " * 50_000, "?" * 100_000)
    start = time.perf_counter()
    got = {r.word: r.n for r in words.word_count(df).collect()}
    assert got == {"": 100_001, "x": 1}
    assert time.perf_counter() - start < 30


def test_words(spark):
    df = lines(spark, "a  b ", " x", "? ", "?", "\t ", "https://q?p", "", "b b x")
    got = {r.word: r.n for r in words.word_count(df).collect()}
    assert got == {"a": 1, "": 3, "b": 3, "x": 2, "wwws://qp": 1}
    top = [(r.word, r.n) for r in words.word_count_topn(df, 3).collect()]
    assert top == [("b", 3), ("", 3), ("x", 2)]


def test_usage_nulls(spark):
    log = spark.createDataFrame(
        [("u", "1", usage.API_GO, 10), ("u", "1", usage.API_SUBMIT, 25), ("u", "2", usage.API_SUBMIT, 5),
         ("u", None, "x", 1), ("v", "3", usage.API_GO, 7), ("w", None, "x", 1)],
        "user_id string, question_id string, api string, at bigint",
    )
    at = F.col("at")
    got = {(r.user_id, r.question_id): r.duration for r in usage.question_duration(log, seconds=at).collect()}
    assert got == {("u", "1"): 15, ("u", "2"): None, ("u", None): None, ("v", "3"): 7, ("w", None): None}
    avg = {r.user_id: (r.question_num, r.total_time, r.avg_dotime) for r in usage.user_avg_duration(log, seconds=at).collect()}
    assert avg == {"u": (3, 15, 5), "v": (1, 7, 7), "w": (0, None, None)}


def test_merges(spark):
    target = spark.createDataFrame([("a", 1, None), ("b", 2, "t0"), (None, 3, None)], "k string, n long, update_time string")
    new = spark.createDataFrame([("b", 10, None), ("c", 20, None), (None, 30, None)], target.schema)
    added = merge.merge_additive(target, new, ["k"], ["n"])
    assert spark_rows(added) == sorted([("a", 1), ("b", 12), ("c", 20), (None, 33)], key=repr)
    replaced = merge.merge_replace(target, new, ["k"]).select("k", "n")
    assert spark_rows(replaced) == sorted([("a", 1), ("b", 10), ("c", 20), (None, 30)], key=repr)
    assert spark_rows(merge.merge_replace(replaced, new.select("k", "n"), ["k"])) == spark_rows(replaced)
    kept = merge.merge_insert_if_absent(target, new, ["k"], "now")
    assert spark_rows(kept) == sorted(
        [("a", 1, None), ("b", 2, "now"), ("c", 20, None), (None, 3, "now")], key=repr
    )
    plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("Exchange") <= 2 and plan.count("Join") == 1
    rows = spark.createDataFrame([("a", 1, 5), ("a", 2, 4), ("b", 1, 1)], "k string, o int, v int")
    assert spark_rows(merge.pick(rows, ["k"], ["o"])) == [("a", 2, 4), ("b", 1, 1)]
    assert spark_rows(merge.pick(rows, ["k"], ["o"], last=False)) == [("a", 1, 5), ("b", 1, 1)]


def test_a_hot_user_has_documents_like_the_others(spark):
    rows = spark.range(300).select(
        F.when(F.col("id") < 100, "hot").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("user_id"),
        F.col("id").alias("n"), F.lit("1").alias("dt"),
    )
    columns = ["user_id", "n", "dt"]
    docs = serving.user_docs(rows, "t", columns, ["n"])
    assert docs.count() == 201 and docs.where("part <> 0").count() == 0
    hot = docs.where("key = 'hot<=>t'").select(F.from_json("value", "array<map<string,string>>").alias("v")).first().v
    assert [int(m["n"]) for m in hot] == list(range(100))
    parts = serving.user_docs(rows, "t", columns, ["n"], F.expr("n div 20")).where("key = 'hot<=>t'").orderBy("part")
    parsed = parts.select(F.from_json("value", "array<map<string,string>>").alias("v")).collect()
    assert [int(m["n"]) for r in parsed for m in r.v] == list(range(100)) and len(parsed) == 5
    scores = serving.user_week_scores(rows, "t", columns, ["n"], part=F.expr("n div 20")).where("key = 'hot<=>t'")
    assert sorted((r.score, r.part) for r in scores.collect()) == [(1.0, i) for i in range(5)]
    entries = serving.entry_rows(rows, ["user_id"], columns, ["n"]).where("user_id = 'hot'").orderBy("position").collect()
    assert [r.position for r in entries] == list(range(1, 101)) and entries[7].entry == '{"user_id":"hot","n":"7","dt":"1"}'


def test_null_values_in_documents(spark):
    rows = spark.createDataFrame([("u", None, "1")], "user_id string, n int, dt string")
    assert serving.user_docs(rows, "t", rows.columns, ["n"]).first().value == '[{"user_id":"u","n":"null","dt":"1"}]'


def test_cells(spark):
    rows = spark.createDataFrame([("r1", 1, None), ("r2", 2, "x")], "id string, a int, b string")
    cells = serving.columns_to_cells(rows, F.col("id"), "cf", ["a", "b"])
    assert spark_rows(serving.read_cells(cells, "r2", "cf")) == [("a", "2"), ("b", "x")]
    maps = {r.rowkey: r.cells for r in serving.cells_to_map(cells).collect()}
    assert maps == {"r1": {"a": "1"}, "r2": {"a": "2", "b": "x"}}


def test_keys_and_dates(spark):
    row = spark.range(1).select(
        text.md5_key(F.lit("a"), F.lit("b")).alias("md5"),
        text.split_key(text.join_key(F.lit("u"), F.lit("t"))).alias("parts"),
        dates.previous_day(F.lit("2024-03-01").cast("date")).alias("before"),
        dates.epoch_millis(F.lit("1970-01-02 00:00:00")).alias("ms"),
        dates.epoch_millis(F.lit("bad")).alias("bad"),
        dates.time_text(F.lit(86400000)).alias("again"),
        dates.earliest(F.array(F.lit(""), F.lit("b"), F.lit("a"))).alias("first"),
        dates.week_of_year(F.lit("2024-12-30").cast("date")).alias("week"),
    ).first()
    assert row.md5 == hashlib.md5(b"a_b").hexdigest()
    assert (row.parts, row.before, row.bad, row.first, row.week) == (["u", "t"], "20240229", None, "a", 1)
    assert row.again == "1970-01-02 00:00:00" and row.ms == 86400000


def calls(spark, *rows):
    return spark.createDataFrame(
        [(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), lv, ms, url) for s, lv, ms, url in rows],
        "ts timestamp, level string, use_time bigint, url string",
    )


def test_alert_rules(spark):
    df = calls(
        spark, (0, "warn", 10, "/a"), (20, "warn", 10, "/a"), (59, "warn", 10, "/a"), (61, "warn", 10, "/a"),
        (5, "warn", 1, "/b"), (7, "error", 1, "/b"), (8, "info", 1001, "/c"), (9, "info", 1000, "/c"),
    )
    assert sorted((r.url, r.at.minute, r.at.second, r.amount) for r in alerts.warn_bursts(df).collect()) == [("/a", 0, 59, 3), ("/a", 1, 1, 3)]
    across = calls(spark, (50, "warn", 1, "/a"), (55, "warn", 1, "/a"), (65, "warn", 1, "/a"))
    assert [(r.at.minute, r.at.second, r.amount) for r in alerts.warn_bursts(across).collect()] == [(1, 5, 3)]
    spread = calls(spark, (25, "warn", 1, "/a"), (50, "warn", 1, "/a"), (70, "warn", 1, "/a"), (131, "warn", 1, "/a"))
    assert [(r.at.minute, r.at.second) for r in alerts.warn_bursts(spread).collect()] == [(1, 10)]
    assert [r.url for r in alerts.error_calls(df).collect()] == ["/b"]
    assert [(r.url, r.amount) for r in alerts.slow_calls(df).collect()] == [("/c", 1001)]
    many = [(s, "info", 1, "/a") for s in range(3)] + [(300 + s, "info", 1, "/a") for s in range(6)]
    many += [(600 + s, "info", 1, "/a") for s in range(13)] + [(600, "info", 1, "/z")]
    got = sorted((r.url, r.amount) for r in alerts.traffic_jumps(calls(spark, *many), top=1).collect())
    assert got == [("/a", 3), ("/a", 13)]
    both = alerts.slow_calls(calls(spark, *[(s, "info", 2000 + s, "/a") for s in (1, 100, 599, 601)]))
    got = [(r.amount, r.suppressed) for r in alerts.limit_rate(both).orderBy("at").collect()]
    assert got == [(2001, 2), (2601, 0)]


def test_alert_lines(spark):
    df = logs.alert_calls(lines(spark, "2024-01-01 00:00:00##x##ERROR##a##b##c##12##d##/u", "a##b##c", "t##x##W##a##b##c##no##d##/v"))
    got = sorted((r.level, r.use_time, r.url) for r in df.select("level", F.coalesce("use_time", F.lit(-1)).alias("use_time"), "url").collect())
    assert got == [("error", 12, "/u")]


def test_unreadable_calls_are_kept_apart(spark):
    parsed = logs.parse_calls(lines(spark, "2024-01-01 00:00:00##x##ERROR##a##b##c##12##d##/u", "a##b##c", None, "t##x##W##a##b##c##no##d##/v"))
    got = sorted((r.raw or "", r.reason) for r in logs.rejected(parsed, "line").collect())
    assert got == [("", "too few fields"), ("a##b##c", "too few fields"), ("t##x##W##a##b##c##no##d##/v", "bad time")]


def test_alert_stream(spark, tmp_path):
    df = calls(spark, (1, "error", 1, "/a"), (30, "error", 1, "/a"), (31, "error", 1, "/b"), (5000, "error", 1, "/a"))
    for i, part in enumerate([df.where("minute(ts) < 2"), df.where("minute(ts) >= 2")]):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "calls"))
    stream = messages.table_stream(spark, str(tmp_path / "calls"), df.schema, 1)
    found = stream_alerts.call_alerts(stream)
    sinks.append_files(found, str(tmp_path / "out"), str(tmp_path / "cp"), every=None).awaitTermination()
    urls = sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert urls == ["/a", "/a", "/b"]


def test_bursts_on_a_stream(spark, tmp_path):
    """Warnings of one burst come in two batches, one of them late; alerts are sent when complete, nothing is lost."""
    sent = []
    stream = stream_alerts.warn_stream(str(tmp_path / "w"), send=lambda found, n: sent.append((n, sorted((r.url, r.at.second, r.amount) for r in found.collect()))))
    parts = [[(5, "warn", 1, "/a"), (20, "warn", 1, "/a")], [(4000, "info", 1, "/z")], [(30, "warn", 1, "/a"), (4000, "warn", 1, "/b")], [(40, "warn", 1, "/a")]]
    write, failed = stream.write, []

    def fails_once(totals, number):
        write(totals, number)
        if number == 3 and not failed:
            failed.append(number)
            raise RuntimeError("lost after writing")

    stream.write = fails_once
    for part in parts:
        calls(spark, *part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        arriving = messages.table_stream(spark, str(tmp_path / "in"), calls(spark, *part).schema)
        try:
            stream.start(arriving, every=None).awaitTermination()
        except Exception as e:  # the last batch, which is run once more
            assert "lost after writing" in str(e)
            stream.start(arriving, every=None).awaitTermination()
    assert failed and [(n, f) for n, f in sent if f] == [(2, [("/a", 30, 3)]), (3, [("/a", 30, 4)]), (3, [("/a", 30, 4)])]
    want = alerts.warn_bursts(calls(spark, *(r for part in parts for r in part)))
    assert spark_rows(stream.read(spark)) == spark_rows(want)


def test_message_stream_and_sinks(spark, tmp_path):
    rows = spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    out = serving.to_messages(rows, "topic", F.col("k"))
    assert out.columns == ["topic", "key", "value"]
    kept = out.select(
        "key", "value", "topic", F.lit(0).alias("partition"), F.col("key").cast("bigint").alias("offset"),
        F.lit(dt.datetime(2024, 1, 1)).alias("timestamp"),
    )
    kept.write.parquet(str(tmp_path / "in"))
    stream = messages.file_stream(spark, str(tmp_path / "in"), 1)
    written = str(tmp_path / "rows")

    def write(batch, number):
        sinks.number_rows(batch).write.mode("overwrite").parquet(f"{written}/{number}")

    sinks.each_batch(stream, write, str(tmp_path / "cp"), every=None).awaitTermination()
    back = spark.read.parquet(f"{written}/*")
    assert back.count() == 5 and back.agg(F.min("no")).first()[0] == 11
    sinks.append_table(stream, "kept_messages", str(tmp_path / "cp2"), every=None).awaitTermination()
    assert spark.table("kept_messages").count() == 5
    sinks.to_console(stream.select("value"), every=None).awaitTermination()
    options = messages.kafka_options("host:1", "study", max_per_trigger=7)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "7"
    with pytest.raises(Exception):
        messages.kafka_stream(spark, "host:1", "study")


def test_tables(spark, tmp_path):
    rows = spark.createDataFrame([("a", "20240101", 1), ("b", "20240102", 2)], "source string, dt string, n int")
    tables.write_by_day(rows, str(tmp_path / "t"), ("source", "dt"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert [r.n for r in tables.of_previous_day(back, "2024-01-02").collect()] == [1]
    assert [r.n for r in tables.of_date(back, "20240102").collect()] == [2]
    assert tables.of_date(back, "20240102", sources=["a"]).count() == 0
    plan = tables.of_date(back, "20240102")._jdf.queryExecution().toString()
    tables.write_by_day(rows, str(tmp_path / "u"), gather=False)
    assert spark.read.parquet(str(tmp_path / "u")).count() == 2
    assert "PartitionFilters: [isnotnull(dt" in plan or "PartitionFilters: [(cast(dt" in plan
    spark.sql("create database if not exists db_t")
    rows.write.mode("overwrite").saveAsTable("db_t.rows_t")
    assert tables.read_database_table(spark, "db_t", "rows_t").count() == 2


def test_a_hot_key_is_numbered_by_many_tasks(spark):
    n = 4000
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.when(F.col("id") % 20 == 9, "cold")).alias("user_id"), (F.lit(n) - F.col("id")).alias("n"), F.lit("1").alias("dt")
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        numbered, _ = serving._ranges(rows, ["user_id"], ["user_id", "n", "dt"], ["n"])
        parts = [r["count"] for r in numbered.groupBy("user_id", "_range").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(parts) == n and max(parts) <= n / 10
    entries = serving.entry_rows(rows, ["user_id"], ["user_id", "n", "dt"], ["n"]).collect()
    for user in ("hot", "cold", None):
        own = sorted((r.position, int(json.loads(r.entry)["n"])) for r in entries if r.user_id == user)
        assert [p for p, _ in own] == list(range(1, len(own) + 1)) and [v for _, v in own] == sorted(v for _, v in own) and own
    docs = serving.document_parts(rows, ["user_id"], ["user_id", "n", "dt"], ["n"], 100).where("user_id = 'hot'").orderBy("part").collect()
    assert [len(json.loads(d.value)) for d in docs] == [100] * 36


def test_daily_accounts_add_up_to_distinct_ones(spark):
    columns = "account_id bigint, dt string, src_type string, is_right string, is_view_analyze string, factor_codes array<string>, course_id int, lesson_id int, topic_id int, section_id int"
    rows = [(a, d, "SUBMIT_QUESTION", "1", "0", f, 1, 1, 1, 1) for a, d, f in [
        (1, "d1", ["x", "x"]), (1, "d2", ["x"]), (40_000, "d1", ["x", "y"]), (-5, "d2", ["x"]), (None, "d1", ["x"]), (2, "d2", []), (2, None, ["y"]), (32_769, "d2", ["x"]), (1 << 40, "d1", ["y"]),
    ]]
    events = spark.createDataFrame(rows, columns)
    days = ar.factor_days(events)
    want = ar.archive_factors(events, "factor")
    assert spark_rows(ar.roll_up_factors(days).select(*want.columns)) == spark_rows(want)
    assert spark_rows(ar.roll_up_factors(days.where("dt = 'd1'")).select(*want.columns)) == spark_rows(ar.archive_factors(events.where("dt = 'd1'"), "factor"))


def test_levels_of_distinct_users(spark):
    log = spark.createDataFrame([("a", "on", 1), ("a", "off", 1), ("a", "off", 2), (None, "on", 3), ("b", None, None)], "subject string, onoff string, user_id int")
    got = {(r.level, r.subject, r.onoff): r.uv for r in usage.uv_levels(log, "subject", "onoff").collect()}
    assert got == {
        (0, "a", "on"): 1, (0, "a", "off"): 2, (0, None, "on"): 1, (0, "b", None): 0, (1, "a", None): 2, (1, None, None): 1, (1, "b", None): 0, (2, None, None): 3,
    }


def test_a_clustered_table_is_not_shuffled(spark, sf_dir, tmp_path):
    """Rows are ordered by account without an exchange; what is exchanged has been aggregated before. A table as it is needs one."""

    def exchanged_rows(df):
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
        below = [plan[i + 1] for i, line in enumerate(plan) if "Exchange hashpartitioning(account_id" in line]
        return sum("Aggregate" not in line for line in below)

    log = study_log(spark, sf_dir).drop("factor_codes", "ts")
    spark.sql("CREATE DATABASE IF NOT EXISTS clustered_test")
    tables.write_clustered(log, "clustered_test", "events", str(tmp_path / "events"), buckets=4)
    held = tables.read_database_table(spark, "clustered_test", "events")
    for name in ("course", "section", "tag_daily", "topic_daily"):
        plain, clustered = ((ar.archive(df, name)) for df in (log, held))
        assert exchanged_rows(plain) > 0 and exchanged_rows(clustered) == 0, name
        assert spark_rows(clustered) == spark_rows(plain)
    spark.sql("DROP DATABASE clustered_test CASCADE")


def test_all_archives_read_the_log_once(spark, sf_dir, tmp_path):
    log = study_log(spark, sf_dir).limit(3000)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    events = log.coalesce(1).mapInArrow(counted, log.schema)
    jobs.write_archives(events, str(tmp_path), [*ar.ARCHIVES, "factor"])
    assert reads.value == 3000
    for name in ("tag", "question_daily"):
        assert spark_rows(spark.read.parquet(f"{tmp_path}/{name}")) == spark_rows(ar.archive(log, name))
