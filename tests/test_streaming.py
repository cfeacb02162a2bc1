"""Streams compared with the batch result on the same input."""

import glob
import os
import time

import pytest
from pyspark.sql import DataFrameWriter, Window
from pyspark.sql import functions as F

from compare import spark_rows
from studytrail.operators import archives as ar
from studytrail.plans.study_log import study_log
from studytrail.sources.messages import table_stream
from studytrail.operators import alerts as rules
from studytrail.streaming import alerts
from studytrail.streaming.archives import ArchiveStream
from studytrail.streaming.sinks import LateRows, each_batch, late_rows
from studytrail.streaming.visits import DAY_PARTS, GROUPS


@pytest.fixture(scope="module")
def files(spark, sf_dir, tmp_path_factory):
    """The study log as four files in order of arrival."""
    folder = tmp_path_factory.mktemp("stream")
    log = study_log(spark, sf_dir).where("dt < '20240106'")
    quarter = log.withColumn("q", F.ntile(4).over(Window.orderBy("seq"))).cache()
    for i in range(1, 5):
        quarter.where(F.col("q") == i).drop("q").coalesce(1).write.parquet(f"{folder}/part{i}")
    paths = [glob.glob(f"{folder}/part{i}/*.parquet")[0] for i in range(1, 5)]
    arrived = folder / "in"
    arrived.mkdir()
    return paths, log, arrived


def deliver(path, folder, n, age):
    target = folder / f"{n}.parquet"
    os.link(path, target)
    os.utime(target, (age, age))


def drain(spark, stream, folder, schema):
    query = stream.start(table_stream(spark, str(folder), schema, files_per_trigger=1), every=None)
    query.awaitTermination()
    return query


def batch_of(log, name):
    return ar.archive_factors(log, name) if name in ar.FACTORS else ar.archive(log, name)


def assert_equal(spark, stream, log):
    for name in stream.names:
        want = batch_of(log, name)
        assert spark_rows(stream.read(spark, name).select(*want.columns)) == spark_rows(want), name


@pytest.mark.parametrize(
    "names, keep_days",
    [
        (("course", "topic", "section", "tag", "question", "factor"), None),
        (("course_daily", "topic_daily", "section_daily", "tag_daily", "question_daily", "factor_daily"), 1),
    ],
)
def test_archive_streams_equal_batch(spark, files, tmp_path, names, keep_days):
    """Six archives in one pass; the stream is ended and goes on from its checkpoint."""
    paths, log, _ = files
    source = tmp_path / "in"
    source.mkdir()
    stream = ArchiveStream(str(tmp_path / "out"), names, keep_days)
    for i, path in enumerate(paths[:3]):
        deliver(path, source, i, 1_000_000 + i)
    drain(spark, stream, source, log.schema)
    deliver(paths[3], source, 3, 1_000_003)
    again = ArchiveStream(str(tmp_path / "out"), names, keep_days)
    drain(spark, again, source, log.schema)
    assert_equal(spark, again, log)
    assert (again.expired(spark) > 0) == (keep_days is not None)


def test_cadences_need_a_stream_each():
    with pytest.raises(ValueError):
        ArchiveStream("x", ("course", "course_daily"))


def test_repeated_batch_changes_nothing(spark, files, tmp_path):
    """A batch that fails after it was written is run again from the state before it, in the same place."""
    paths, log, _ = files
    source = tmp_path / "in"
    source.mkdir()
    for i, path in enumerate(paths[:2]):
        deliver(path, source, i, 1_000_000 + i)
    stream = ArchiveStream(str(tmp_path / "out"), "tag")
    write, failed = stream.write, []

    def fails_once(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after writing")

    stream.write = fails_once
    with pytest.raises(Exception, match="lost after writing"):
        drain(spark, stream, source, log.schema)
    drain(spark, stream, source, log.schema)
    assert failed == [1]
    assert_equal(spark, stream, spark.read.schema(log.schema).parquet(*paths[:2]))


def test_hot_account_in_a_stream(spark, files, tmp_path):
    paths, log, _ = files
    parts = [spark.read.schema(log.schema).parquet(p).withColumn("account_id", F.expr("if(seq % 3 = 0, 1, account_id)")) for p in paths[:2]]
    source = tmp_path / "in"
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(str(source))
    stream = ArchiveStream(str(tmp_path / "out"), ("course", "topic", "tag"))
    drain(spark, stream, source, log.schema)
    assert_equal(spark, stream, parts[0].unionByName(parts[1]))


@pytest.mark.parametrize("name", ["topic_daily", "tag_daily", "factor_daily"])
def test_state_goes_by_groups_of_accounts(spark, files, tmp_path, name):
    """Keys and accesses of the state are bounded by groups, days and parts, however many accounts there are; accounts stay apart."""
    paths, log, _ = files
    parts = [spark.read.schema(log.schema).parquet(p).where("dt < '20240103'") for p in paths[:2]]
    parts = [p.withColumn("account_id", F.expr("if(seq % 5 = 0, null, seq % 1500)")).withColumn("dt", F.lit("20240101")).cache() for p in parts]
    source = tmp_path / "in"
    stream = ArchiveStream(str(tmp_path / "out"), name)
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(str(source))
        query = drain(spark, stream, source, log.schema)
    log = parts[0].unionByName(parts[1])
    assert_equal(spark, stream, log)
    accounts, held = log.select("account_id").distinct().count(), query.lastProgress.stateOperators[0].numRowsTotal
    assert 0 < held <= GROUPS * DAY_PARTS < accounts


def one_course(spark, log, *rows):
    """Submits of account 1 in course 1: (seq, day or None)."""
    base = log.where("src_type = 'SUBMIT_QUESTION'").limit(1).drop("seq", "dt", "epoch_s", "account_id", "course_id")
    made = spark.createDataFrame([(s, d, 1, 1) for s, d in rows], "seq bigint, dt string, account_id bigint, course_id bigint")
    made = made.withColumn("epoch_s", F.unix_timestamp(F.to_timestamp("dt", "yyyyMMdd")) + F.col("seq"))
    return base.crossJoin(F.broadcast(made)).select(*log.columns)


def deliveries(spark, log, tmp_path, *batches):
    source = tmp_path / "in"
    source.mkdir()
    for i, rows in enumerate(batches):
        one_course(spark, log, *rows).coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
        deliver(glob.glob(f"{tmp_path}/part{i}/*.parquet")[0], source, i, 1_000_000 + i)
    return source


def test_old_days_expire_and_are_counted(spark, files, tmp_path):
    """A day's state goes once the latest event is ``keep_days`` after it; a row of that day is late then, and counted."""
    _, log, _ = files
    days = ("20240102", "20240103", "20240110", "20240111")
    source = deliveries(spark, log, tmp_path, *([(i, d)] for i, d in enumerate(days)), [(9, "20240102")])
    stream = ArchiveStream(str(tmp_path / "c"), "course_daily", keep_days=1)
    query = drain(spark, stream, source, log.schema)
    assert stream.expired(spark) == 2
    assert {(r.dt, r.entries, r.answers) for r in stream.read(spark).collect()} == {(d, 1, 1) for d in days}
    assert sum(map(late_rows, query.recentProgress)) == 1


def test_events_from_the_future_expire_nothing(spark, files, tmp_path):
    _, log, _ = files
    source = deliveries(spark, log, tmp_path, [(1, "20990101")], [(2, "20990101")])
    stream = ArchiveStream(str(tmp_path / "c"), "course_daily", keep_days=1)
    drain(spark, stream, source, log.schema)
    assert {(r.dt, r.entries, r.answers) for r in stream.read(spark).collect()} == {("20990101", 1, 2)}


def calls_of(spark, rows):
    made = spark.createDataFrame(rows, "ts string, level string, use_time bigint, url string")
    return made.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_sent_alerts_are_those_a_batch_changes(spark, tmp_path):
    at = "2024-01-01 10:{}"
    parts = [
        [(at.format("00:10"), "warn", 1, "/a"), (at.format("00:20"), "warn", 1, "/a"), (at.format("00:30"), "warn", 1, "/b")],
        [(at.format("00:59"), "warn", 1, "/a"), (at.format("05:00"), "warn", 1, "/b")],
        [(at.format("01:01"), "warn", 1, "/a"), (at.format("05:10"), "warn", 1, "/b"), (at.format("05:20"), "warn", 1, "/b")],
        [(at.format("30:00"), "info", 1, "/a")],
    ]
    sent, source = {}, tmp_path / "in"
    stream = alerts.warn_stream(str(tmp_path / "out"), send=lambda rows, i: sent.setdefault(i, sorted((r.url, str(r.at), r.amount) for r in rows.collect())))
    for i, rows in enumerate(parts):
        calls_of(spark, rows).coalesce(1).write.mode("append").parquet(str(source))
        drain(spark, stream, source, calls_of(spark, []).schema)
    whole = calls_of(spark, [r for p in parts for r in p])
    assert spark_rows(stream.read(spark)) == spark_rows(rules.warn_bursts(whole))
    assert sent[0] == [] and sent[1] == [("/a", "2024-01-01 10:00:59", 3)]
    assert sent[2] == [("/a", "2024-01-01 10:01:01", 4), ("/b", "2024-01-01 10:05:20", 3)]
    assert all(not rows for i, rows in sent.items() if i > 2)


def test_each_partition_of_the_counts_has_a_task(spark, tmp_path, monkeypatch):
    """The state's partitions are not worked off several in one task, however many there are."""
    calls = calls_of(spark, [(f"2024-01-01 10:{i // 60:02d}:{i % 60:02d}", "warn", 1, f"/{i % 7}") for i in range(600)])
    calls.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream, seen = alerts.warn_stream(str(tmp_path / "out")), set()
    write = DataFrameWriter.parquet

    def watched(writer, path, **options):
        if str(tmp_path / "out") in path:
            plan = writer._df._jdf.queryExecution().optimizedPlan().toString()
            seen.add("Repartition 4, true" in plan)
        return write(writer, path, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    drain(spark, stream, tmp_path / "in", calls.schema)
    assert seen == {True}
    assert spark_rows(stream.read(spark)) == spark_rows(rules.warn_bursts(calls))


def test_traffic_sends_only_windows_of_the_batch(spark, tmp_path):
    def calls(minute, url, n):
        return [(f"2024-01-01 10:{minute:02d}:{i:02d}", "info", 1, url) for i in range(n)]

    parts = [calls(1, "/a", 2) + calls(6, "/a", 3), calls(7, "/a", 4), calls(2, "/a", 9)]
    sent, source = {}, tmp_path / "in"
    stream = alerts.traffic_stream(str(tmp_path / "out"), send=lambda rows, i: sent.setdefault(i, sorted((str(r.at)[11:16], r.amount) for r in rows.collect())))
    for rows in parts:
        calls_of(spark, rows).coalesce(1).write.mode("append").parquet(str(source))
        drain(spark, stream, source, calls_of(spark, []).schema)
    assert [sent[i] for i in range(3)] == [[("10:00", 2)], [("10:05", 7)], [("10:00", 11)]]
    whole = calls_of(spark, [r for p in parts for r in p])
    assert spark_rows(stream.read(spark)) == spark_rows(rules.traffic_jumps(whole))


def test_late_alerts_of_the_rate_limit_are_counted(spark, tmp_path):
    rows = [[("2024-01-01 10:00:00", "error", 1, "/a")], [("2024-01-01 12:00:00", "error", 1, "/a")], [("2024-01-01 09:00:00", "error", 1, "/a")] * 3]
    source, counter = tmp_path / "in", LateRows()
    for i, part in enumerate(rows):
        calls_of(spark, part).coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
    source.mkdir()
    for i in range(len(rows)):
        deliver(glob.glob(f"{tmp_path}/part{i}/*.parquet")[0], source, i, 1_000_000 + i)
    passed = alerts.call_alerts(table_stream(spark, str(source), calls_of(spark, []).schema, files_per_trigger=1))
    spark.streams.addListener(counter)
    got = []
    query = each_batch(passed, lambda b, _: got.extend(str(r.at) for r in b.collect()), str(tmp_path / "checkpoint"), every=None)
    query.awaitTermination()
    assert got == ["2024-01-01 10:00:00", "2024-01-01 12:00:00"]
    assert sum(map(late_rows, query.recentProgress)) == 3
    for _ in range(50):
        if counter.counts.get(str(query.id)) == 3:
            break
        time.sleep(0.2)
    spark.streams.removeListener(counter)
    assert counter.counts[str(query.id)] == 3
