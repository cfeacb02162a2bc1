"""Whole jobs on the study log."""

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from studytrail.operators import archives as ar
from studytrail.plans import jobs, rendered
from studytrail.plans.study_log import API_GO, as_study_log, study_log
from studytrail.schema import API_SUBMIT, INDICATORS
from studytrail.sources.messages import table_stream


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    return study_log(spark, sf_dir).where("dt < '20240104'").cache()


def test_lines_to_archives(spark, log, tmp_path):
    seq = F.regexp_extract("value", r"^\S+ \S+ (\d+)", 1).cast("bigint").alias("seq")
    jobs.ingest_lines(rendered.damaged_lines(log), str(tmp_path / "events"), seq)
    events = jobs.read_events(spark, str(tmp_path / "events"))
    rejected = jobs.read_rejected(spark, str(tmp_path / "events"))
    damaged = " or ".join(f"seq % {n} = 0" for n in (97, 101, 103, 107, 109, 113, 127, 131))
    assert rejected.count() == log.where(damaged).count()
    jobs.write_archives(events, str(tmp_path / "archives"), ["topic", "tag", "factor", "question_daily"])
    good = log.where(f"not ({damaged})")
    for name in ("topic", "tag", "question_daily"):
        want = ar.archive(good, name)
        want = want.select(*(F.col(c).cast("string") if c in ar.ARCHIVES[name].keys else c for c in want.columns))
        assert spark_rows(spark.read.parquet(str(tmp_path / "archives" / name))) == spark_rows(want)
    assert spark.read.parquet(str(tmp_path / "archives" / "factor")).count() > 0


def test_reports_keep_values_and_move_update_time(spark, log):
    usage_log = rendered.usage_log(log)
    half = usage_log.where(F.col("event").cast("bigint") % 2 == 0)
    args = ("20240103", API_GO, API_SUBMIT, F.col("epoch_s"))
    first = {
        n: r.withColumn("update_time", F.lit(None).cast("string")) for n, r in jobs.usage_reports(half, *args).items()
    }
    new = jobs.usage_reports(usage_log, *args)
    merged = jobs.merge_reports(first, new, "now")
    for name, (keys, measures) in jobs.REPORTS.items():
        old, now = first[name], merged[name]
        assert now.count() == new[name].count()
        kept = now.where("update_time is not null").select(*keys, *measures)
        assert spark_rows(kept) == spark_rows(old.select(*keys, *measures))


def test_user_documents(log):
    docs = jobs.user_documents({t: rendered.indicator(log, t) for t in INDICATORS}, "2024-01-03")
    assert set(docs) == set(INDICATORS)
    assert docs["up_week"].columns == ["key", "score", "part", "member"]
    total = docs["up_total"]
    assert total.count() == log.where("dt = '20240102'").select("account_id").distinct().count()
    assert total.where("key like '%<=>up_total'").count() == total.count()


def test_answers(spark, log, tmp_path):
    jobs.write_answers(rendered.answer_lines(log), str(tmp_path / "a"), str(tmp_path / "r"))
    forms = {r["f"]: r["n"] for r in log.groupBy((F.col("seq") % 7).alias("f")).agg(F.count("*").alias("n")).collect()}
    assert spark.read.text(str(tmp_path / "a")).count() == forms[0] + 2 * forms[1] + 2 * forms[2] + forms[3]
    assert spark.read.parquet(str(tmp_path / "r")).count() == forms[4] + forms[5] + forms[6]


def test_one_stream_for_several_archives(spark, sf_dir, tmp_path):
    small = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id < 800")
    for i in range(2):
        small.where(f"event_id div 400 = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = as_study_log(table_stream(spark, str(tmp_path / "in"), small.schema, 1))
    queries, streams = jobs.start_archives(stream, str(tmp_path / "out"), ["course", "question", "factor", "topic_daily"], every=None)
    assert len(queries) == 2
    for query in queries:
        query.awaitTermination()
    whole = as_study_log(small)
    for name, s in streams.items():
        want = ar.archive_factors(whole, name) if name in ar.FACTORS else ar.archive(whole, name)
        assert spark_rows(s.read(spark, name).select(*want.columns)) == spark_rows(want)
