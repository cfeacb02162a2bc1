"""Registered streaming queries: the events table read as a stream until it is exhausted.

Archives and counted alerts get it as several deliveries, so that state is carried between micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrail.functions import dates
from studytrail.operators import alerts as rules
from studytrail.operators import archives
from studytrail.plans import rendered
from studytrail.plans.study_log import as_study_log
from studytrail.session import shared_folder
from studytrail.sources import logs
from studytrail.sources.messages import table_stream
from studytrail.streaming import alerts, sinks
from studytrail.streaming.archives import ArchiveStream

Query = Callable[[SparkSession, str], DataFrame]


PARTS = 4


def _arriving(spark: SparkSession, sf: str, root: str, run: Callable[[DataFrame], None]) -> None:
    """The events as four deliveries in order of their ids: each is written, then the stream run until it is caught up."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    shares = [i / PARTS for i in range(1, PARTS)]
    bounds = [-1, *events.agg(F.percentile_approx("event_id", shares, 10_000)).first()[0], (1 << 62)]
    for i in range(PARTS):
        part = events.where((F.col("event_id") > bounds[i]) & (F.col("event_id") <= bounds[i + 1]))
        part.write.parquet(f"{root}/in/delivery{i}")
        run(as_study_log(table_stream(spark, f"{root}/in/*", events.schema)))


def _log_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    # A pattern, since the table may be one file or a folder of files and a stream's path may not be a file.
    return as_study_log(table_stream(spark, f"{sf}/event[s].parquet", schema))


def _archive(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        root = shared_folder(spark, f"stream-{name}")
        stream = ArchiveStream(f"{root}/state", name)
        _arriving(spark, sf, root, lambda log: stream.start(log, every=None).awaitTermination())
        return stream.read(spark)

    return run


def _counted(name: str, make: Callable[..., alerts.CountedAlerts], *args) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        root = shared_folder(spark, name)
        stream = make(f"{root}/state", *args)
        calls = lambda log: logs.alert_calls(rendered.call_lines(log))
        _arriving(spark, sf, root, lambda log: stream.start(calls(log), every=None).awaitTermination())
        return stream.read(spark).withColumn("at", F.date_format("at", dates.TIME))

    return run


def _appended(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    root = shared_folder(spark, name)
    sinks.append_files(rows, f"{root}/rows", f"{root}/checkpoint", every=None).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/rows")


def stream_append(spark: SparkSession, sf: str) -> DataFrame:
    """Lines parsed and appended to a table."""
    records = logs.records_of(logs.parse_ingest_log(rendered.api_lines(_log_stream(spark, sf))))
    return _appended(spark, records, "stream-append").select("env", "time", "user_id", "api", "folw_id")


def stream_pass_through(spark: SparkSession, sf: str) -> DataFrame:
    values = rendered.call_lines(_log_stream(spark, sf)).select(F.col("value").cast("string"))
    return _appended(spark, values, "stream-values")


def _alert(spark: SparkSession, sf: str, rule: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    calls = logs.alert_calls(rendered.call_lines(_log_stream(spark, sf)))
    return _appended(spark, rule(calls), name).withColumn("at", F.date_format("at", dates.TIME))


def stream_alert_slow(spark: SparkSession, sf: str) -> DataFrame:
    return _alert(spark, sf, rules.slow_calls, "stream-slow")


def stream_alert_error(spark: SparkSession, sf: str) -> DataFrame:
    return _alert(spark, sf, rules.error_calls, "stream-error")


def stream_queries() -> dict[str, Query]:
    out = {f"stream_archive_{n}": _archive(n) for n in (*archives.ARCHIVES, *archives.FACTORS)}
    out["stream_alert_warn"] = _counted("stream-warn", alerts.warn_stream, 3, "12 hours")
    out["stream_alert_traffic"] = _counted("stream-traffic", alerts.traffic_stream, "6 hours", 20, 2.0)
    return out | {f.__name__: f for f in (stream_append, stream_pass_through, stream_alert_slow, stream_alert_error)}
