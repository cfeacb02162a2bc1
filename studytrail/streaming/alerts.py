"""Alert rules on a stream: alerts end in a table, delivery is the caller's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from studytrail.operators import alerts
from studytrail.streaming.sinks import EVERY, each_batch, query_id, rocks_state

TOTAL = "_total"
FILES = 4


def call_alerts(calls: DataFrame, above_ms: int = 1000, every: str = "10 minutes") -> DataFrame:
    """Slow and failed calls, at most one alert per rule and url within ``every``."""
    calls = instants(calls)
    found = alerts.slow_calls(calls, above_ms).unionByName(alerts.error_calls(calls))
    return alerts.limit_rate_stream(found, every)


def instants(calls: DataFrame) -> DataFrame:
    """Watermarks need instants: local times are taken in the session's time zone."""
    return calls.withColumn("ts", F.col("ts").cast("timestamp"))


class CountedAlerts:
    """A rule over counts: Spark's streaming aggregation holds the counts, the alerts are those of all counts so far.

    A micro-batch writes the new totals of the keys it touched, in a place of its own that a repeated batch overwrites. Totals only
    grow, so the highest is the latest. Nothing is dropped for being late: a late call adds to its own moment, and the
    alert of its url and stretch is replaced by the next ``read``. So an alert is there as soon as the batch that
    completes it, and the end of the stream needs no further rows.

    ``send`` is handed the alerts that a batch added or changed. Only keys that ``near`` finds around the batch's own are read
    and looked at for that: the rule cannot change anywhere else.
    """

    def __init__(
        self,
        root: str,
        count: Callable[[DataFrame], DataFrame],
        keys: tuple[str, ...],
        finish: Callable[[DataFrame], DataFrame],
        near: Callable[[DataFrame, DataFrame], DataFrame],
        send: Callable[[DataFrame, int], None] | None = None,
    ):
        self.root, self.count, self.keys, self.finish, self.near, self.send = root, count, keys, finish, near, send
        self.counts = f"{root}/counts"

    def _place(self, query: str | None, batch_id: int) -> str:
        return f"{self.counts}/query={query}/batch={batch_id}"

    def write(self, totals: DataFrame, batch_id: int) -> None:
        spark = totals.sparkSession
        place = self._place(query_id(spark), batch_id)
        # Coalescing would work off several partitions of the state in one task, which holds the memory of all of them to its end.
        totals.select(*self.keys, F.col("n").alias(TOTAL)).repartition(FILES).write.mode("overwrite").parquet(place)
        if self.send:
            touched = spark.read.parquet(place)
            self.send(self._changed(spark, touched, batch_id), batch_id)

    def _changed(self, spark: SparkSession, touched: DataFrame, batch_id: int) -> DataFrame:
        """Alerts around the touched keys that were not there before this batch."""
        rows = self._rows(spark)
        earlier = (F.col("query") != F.lit(query_id(spark))) | (F.col("batch") < batch_id)
        now, before = (self.finish(self.near(self._latest(r), touched)) for r in (rows, rows.where(earlier)))
        return now.exceptAll(before)

    def _rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", self.counts).parquet(f"{self.counts}/query=*/batch=*")

    def _latest(self, rows: DataFrame) -> DataFrame:
        """Counts by key: the highest total of each checkpoint's stream, added up."""
        totals = rows.groupBy("query", *self.keys).agg(F.max(TOTAL).alias("n"))
        return totals.groupBy(*self.keys).agg(F.sum("n").alias("n"))

    def start(self, calls: DataFrame, every: str | None = EVERY) -> StreamingQuery:
        with rocks_state(calls.sparkSession):
            return each_batch(self.count(calls), self.write, f"{self.root}/checkpoint", every, "update")

    def read(self, spark: SparkSession) -> DataFrame:
        return self.finish(self._latest(self._rows(spark)))


def _near_moments(within: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Counts of the touched urls' stretches: a burst reaches one stretch of ``within`` back, an alert one on."""

    def near(counts: DataFrame, touched: DataFrame) -> DataFrame:
        span = F.expr(f"interval {within}")
        own = F.window("ts", within)["start"].cast(counts.schema["ts"].dataType)
        around = F.explode(F.array(*(own + span * i for i in (-2, -1, 0, 1, 2))))
        stretches = touched.select(F.col("url"), around.alias("_near")).distinct()
        return counts.withColumn("_near", own).join(stretches, ["url", "_near"], "left_semi").drop("_near")

    return near


def _near_windows(within: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Counts of the touched windows, and of those before and after: ranks need all urls of a window."""

    def near(counts: DataFrame, touched: DataFrame) -> DataFrame:
        span = F.expr(f"interval {within}")
        around = F.explode(F.array(*(F.col("start") + span * i for i in (-1, 0, 1))))
        return counts.join(touched.select(around.alias("start")).distinct(), "start", "left_semi")

    return near


def warn_stream(root: str, times: int = 3, within: str = "1 minute", **options) -> CountedAlerts:
    return CountedAlerts(root, alerts.warn_counts, ("url", "ts"), lambda c: alerts.bursts_of(c, times, within), _near_moments(within), **options)


def traffic_stream(root: str, within: str = "5 minutes", top: int = 20, factor: float = 2.0, **options) -> CountedAlerts:
    return CountedAlerts(
        root, lambda calls: alerts.call_counts(calls, within), ("url", "start"), lambda c: alerts.jumps_of(c, within, top, factor),
        _near_windows(within), **options,
    )
