"""Alert rules over a call log with ``ts``, ``level``, ``use_time`` (ms) and ``url``.

Every rule gives (rule, url, at, amount), so that rules can be unioned and rate-limited together.
Slow and failed calls also take a streaming frame; bursts and jumps on a stream come from counts that add up over
micro-batches (``streaming.alerts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _alert(rule: str, at: Column, amount: Column) -> list[Column]:
    return [F.lit(rule).alias("rule"), F.col("url"), at.alias("at"), amount.cast("bigint").alias("amount")]


def slow_calls(calls: DataFrame, above_ms: int = 1000) -> DataFrame:
    return calls.where(F.col("use_time") > above_ms).select(*_alert("slow", F.col("ts"), F.col("use_time")))


def error_calls(calls: DataFrame) -> DataFrame:
    return calls.where(F.col("level") == "error").select(*_alert("error", F.col("ts"), F.lit(1)))


def warn_counts(calls: DataFrame) -> DataFrame:
    """(url, ts, n): warnings of each moment; these add up over batches."""
    return calls.where(F.col("level") == "warn").groupBy("url", "ts").agg(F.count(F.lit(1)).alias("n"))


def bursts_of(counts: DataFrame, times: int = 3, within: str = "1 minute") -> DataFrame:
    """One alert per url and stretch of ``within`` in which the ``times``-th warning within any ``within`` came.

    ``at`` is when it came, ``amount`` the most warnings within ``within``. A moment is looked at together with the
    stretch before its own, so that borders hide nothing and no window holds more than two stretches of one url.
    """
    span = F.expr(f"interval {within}")
    own = F.window("ts", within)["start"].cast(counts.schema["ts"].dataType)
    rows = counts.withColumn("_own", own).withColumn("_stretch", F.explode(F.array(F.col("_own"), F.col("_own") + span)))
    so_far = F.expr(f"sum(n) OVER (PARTITION BY url, _stretch ORDER BY ts RANGE BETWEEN INTERVAL {within} PRECEDING AND CURRENT ROW)")
    rows = rows.withColumn("_sum", so_far).where((F.col("_stretch") == F.col("_own")) & (F.col("_sum") >= times))
    return rows.groupBy("url", "_own").agg(F.min("ts").alias("_at"), F.max("_sum").alias("_most")).select(*_alert("warn", F.col("_at"), F.col("_most")))


def warn_bursts(calls: DataFrame, times: int = 3, within: str = "1 minute") -> DataFrame:
    """Alerts where one url warned ``times`` times within any ``within`` (see ``bursts_of``)."""
    return bursts_of(warn_counts(calls), times, within)


def call_counts(calls: DataFrame, within: str = "5 minutes") -> DataFrame:
    """(url, start, n): calls of each window; these add up over batches."""
    return calls.groupBy("url", F.window("ts", within)["start"].alias("start")).agg(F.count(F.lit(1)).alias("n"))


def jumps_of(counts: DataFrame, within: str = "5 minutes", top: int = 20, factor: float = 2.0) -> DataFrame:
    """Of each window's ``top`` urls, those called more than ``factor`` times as often as in the window before.

    The rank limit applies before the shuffle, and the window before is one row per url.
    """
    by_url = Window.partitionBy("url").orderBy("start")
    before = F.when(F.lag("start").over(by_url) + F.expr(f"interval {within}") == F.col("start"), F.lag("n").over(by_url))
    busiest = Window.partitionBy("start").orderBy(F.desc("n"), "url")
    return (
        counts.withColumn("before", F.coalesce(before, F.lit(0)))
        .withColumn("rank", F.row_number().over(busiest))
        .where((F.col("rank") <= top) & (F.col("n") > F.col("before") * F.lit(factor)))
        .select(*_alert("traffic", F.col("start"), F.col("n")))
    )


def traffic_jumps(calls: DataFrame, within: str = "5 minutes", top: int = 20, factor: float = 2.0) -> DataFrame:
    """Calls are counted per window and url before anything is ranked (see ``jumps_of``)."""
    return jumps_of(call_counts(calls, within), within, top, factor)


def limit_rate(alerts: DataFrame, every: str = "10 minutes", by: Sequence[str] = ("rule", "url")) -> DataFrame:
    """The first alert per rule and url in each interval; how many there were is kept as ``suppressed``."""
    return (
        alerts.groupBy(F.window("at", every), *by)
        .agg(
            F.min("at").alias("at"),
            F.min_by("amount", F.struct("at", "amount")).alias("amount"),
            (F.count("*") - 1).alias("suppressed"),
        )
        .drop("window")
    )


def limit_rate_stream(alerts: DataFrame, every: str = "10 minutes", by: Sequence[str] = ("rule", "url")) -> DataFrame:
    """Streaming form of ``limit_rate``: the first alert to arrive in each interval passes at once.

    What has passed is remembered until the watermark, ``every`` behind, leaves its interval. Alerts behind it are dropped; the
    query's progress counts them (``streaming.sinks.LateRows``).
    """
    return (
        alerts.withWatermark("at", every)
        .withColumn("_interval", F.window("at", every)["start"])
        .dropDuplicatesWithinWatermark([*by, "_interval"])
        .drop("_interval")
    )
