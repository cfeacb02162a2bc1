"""Table scans: partitioned days, a catalogue of tables, the source/date layout, text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrail.functions.dates import previous_day


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_database_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")


def write_clustered(
    df: DataFrame, database: str, table: str, path: str, by: str = "account_id", buckets: int = 200, mode: str = "overwrite"
) -> None:
    """A catalog table in buckets of ``by``: whatever is grouped or ordered by that column needs no shuffle of its rows.

    One bucket is one task, so this is for columns none of whose values holds much of the table; others stay as they are and are spread by
    the operators themselves. Rows are dealt before they are written, so there is one file for each bucket.
    """
    writer = df.repartition(buckets, by).write.mode(mode).bucketBy(buckets, by).sortBy(by)
    writer.option("path", path).saveAsTable(f"{database}.{table}")


def of_previous_day(table: DataFrame, run_date: str, dt: str = "dt") -> DataFrame:
    """Rows of the day before ``run_date`` (yyyy-MM-dd); the literal predicate prunes partitions."""
    return table.where(F.col(dt).cast("string") == previous_day(F.lit(run_date).cast("date")))


def write_by_day(
    df: DataFrame, path: str, by: Sequence[str] = ("dt",), mode: str = "overwrite", gather: bool = True
) -> None:
    """Write one folder per value of ``by``.

    ``gather`` shuffles rows by folder first, so that not every task writes a small file into every folder;
    under AQE the rebalance splits a folder with many rows over several tasks and joins small ones. Without
    it nothing moves, which is better where each task sees few folders anyway, as when ingesting one day.
    """
    rows = df.hint("rebalance", *(F.col(c) for c in by)) if gather else df
    rows.write.mode(mode).partitionBy(*by).parquet(path)


def of_date(table: DataFrame, date: str, dt: str = "dt", sources: Sequence[str] | None = None) -> DataFrame:
    """Rows of one date from every source (or the named ones) of a ``source=…/dt=…`` layout."""
    rows = table.where(F.col(dt).cast("string") == date)
    return rows if sources is None else rows.where(F.col("source").isin(list(sources)))


def union_tables(frames: Mapping[str, DataFrame], label: str = "table") -> DataFrame:
    """Rows of several frames of one shape, labelled by their table."""
    labelled = [f.withColumn(label, F.lit(name)) for name, f in frames.items()]
    return reduce(DataFrame.unionByName, labelled)
