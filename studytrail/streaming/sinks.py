"""Streaming sinks: append to files or tables, per-batch writers, Kafka, console."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

# Fixed value: length of a micro-batch.
EVERY = "10 seconds"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, on local disk and in the checkpoint, not on the heap."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def query_id(spark: SparkSession) -> str | None:
    """Inside ``each_batch``: the id that the stream's checkpoint keeps."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def trigger(writer: DataStreamWriter, every: str | None = EVERY) -> DataStreamWriter:
    """A micro-batch ``every`` so often, or (None) all that is there and then stop."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def append_files(rows: DataFrame, path: str, checkpoint: str, every: str | None = EVERY) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return trigger(writer, every).start(path)


def append_table(rows: DataFrame, table: str, checkpoint: str, every: str | None = EVERY) -> StreamingQuery:
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return trigger(writer, every).toTable(table)


def each_batch(
    rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = EVERY, mode: str = "append"
) -> StreamingQuery:
    """Hand every micro-batch and its number to ``write``.

    A number may come again after a failure: a ``write`` that overwrites then is exactly once, one that appends
    (``jdbc_writer``) at least once.
    """
    writer = rows.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return trigger(writer, every).start()


def persisted(*writes: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``write`` for ``each_batch`` that reads a micro-batch once for several writers."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for each in writes:
                each(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def jdbc_writer(url: str, table: str, **options: str) -> Callable[[DataFrame, int], None]:
    """A ``write`` for ``each_batch`` that inserts rows and their batch number (``batch_id``) through the JDBC data source.

    At least once: an insert cannot overwrite, so a batch that is repeated after a failure is inserted again. Readers
    keep one copy by ``batch_id`` and key, or the table's own unique key refuses the second one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        numbered.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()

    return write


def number_rows(batch: DataFrame, name: str = "no", start: int = 11) -> DataFrame:
    """Number the rows of each partition from ``start``; no rows move."""
    row_in_partition = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return batch.withColumn(name, row_in_partition + start)


def to_kafka(messages: DataFrame, servers: str, checkpoint: str, every: str | None = EVERY) -> StreamingQuery:
    """Send (topic, key, value). Needs Spark's Kafka connector on the class path."""
    writer = messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return trigger(writer.option("checkpointLocation", checkpoint), every).start()


def late_rows(progress: StreamingQueryProgress) -> int:
    """Rows of a micro-batch that came behind the watermark and were dropped, over all stateful operators."""
    return sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)


class LateRows(StreamingQueryListener):
    """Counts the dropped rows of every query by its id; add it with ``spark.streams.addListener``."""

    def __init__(self) -> None:
        self.counts: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.counts.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        key = str(event.progress.id)
        self.counts[key] = self.counts.get(key, 0) + late_rows(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def to_console(rows: DataFrame, every: str | None = EVERY) -> StreamingQuery:
    return trigger(rows.writeStream.outputMode("update").format("console"), every).start()
