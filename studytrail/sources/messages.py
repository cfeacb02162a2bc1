"""Message streams: Kafka in production, files of the same shape elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
# Fixed value: bytes fetched per partition and request.
FETCH_BYTES = 50_000_000


def kafka_options(
    servers: str, topics: str, starting: str = "earliest", max_per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": starting,
        "kafka.max.partition.fetch.bytes": str(FETCH_BYTES),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: str, topics: str, **options) -> DataFrame:
    """Messages of Kafka topics with key and value as text. Needs Spark's Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **options)).load()
    text = {c: F.col(c).cast("string") for c in ("key", "value")}
    return raw.withColumns(text).select(*MESSAGE.names)


def file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Messages kept as parquet files, oldest file first."""
    return table_stream(spark, path, MESSAGE, files_per_trigger)


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
