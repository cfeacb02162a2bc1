"""Shared tables, Bloom filters as rows of bitmaps, and joins that keep hot groups apart. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrail.session import shared_folder

BLOCK = 1 << 15  # bits of one bitmap
MAX_BLOCKS = 1 << 14  # 64 MB of bitmaps
HOT_GROUPS = 1000


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: what follows never repeats its work."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """A folder for the tables of one run in the shared folder; leaving the ``with`` block removes it.

    What is read after the block must have been stored elsewhere.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.n = spark, shared_folder(spark, "scratch"), 0

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns and the whole row as ``row``, so that no helper column can clash with one of the frame's."""
    return df.select(*columns, F.struct("*").alias("row"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def blocks_for(rows: int) -> int:
    """Bitmaps for so many keys at 32 bits a key: a power of two, MAX_BLOCKS at most."""
    need = max(1, 32 * rows // BLOCK)
    return min(MAX_BLOCKS, 1 << (need - 1).bit_length())


def _places(key: str, blocks: int) -> tuple[Column, Column, Column]:
    h = F.xxhash64(key)
    place = lambda by: F.pmod(F.shiftright(h, by), F.lit(BLOCK)).cast("int")
    return F.pmod(h, F.lit(blocks)).cast("int"), place(16), place(40)


def filter_of(keys: DataFrame, key: str, blocks: int, times: int = 1) -> DataFrame:
    """A Bloom filter of the keys as rows (block, bits), ``blocks`` rows of 4 KB at most.

    A bit counts as set if ``times`` keys or more fall on it: with 2 the filter holds the keys that may be repeated.
    """
    block, one, two = _places(key, blocks)
    bits = keys.select(block.alias("block"), F.explode(F.array_distinct(F.array(one, two))).alias("bit"))
    counts = bits.groupBy("block", "bit").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= times).groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("bigint")).alias("bits"))


def maybe(df: DataFrame, key: str, bits: DataFrame, blocks: int, name: str = "maybe") -> DataFrame:
    """Adds a boolean that is false only for keys outside the filter. The filter's rows are broadcast: 64 MB at most."""
    block, one, two = _places(key, blocks)
    bits = bits.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))

    def is_set(place: Column) -> Column:
        byte = F.substring(F.col("_bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        return F.getbit(value, place % 8) == 1

    out = df.join(F.broadcast(bits), block == F.col("_block"), "left")
    return out.withColumn(name, F.coalesce(is_set(one) & is_set(two), F.lit(False))).drop("_block", "_bits")


def among(df: DataFrame, key: str, wanted: DataFrame, store=stored) -> DataFrame:
    """Adds ``maybe`` by a stored filter of the wanted rows' keys."""
    blocks = blocks_for(wanted.count())
    return maybe(df, key, store(filter_of(wanted, key, blocks), "bits"), blocks)


def with_group(rows: DataFrame, groups: DataFrame, key: str, row_id: str, total: int) -> DataFrame:
    """Left join of rows with their groups (key, n, other columns), also where one group holds much of the rows.

    Groups of more than ``max(1000, total / 1000)`` rows are 1,000 at most and are broadcast; their rows get a key
    of their own in the shuffled join of the rest, so that they are spread and match nothing. Keys are strings.
    """
    limit = max(HOT_GROUPS, total // HOT_GROUPS)
    names = [c for c in groups.columns if c != key]
    hot = groups.where(F.col("n") > limit).select(F.col(key).alias("_hot"), F.struct(*names).alias("_h"))
    cold = groups.where(F.col("n") <= limit).select(F.col(key).alias("_cold"), F.struct(*names).alias("_c"))
    apart = F.when(F.col("_hot").isNull(), F.col(key)).otherwise(
        F.concat(F.lit("hot "), F.coalesce(F.col(row_id).cast("string"), F.lit("")))
    )
    out = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_key", apart)
    out = out.join(cold, F.col("_key") == F.col("_cold"), "left")
    return out.select(*rows.columns, *(F.coalesce(F.col(f"_h.{c}"), F.col(f"_c.{c}")).alias(c) for c in names))
