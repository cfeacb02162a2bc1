"""Archives kept up to date from a stream; the state is Spark's own.

``transformWithState`` keeps the open visits of every account in the RocksDB state store, by groups of accounts (see ``visits``),
checkpointed with the stream. A micro-batch's additions, summed by archive and key, are the only thing that is written: one folder for each
batch, overwritten when a batch is repeated. The archive is the sum of all additions. Rows count in order of arrival, inside
a micro-batch in order of (time, seq).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from studytrail.operators import archives as ar
from studytrail.streaming.sinks import EVERY, each_batch, query_id, rocks_state
from studytrail.streaming.visits import (
    ABILITY, DAY_MS, DAY_PARTS, EXPIRED, GROUP, GROUPS, LONGS, PART, PARTS, Visits, added_schema, columns_of, open_schema,
)

FILES = 4


def keys_of(name: str) -> tuple[str, ...]:
    return ar.FACTORS[name] if name in ar.FACTORS else ar.ARCHIVES[name].keys


class ArchiveStream:
    """Keeps archives of one cadence (lifetime or daily) under ``root``, from one pass over the log.

    ``keep_days`` (daily archives): a day's timelines are forgotten when the latest event seen is so many days after the end of the
    day; ``expired`` counts them. Events after the time of the run do not move that clock. Rows that are more than so many
    days behind it are late and are dropped by Spark, which counts them in the query's progress. Without
    ``keep_days`` nothing is forgotten or dropped. The state belongs to the checkpoint under ``root``.
    """

    def __init__(self, root: str, names: Sequence[str] | str, keep_days: int | None = None):
        self.root, self.names, self.keep_days = root, (names,) if isinstance(names, str) else tuple(names), keep_days
        self.daily = "dt" in keys_of(self.names[0])
        if any(("dt" in keys_of(n)) != self.daily for n in self.names):
            raise ValueError("daily and lifetime archives need a stream each")
        self.keys = tuple(dict.fromkeys(k for n in self.names for k in keys_of(n)))
        self.added = f"{root}/added"

    def additions(self, events: DataFrame) -> DataFrame:
        """The stream of what each group of accounts adds: archive, keys, measures."""
        ends = [ar.ARCHIVES[n].end for n in self.names if n in ar.ARCHIVES and ar.ARCHIVES[n].end]
        rows = events.where(F.col("src_type").isin([ar.SUBMIT, *ends]))
        schema, expire = events.schema, self.daily and self.keep_days is not None
        account = F.xxhash64("account_id")
        parts = F.pmod(F.shiftright(account, 32), F.lit(DAY_PARTS if self.daily else PARTS))
        rows = rows.select(F.pmod(account, F.lit(GROUPS)).cast("int").alias(GROUP), parts.cast("int").alias(PART), *columns_of(self.names, self.keys))
        if expire:
            at = F.least(F.timestamp_seconds("epoch_s"), F.current_timestamp())
            day_end = (F.unix_date(F.to_date("dt", "yyyyMMdd")).cast("bigint") + 1) * F.lit(DAY_MS)
            rows = rows.withColumns({"_at": at, "_day_end": day_end}).withWatermark("_at", f"{self.keep_days} days")
        processor = Visits(self.names, self.keys, open_schema(schema), expire)
        return rows.groupBy(GROUP).transformWithState(
            processor, added_schema(schema, self.keys), "Append", "EventTime" if expire else "None"
        )

    def write(self, added: DataFrame, batch_id: int) -> None:
        """Sum up what a micro-batch adds and write it in the batch's own place."""
        sums = [F.sum(m).alias(m) for m in (*LONGS, EXPIRED, ABILITY)]
        total = added.groupBy("archive", *self.keys).agg(*sums)
        place = f"{self.added}/query={query_id(added.sparkSession)}/batch={batch_id}"
        total.repartition(FILES).write.mode("overwrite").parquet(place)

    def start(self, events: DataFrame, every: str | None = EVERY) -> StreamingQuery:
        with rocks_state(events.sparkSession):
            return each_batch(self.additions(events), self.write, f"{self.root}/checkpoint", every)

    def rows(self, spark: SparkSession) -> DataFrame:
        """All additions so far."""
        return spark.read.option("basePath", self.added).parquet(f"{self.added}/query=*/batch=*").drop("query", "batch")

    def read(self, spark: SparkSession, name: str | None = None) -> DataFrame:
        """One archive as of the last completed batch; before the first, there is none to read."""
        name = name or self.names[0]
        rows = self.rows(spark).where(F.col("archive") == name)
        if name in ar.FACTORS:
            return ar.factor_ability(rows.groupBy(*ar.FACTORS[name]).agg(*(F.sum(m).alias(m) for m in ("triggers", *ar.COUNTERS))))
        spec = ar.ARCHIVES[name]
        return ar.finish(ar.add_up(rows, spec), spec)

    def expired(self, spark: SparkSession) -> int:
        return self.rows(spark).agg(F.sum(EXPIRED)).first()[0] or 0
