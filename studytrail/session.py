"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(name: str, cores: str = "8", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one the cluster names in ``spark.checkpoint.dir``.

    Only where the setting is absent (tests on one machine) a temporary folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # not local-cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = os.path.join(tempfile.gettempdir(), "studytrail")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


BATCH = 4 << 20  # bytes
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches to Python of BATCH bytes at most, a row at least; a smaller limit of the session stays.

    Batches are else bounded by 10,000 rows, which of long texts take tens of MB in each task, on both sides.
    """
    if not 0 < _bytes(spark.conf.get(BATCH_LIMIT)) <= BATCH:
        spark.conf.set(BATCH_LIMIT, str(BATCH))


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")
