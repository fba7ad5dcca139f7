"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a cluster job wants as well as a local one.  Shuffle partitions are
# left to the caller: AQE coalesces small ones, so set it high on a cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Landing writes five folders per task; open writers spare it a sort.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = (
        configure(builder)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def unsorted_writes(spark: SparkSession, writers: int):
    """Writes into up to ``writers`` folders at once: no task sorts, and spills, its rows by folder first.

    A task that meets more folders sorts the rest.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    return settings(spark, {name: str(max(writers, int(spark.conf.get(name, "0"))))})


# Bytes of Parquet that a task reads before a sort: some 20 bytes an event, 300 or more once read.
SORTED_BYTES = 1 << 24


def small_splits(spark: SparkSession):
    """Reads in tasks whose rows can be sorted in memory.

    Ranks sort each map task's rows before their shuffle.  A split of the usual
    128 MB holds millions of rows of well compressed events, whose sort spills.
    """
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return settings(spark, {"spark.sql.files.maxPartitionBytes": str(min(most, SORTED_BYTES))})


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names the shared place in ``spark.checkpoint.dir``.  Only a
    local session may fall back to a temporary folder on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
