"""Layout by hash bucket of a key, so that a few keys are found in a few folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Folders a task writes at once, at most.
WRITERS = 64
# Fixed for the life of a warehouse; take thousands where tables hold terabytes.
BUCKETS = 64


def number(key: str | Column, buckets: int) -> Column:
    """Bucket of a key; NULL has one as well."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def numbers(keys: DataFrame, buckets: int) -> list[int]:
    """Buckets of the first column of ``keys``: at most ``buckets`` numbers reach the driver."""
    found = keys.select(number(keys.columns[0], buckets).alias("bucket")).distinct()
    return sorted(r["bucket"] for r in found.collect())


def write(df: DataFrame, folder: str, *by: str) -> None:
    """A folder per value of ``by``, few files in each.

    Rebalancing cuts a bucket that holds a hot key into several tasks and files.
    Call it within ``session.unsorted_writes``: a task holds few buckets once tables are large.
    """
    df.hint("rebalance", *[F.col(c) for c in by]).write.partitionBy(*by).parquet(folder, compression="zstd")


def within(key: str | Column, only: Sequence[int], buckets: int) -> Column:
    return number(key, buckets).isin(list(only))
