"""What the corpus operators share: reading documents, written intermediates, Arrow helpers."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_folder

#: Columns of a documents table; stages return exactly these, extra ones are dropped.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

#: Long texts make large batches; work on them and what comes of it is held for so many rows.
ROWS = 1000


def read(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the folder all executors share and read back: cuts lineage and survives lost executors."""
    target = work_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def held(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the folder, for what is not needed to the end."""
    target = work_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target), target


def discard(spark: SparkSession, folder: str) -> None:
    """Removes a folder that ``held`` has written; nothing that is still to run may read it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Arrow batches, ``ROWS`` rows at a time, through a function that ``make`` builds once in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                yield each(batch.slice(lo, ROWS))

    return df.mapInArrow(run, schema)


def per_worker(key: tuple, build: Callable):
    """What ``build`` returns, kept for later tasks of the same Python worker; it must bound its own size."""
    held = sys.modules.setdefault("tidemark_worker_state", types.ModuleType("tidemark_worker_state")).__dict__
    if key not in held:
        held[key] = build()
    return held[key]


def crc_bucket(column: str, modulus: int):
    """crc32 of the decimal text of an id, modulo ``modulus``; null ids count as text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, fold: int, hold_out: int, per_class: int, max_chars: int
):
    """Texts and labels of at most ``per_class`` rows of either label, as two lists on the driver.

    Rows whose crc32 fold is ``hold_out`` are never read for their label.  The
    rows with the smallest hash of their id are taken, so the sample does not
    depend on partitioning; a row longer than ``max_chars`` is no candidate,
    which bounds the sample to ``2 * per_class * max_chars`` characters.
    """
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (crc_bucket("doc_id", fold) != hold_out))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    near = docs.select("doc_id", F.char_length("text").alias("size")).where(f"size between 1 and {int(max_chars)}")
    near = known.join(near.groupBy("doc_id").agg(F.max("size").alias("size")), "doc_id")
    rows = []
    for value in (0, 1):
        picked = near.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        rows += [(r["doc_id"], r["label"]) for r in picked.select("doc_id", "label").collect()]
    if not rows:
        return [], []
    wanted = docs.sparkSession.createDataFrame(rows, "doc_id long, label int")
    # At most 2 * per_class ids travel: a proven bound.
    texts = docs.select("doc_id", "text").where(f"char_length(text) between 1 and {int(max_chars)}")
    found = texts.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    got = sorted((r["doc_id"], r["text"], r["label"]) for r in found.collect())
    return [t for _, t, _ in got], [y for *_, y in got]
