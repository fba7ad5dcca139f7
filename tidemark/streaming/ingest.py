"""Continuous landing of capture files with Structured Streaming.

The file source finds new files and its checkpoint remembers them; each
micro-batch lands its files through the ledger, so a batch that is run again
after a crash lands nothing twice.  Events may be arbitrarily late: order comes
from the change sequence when marts are rebuilt from raw, so there is no
watermark and no state that could expire, and no file is too old to be read.

The file source never offers empty files and names that begin with ``_`` or
``.``: each micro-batch lands such files from the listing, and ``ingest_all``
ends with whatever a listing holds beyond the ledger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.contract import DEFAULT_FORMAT, CaptureFormat
from tidemark.operators import joins
from tidemark.sources import capture
from tidemark.sources.warehouse import Warehouse

LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def stream_ingest(
    warehouse: Warehouse,
    capture_root: str,
    checkpoint: str,
    fmt: CaptureFormat = DEFAULT_FORMAT,
    strict: bool = True,
    max_files: int = 1000,
    after_batch: Callable[[Warehouse, int], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Land new capture files as they arrive; by default everything now, then stop.

    ``after_batch`` (for instance a mart build) runs before the micro-batch is
    checkpointed: when it fails, the batch is repeated, the ledger skips what
    has landed and the build runs again.  Pass ``trigger={"processingTime":
    "5 minutes"}`` to keep going.
    """
    spark = warehouse.spark
    files = (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        # The source would pass over files this much older than the newest one.
        .option("maxFileAge", "36500d")
        .load(capture_root)
        .select("path", "length")
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        waiting = joins.pending_files(batch, warehouse.ledger())
        names = [(r["path"], r["length"]) for r in waiting.collect()]  # at most max_files
        listed = capture.capture_manifest(spark, capture_root)
        passed = (F.col("size") == 0) | F.regexp_extract("path", "([^/]*)$", 1).rlike("^[_.]")
        # Each is offered once: a refused one is on record.
        missed = warehouse.unaccounted(listed.filter(passed)).orderBy("path").limit(max_files).collect()
        names += [(r["path"], r["size"]) for r in missed]
        if names:
            warehouse.land(names, capture_root, fmt, strict)
        if after_batch is not None:
            after_batch(warehouse, batch_id)

    writer = files.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def ingest_all(
    warehouse: Warehouse,
    capture_root: str,
    checkpoint: str,
    fmt: CaptureFormat = DEFAULT_FORMAT,
    strict: bool = True,
    **options,
) -> dict[str, int]:
    """Stream what is there, stop, and land what the listing holds beyond it.

    Afterwards every listed file is in the ledger or among the rejected ones;
    anything else is an error.
    """
    stream_ingest(warehouse, capture_root, checkpoint, fmt, strict, **options).awaitTermination()
    listed = capture.capture_manifest(warehouse.spark, capture_root)
    metrics: dict[str, int] = {}
    if not warehouse.unaccounted(listed).isEmpty():
        metrics = warehouse.land_pending(capture_root, fmt, strict)
    left = [r["path"] for r in warehouse.unaccounted(listed).select("path").limit(5).collect()]
    if left:
        raise RuntimeError(f"listed files were neither landed nor refused: {left}")
    return metrics
