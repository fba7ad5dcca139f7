"""Batch gate and completion marker: skip idle runs, retry failed ones."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import compare
from tidemark.sources import capture
from tidemark.sources.warehouse import Warehouse, path_exists

MANIFEST = "path string, size bigint, modified timestamp, target string"


class BatchGate:
    """Compares the capture listing with the last completed batch.

    ``prepare`` stores the listing of a run; ``complete`` acknowledges exactly
    that listing, so files that arrive meanwhile are picked up next time.
    Landing files does not acknowledge a batch; only ``complete`` does.
    """

    def __init__(self, warehouse: Warehouse, capture_root: str):
        self.warehouse = warehouse
        self.spark = warehouse.spark
        self.capture_root = capture_root

    def _pending(self, run_id: str) -> str:
        # A run id is data, never a path.
        digest = hashlib.sha256(run_id.encode()).hexdigest()
        return self.warehouse.folder(f"control/pending/{digest}")

    def _markers(self) -> str:
        return self.warehouse.folder("control/completed")

    def manifest(self) -> DataFrame:
        listed = capture.require_files(capture.capture_manifest(self.spark, self.capture_root))
        return listed.withColumn("target", F.lit(f"{self.capture_root}->{self.warehouse.root}"))

    def completed(self) -> DataFrame | None:
        if not path_exists(self.spark, self._markers()):
            return None
        markers = self.spark.read.schema("pending string, sequence bigint").parquet(self._markers())
        last = markers.orderBy(F.desc("sequence")).first()
        return self.spark.read.schema(MANIFEST).parquet(last["pending"])

    def prepare(self, run_id: str) -> bool:
        """False when nothing changed since the last completed batch."""
        current = self.manifest()
        done = self.completed()
        if done is not None and compare.same_content(current, done).first()["equal"]:
            return False
        current.write.mode("overwrite").parquet(self._pending(run_id))
        return True

    def complete(self, run_id: str) -> None:
        pending = self._pending(run_id)
        if not path_exists(self.spark, pending):
            raise FileNotFoundError(f"run {run_id!r} was not prepared")
        last = 0
        if path_exists(self.spark, self._markers()):
            markers = self.spark.read.schema("pending string, sequence bigint").parquet(self._markers())
            last = markers.agg(F.max("sequence")).first()[0]
        row = self.spark.createDataFrame([(pending, last + 1)], "pending string, sequence bigint")
        row.coalesce(1).write.mode("append").parquet(self._markers())


def run_batch(
    warehouse: Warehouse, capture_root: str, run_id: str, build, fmt=capture.DEFAULT_FORMAT
) -> dict[str, int] | None:
    """prepare, land, build, complete; None when there was nothing to do.

    ``build(warehouse)`` raises to keep the batch open: raw stays landed and the
    next run builds again.
    """
    gate = BatchGate(warehouse, capture_root)
    if not gate.prepare(run_id):
        return None
    metrics = warehouse.land_pending(capture_root, fmt)
    build(warehouse)
    gate.complete(run_id)
    return metrics
