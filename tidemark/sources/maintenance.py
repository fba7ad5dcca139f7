"""Compaction of loads, and removal of what no reader can reach: crashed, refused or moved loads, replaced mart versions."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tidemark import contract
from tidemark.plans import publish
from tidemark.session import small_splits, unsorted_writes
from tidemark.sources import buckets
from tidemark.sources.warehouse import MOVES, Warehouse, children


def _children(warehouse: Warehouse, folder: str) -> list[str]:
    return children(warehouse.spark, warehouse.folder(folder))


def _drop(warehouse: Warehouse, folder: str) -> None:
    jvm = warehouse.spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(warehouse.folder(folder))
    path.getFileSystem(warehouse.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def compact(warehouse: Warehouse, loads: Sequence[str] | None = None) -> str | None:
    """Rewrite loads as one, laid out by buckets of the primary key; by default those not yet compacted.

    The copy is invisible until the rows that name it are appended, as one
    file; from then on readers pass over the old places.  A crash before leaves
    the loads where they were, and the unnamed copy to ``vacuum``.  Events keep
    the load that delivered them.  Returns the copy's id, None if nothing was left.
    """
    spark, moves, known = warehouse.spark, warehouse.moves(), warehouse.loads()
    if moves is not None and not moves.where(F.col("buckets") != warehouse.buckets).isEmpty():
        raise ValueError(f"this warehouse is not laid out in {warehouse.buckets} buckets")
    if loads is not None:
        known = known.where(F.col("load_id").isin(list(loads)))
    elif moves is not None:
        known = known.join(moves, "load_id", "left_anti")
    names = sorted(r["load_id"] for r in known.collect())  # a short row each
    if not names:
        return None
    chosen = spark.createDataFrame([(n,) for n in names], "load_id string")
    into = uuid.uuid4().hex

    def lay(table: str) -> None:
        # A table's own columns alone are dealt out: rows as wide as all tables would be mostly NULL.
        bucket = buckets.number(contract.primary_key(table), warehouse.buckets)
        events = warehouse.events(chosen, table).withColumnRenamed("load_id", "landed_by").withColumn("bucket", bucket)
        buckets.write(events.drop("source_table"), warehouse.folder(f"laid/load_id={into}/source_table={table}"), "bucket")

    with unsorted_writes(spark, buckets.WRITERS), small_splits(spark), ThreadPoolExecutor(len(contract.TABLES)) as pool:
        list(pool.map(lay, contract.TABLES))
    last = 0
    if moves is not None:
        last = spark.read.schema(MOVES).parquet(warehouse.folder("moves")).agg(F.max("sequence")).first()[0]
    rows = spark.createDataFrame([(n, into, last + 1, warehouse.buckets) for n in names], MOVES)
    rows.coalesce(1).write.mode("append").parquet(warehouse.folder("moves"))
    return into


def vacuum(warehouse: Warehouse) -> dict[str, int]:
    """Delete loads that no ledger row names or that have moved, and mart versions without a current bucket.

    Call it while nothing else writes.  A query that still reads a replaced
    version or an old place fails afterwards: leave it the time it needs.
    """
    moves = warehouse.moves()
    moved = {} if moves is None else {r["load_id"]: r["into"] for r in moves.collect()}
    loads = {r["load_id"] for r in warehouse.loads().collect()}
    kept = {"raw": loads - set(moved), "laid": {moved[i] for i in loads if i in moved}}
    dropped = {"loads": 0, "versions": 0}
    for place, names in kept.items():
        for name in _children(warehouse, place):
            if name.startswith("load_id=") and name.removeprefix("load_id=") not in names:
                _drop(warehouse, f"{place}/{name}")
                dropped["loads"] += 1
    published = publish.current(warehouse)
    for mart in contract.MARTS:
        for name in _children(warehouse, f"marts/{mart}"):
            if name.startswith("version=") and mart in published and name.removeprefix("version=") not in published[mart].in_use():
                _drop(warehouse, f"marts/{mart}/{name}")
                dropped["versions"] += 1
    return dropped
