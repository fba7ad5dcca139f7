"""Distinct counts as mergeable sketches, kept beside the loads.

Each load leaves one HyperLogLog sketch per table of its event ids and of the
people it names, 16 KB at most.  A report merges them without reading raw; the
exact counts stay in ``profiles``.  A load is sketched once: ``refresh`` reads
only loads that have none yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.sources.warehouse import Warehouse, path_exists

SCHEMA = "load_id string, source_table string, event_sketch binary, people_sketch binary"
_STORED = "_event_id string, customer_unique_id string, load_id string, source_table string"
# 2^14 registers: a standard error of 0.8 %.
REGISTERS_LOG2 = 14
STANDARD_ERROR = 1.04 / 2 ** (REGISTERS_LOG2 / 2)


def kept(warehouse: Warehouse) -> DataFrame:
    """Sketches of committed loads: a row per load and table."""
    folder = warehouse.folder("sketches")
    if not path_exists(warehouse.spark, folder):
        return warehouse.spark.createDataFrame([], SCHEMA)
    return warehouse.spark.read.schema(SCHEMA).parquet(folder).join(warehouse.loads(), "load_id", "left_semi")


def refresh(warehouse: Warehouse) -> int:
    """Sketch the loads that have no sketch yet; returns how many there were."""
    done = kept(warehouse).select("load_id").distinct()
    waiting = warehouse.loads().join(done, "load_id", "left_anti")
    number = waiting.count()
    if number:
        raw = warehouse.spark.read.schema(_STORED).parquet(warehouse.folder("raw"))
        own = raw.where(F.col("source_table").isin(*contract.TABLES))
        # A row of some 40 bytes per load, as in Warehouse.raw; it prunes the other loads' folders.
        own = own.join(F.broadcast(waiting), "load_id", "left_semi")
        made = own.groupBy("load_id", "source_table").agg(
            F.hll_sketch_agg("_event_id", REGISTERS_LOG2).alias("event_sketch"),
            F.hll_sketch_agg("customer_unique_id", REGISTERS_LOG2).alias("people_sketch"),
        )
        made.write.mode("append").parquet(warehouse.folder("sketches"))
    return number


def estimates(warehouse: Warehouse) -> DataFrame:
    """``source_table, unique_events, people``, estimated from the kept sketches alone."""
    merged = kept(warehouse).groupBy("source_table").agg(
        F.hll_union_agg("event_sketch").alias("_events"), F.hll_union_agg("people_sketch").alias("_people")
    )
    return merged.select(
        "source_table",
        F.hll_sketch_estimate("_events").alias("unique_events"),
        F.hll_sketch_estimate("_people").alias("people"),
    )
