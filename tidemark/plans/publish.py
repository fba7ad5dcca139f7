"""Publishing marts: new folder per version, then one pointer record.

Readers follow the newest pointer, so a failed build leaves the old tables in
place, and all tables of one publication switch together.  Marts are laid out
by hash buckets of a key, and pointers name a version for each bucket: an update
writes the buckets it touches and leaves the others to the versions that hold
them.  A publication also
records the loads it adds to the full build it rests on, so that an update can
tell what the published marts lack.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import unsorted_writes
from tidemark.sources import buckets
from tidemark.sources.warehouse import Warehouse, children, path_exists

# A row per bucket; bucket -1 stands for the publication of the mart itself and carries its schema.
POINTERS = (
    "mart string, version string, sequence bigint, published_at timestamp, base string,"
    " bucket int, filled boolean, whole boolean, buckets int, schema string"
)
ITSELF = -1
# What the rows of a mart are laid out by.  Details go with their order, so that
# totals and references of an order stay in buckets of one number.
KEYS = {
    "dim_customers": "customer_id",
    "dim_customer_history": "customer_id",
    "fct_orders": "order_id",
    "fct_order_items": "order_id",
    "fct_order_payments": "order_id",
}
CONTENTS = "version string, load_id string"


def _pointers(warehouse: Warehouse) -> DataFrame:
    folder = warehouse.folder("publications")
    if not path_exists(warehouse.spark, folder):
        return warehouse.spark.createDataFrame([], POINTERS)
    return warehouse.spark.read.schema(POINTERS).parquet(folder)


def current_versions(warehouse: Warehouse) -> dict[str, str]:
    """Newest published version per mart: one short row each."""
    newest = _pointers(warehouse).groupBy("mart").agg(F.max_by("version", "sequence").alias("version"))
    return {r["mart"]: r["version"] for r in newest.collect()}


@dataclass(frozen=True)
class Published:
    """Where the current rows of a mart are."""

    buckets: int
    schema: T.StructType
    versions: dict[int, str]

    def in_use(self) -> set[str]:
        return set(self.versions.values())


def current(warehouse: Warehouse) -> dict[str, Published]:
    """Version of each filled bucket per mart: a short row for each bucket."""
    pointers = _pointers(warehouse)
    since = pointers.where("whole").groupBy("mart").agg(F.max("sequence").alias("_since"))
    live = pointers.join(since, "mart").where("sequence >= _since")
    newest = live.groupBy("mart", "bucket").agg(
        F.max_by(F.struct("version", "filled", "buckets", "schema"), "sequence").alias("_p")
    )
    rows = newest.select("mart", "bucket", "_p.*").collect()
    found = {}
    for own in (r for r in rows if r["bucket"] == ITSELF):
        versions = {r["bucket"]: r["version"] for r in rows if r["mart"] == own["mart"] and r["filled"]}
        schema = T.StructType.fromJson(json.loads(own["schema"]))
        found[own["mart"]] = Published(own["buckets"], schema, versions)
    return found


def _folder(warehouse: Warehouse, mart: str, version: str) -> str:
    return warehouse.folder(f"marts/{mart}/version={version}")


def new_version() -> str:
    return uuid.uuid4().hex


def write_version(warehouse: Warehouse, marts: Mapping[str, DataFrame], version: str) -> dict[str, DataFrame]:
    """Write marts under a version that nobody reads yet, and read them back.

    The writes are independent jobs; submitting them together lets one fill the
    executors that another's last tasks leave idle.
    """

    def write(item: tuple[str, DataFrame]) -> DataFrame:
        name, df = item
        folder = _folder(warehouse, name, version)
        laid = df.withColumn("bucket", buckets.number(KEYS.get(name, df.columns[0]), warehouse.buckets))
        buckets.write(laid, folder, "bucket")
        stored = T.StructType([*df.schema.fields, T.StructField("bucket", T.IntegerType())])
        return warehouse.spark.read.schema(stored).parquet(folder).select(*df.columns)

    with unsorted_writes(warehouse.spark, buckets.WRITERS), ThreadPoolExecutor(len(marts)) as pool:
        return dict(zip(marts, pool.map(write, marts.items())))


def contained(warehouse: Warehouse) -> DataFrame | None:
    """``load_id`` of every load in the published marts; None where the newest publication does not say."""
    pointers = _pointers(warehouse)
    newest = pointers.orderBy(F.desc("sequence")).select("base").first()
    if newest is None or newest["base"] is None:
        return None
    # Attempts that never got a pointer do not count, whatever they have written.
    published = pointers.where(F.col("base") == newest["base"]).select("version").distinct()
    contents = warehouse.spark.read.schema(CONTENTS).parquet(warehouse.folder("publication_loads"))
    return contents.join(published, "version", "left_semi").select("load_id").distinct()


def _base(warehouse: Warehouse) -> str | None:
    newest = _pointers(warehouse).orderBy(F.desc("sequence")).select("base").first()
    return newest["base"] if newest else None


def point_to(
    warehouse: Warehouse,
    written: Mapping[str, DataFrame],
    version: str,
    loads: DataFrame | None = None,
    touched: Mapping[str, Sequence[int]] | None = None,
) -> None:
    """Make ``version`` current for the marts in ``written``: one appended file, all or nothing.

    ``touched`` names the buckets that an update replaces; without it the
    version replaces all.  ``loads`` are those that this publication adds: all
    of them for a full build.  They are written first, and count once the
    pointer exists.
    """
    spark: SparkSession = warehouse.spark
    whole = touched is None
    base = None if loads is None else version if whole else _base(warehouse)
    if loads is not None:
        named = loads.select(F.lit(version).alias("version"), "load_id")
        named.coalesce(1).write.mode("append").parquet(warehouse.folder("publication_loads"))
    last = _pointers(warehouse).agg(F.max("sequence").alias("s")).first()["s"] or 0
    rows = []
    for mart, df in written.items():
        names = children(spark, _folder(warehouse, mart, version))
        filled = {int(n.removeprefix("bucket=")) for n in names if n.startswith("bucket=")}
        rows.append((mart, version, last + 1, ITSELF, False, whole, warehouse.buckets, df.schema.json()))
        for bucket in sorted(filled if whole else touched[mart]):
            rows.append((mart, version, last + 1, bucket, bucket in filled, False, None, None))
    schema = "mart string, version string, sequence bigint, bucket int, filled boolean, whole boolean, buckets int, schema string"
    pointers = spark.createDataFrame(rows, schema)
    pointers = pointers.withColumn("published_at", F.current_timestamp()).withColumn("base", F.lit(base).cast("string"))
    pointers.coalesce(1).write.mode("append").parquet(warehouse.folder("publications"))


def publish(warehouse: Warehouse, marts: Mapping[str, DataFrame]) -> str:
    version = new_version()
    point_to(warehouse, write_version(warehouse, marts, version), version)
    return version


def read_buckets(warehouse: Warehouse, name: str, at: Published, only: Sequence[int] | None = None) -> DataFrame:
    """Rows of a mart, or of its buckets with these numbers; no folder of another bucket is listed."""
    chosen = {b: v for b, v in at.versions.items() if only is None or b in set(only)}
    if not chosen:
        return warehouse.spark.createDataFrame([], at.schema)
    paths = [f"{_folder(warehouse, name, v)}/bucket={b}" for b, v in sorted(chosen.items())]
    return warehouse.spark.read.schema(at.schema).parquet(*paths)


def read_mart(warehouse: Warehouse, name: str) -> DataFrame:
    at = current(warehouse).get(name)
    if at is None:
        raise LookupError(f"{name} has not been published")
    return read_buckets(warehouse, name, at)
