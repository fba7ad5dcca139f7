"""Shared inputs of the registered queries, derived from the analytic tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contract
from tidemark.contract import CaptureFormat
from tidemark.functions import casts
from tidemark.plans import build, layers, update
from tidemark.session import small_splits, work_folder
from tidemark.sources import capture, feed, maintenance, sinks
from tidemark.sources.warehouse import Warehouse

# Spark names written files part-*, so exported snapshots carry that prefix.
EXPORT = CaptureFormat(snapshot_prefix="part")

_written: dict[tuple, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Instants shown as zone-less UTC, whatever the session zone."""
    shown = [
        casts.utc_wall_clock(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*shown)


class Asked(Mapping):
    """Frames by name, each made when it is first asked for."""

    def __init__(self, names: tuple[str, ...], make: Callable[[str], DataFrame]):
        self._names, self._make, self._made = names, make, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Context:
    """Raw, staged, current and mart frames over one table folder, all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return feed.raw_tables(self.spark, self.folder)

    @cached_property
    def staged(self) -> dict[str, DataFrame]:
        return layers.stage_all(self.raw)

    @cached_property
    def live(self) -> dict[str, DataFrame]:
        return layers.current_from_raw(self.raw)

    @cached_property
    def marts(self) -> dict[str, DataFrame]:
        return layers.marts_from_raw(self.raw)

    # Written inputs ------------------------------------------------------------
    # Queries that read several layers share one written copy per session and
    # folder, in the shared work folder, instead of computing the chain again.

    def _once(self, purpose: str, write) -> str:
        key = (self.spark.sparkContext.applicationId, self.folder, purpose)
        if key not in _written:
            target = work_folder(self.spark, purpose)
            write(target)
            _written[key] = target
        return _written[key]

    def _stored(self, purpose: str, names: tuple[str, ...], plan: Callable[[str], DataFrame]) -> Mapping[str, DataFrame]:
        """Frames written and read back, each when a query first asks for it."""

        def stored(name: str) -> DataFrame:
            df = plan(name)

            def write(target: str) -> None:
                with small_splits(self.spark):
                    df.write.parquet(target, compression="zstd")

            return self.spark.read.schema(df.schema).parquet(self._once(f"{purpose}-{name}", write))

        return Asked(names, stored)

    @cached_property
    def stored_raw(self) -> Mapping[str, DataFrame]:
        return self._stored("raw", contract.TABLES, lambda table: self.raw[table])

    @cached_property
    def stored_staged(self) -> Mapping[str, DataFrame]:
        return self._stored("staged", contract.TABLES, lambda table: layers.stage(self.stored_raw[table], table))

    @cached_property
    def stored_marts(self) -> Mapping[str, DataFrame]:
        return self._stored("marts", contract.MARTS, lambda mart: layers.mart_from_raw(self.stored_raw, mart))

    @cached_property
    def stored_live(self) -> Mapping[str, DataFrame]:
        return self._stored("live", contract.TABLES, lambda table: layers.current_table_from_raw(self.stored_raw[table], table))

    @cached_property
    def captures(self) -> str:
        """Capture files of the whole change log; orders use the legacy layout."""

        def write(root: str) -> None:
            options = sinks._csv_options(EXPORT.null_token)

            def parts(table: str) -> tuple[DataFrame, DataFrame]:
                raw = self.raw[table]
                columns = contract.source_columns(table)
                tail = [F.col("_source_order").cast("string").alias("_seq"), F.col("updated_at").alias("_at")]
                if table == "orders":
                    tail.insert(0, F.lit("0/16B3748").alias("_legacy"))
                lead = [F.col("_op").alias("_lead")]
                named = [F.lit(table).alias("_table"), F.lit("ecommerce").alias("_schema")]
                return raw.filter("_is_snapshot").select(*lead, *columns, *tail), raw.filter("not _is_snapshot").select(*lead, *named, *columns, *tail)

            made = {table: parts(table) for table in contract.TABLES}

            def snapshots() -> None:
                for table, (snapshot, _) in made.items():
                    snapshot.write.options(**options).csv(f"{root}/{EXPORT.snapshot_dir}/{table}")

            def changes() -> None:
                # One after another: writers into one folder would drop each other's unfinished files.
                for _, rows in made.values():
                    rows.write.mode("append").options(**options).csv(f"{root}/{EXPORT.change_dir}")

            # One fills the executors that the other's last tasks leave idle.
            with ThreadPoolExecutor(2) as pool:
                for done in (pool.submit(snapshots), pool.submit(changes)):
                    done.result()

        return self._once("captures", write)

    @cached_property
    def captured(self) -> DataFrame:
        """Events read from the exported captures, judged and written once."""
        files = [(r["path"], r["size"]) for r in capture.capture_manifest(self.spark, self.captures).collect()]
        target = self._once(
            "captured",
            lambda folder: capture.read_events(self.spark, self.captures, files, EXPORT).write.parquet(folder, compression="zstd"),
        )
        return self.spark.read.parquet(target)

    def new_warehouse(self) -> Warehouse:
        return Warehouse(self.spark, work_folder(self.spark, "warehouse"))

    @cached_property
    def updated(self) -> Warehouse:
        """Two loads compacted and built, a third folded in by an update of the touched buckets, then compacted as well."""

        def write(target: str) -> None:
            store, allow = Warehouse(self.spark, target), ("relationships",)
            listed = capture.capture_manifest(self.spark, self.captures).orderBy("path").collect()
            files = [(r["path"], r["size"]) for r in listed]
            for part in (files[1:-1:2], files[:-1:2]):
                store.land(part, self.captures, EXPORT)
            maintenance.compact(store)
            build.build(store, allow=allow)
            store.land(files[-1:], self.captures, EXPORT)
            update.update(store, allow=allow)
            maintenance.compact(store)
            maintenance.vacuum(store)

        return Warehouse(self.spark, self._once("updated", write))

    @cached_property
    def landed(self) -> Warehouse:
        """A warehouse into which all exported captures have been landed."""
        root = self._once(
            "landed", lambda target: Warehouse(self.spark, target).land_pending(self.captures, EXPORT)
        )
        return Warehouse(self.spark, root)
