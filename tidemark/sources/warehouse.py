"""Append-only raw storage on plain Parquet folders, atomic per file.

``raw/load_id=<id>/source_table=<t>/`` holds what one load delivered and
``ledger/`` one row per accepted file; ``rejected/`` says which files were
refused, where and why.  A load becomes visible when its ledger rows, written
last as a single file, exist; anything a crashed or rejected load
left behind belongs to no ledger row and is never read.  One writer at a time.

``maintenance.compact`` moves loads to ``laid/load_id=<id>/source_table=<t>/bucket=<n>/``,
laid out by hash buckets of the primary key.  ``moves/`` says where a load is
now; its rows, appended as one file, switch many loads at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contract
from tidemark.contract import DEFAULT_FORMAT, CaptureFormat
from tidemark.operators import joins, profiles
from tidemark.session import unsorted_writes
from tidemark.sources import buckets as layout
from tidemark.sources import capture

MAX_FILES = 10_000
# Bytes of one landing, which bounds its file splits (8,000 of 128 MB).
MAX_BYTES = 1 << 40
REJECTED = "_rejected"
MOVES = "load_id string, into string, sequence bigint, buckets int"


class RejectedFile(ValueError):
    """A capture file broke the contract; files before it in name order landed."""


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in one folder; none if it does not exist."""
    if not path_exists(spark, folder):
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [status.getPath().getName() for status in fs.listStatus(path)]


@dataclass(frozen=True)
class Landing:
    """What one ``land`` call did; only committed files count in ``metrics``."""

    load_id: str | None
    rejected: list[tuple[str, int, str]]  # file, record number, reason
    metrics: dict[str, int]


def _metric() -> Column:
    return F.when(F.col("_is_snapshot"), F.lit("snapshot_rows")).otherwise(F.concat(F.lit("input_"), F.col("_op")))


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str
    buckets: int = layout.BUCKETS

    def folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def ledger(self) -> DataFrame:
        """Accepted files: ``source_file, loaded_at, row_count, load_id``."""
        if not path_exists(self.spark, self.folder("ledger")):
            return self.spark.createDataFrame([], contract.LEDGER_SCHEMA)
        return self.spark.read.schema(contract.LEDGER_SCHEMA).parquet(self.folder("ledger"))

    def rejected(self) -> DataFrame:
        """Refused files: ``source_file, line, reason, rejected_at, run_id``, a row per refusal."""
        if not path_exists(self.spark, self.folder("rejected")):
            return self.spark.createDataFrame([], contract.REJECTED_SCHEMA)
        return self.spark.read.schema(contract.REJECTED_SCHEMA).parquet(self.folder("rejected"))

    def unaccounted(self, manifest: DataFrame) -> DataFrame:
        """Listed files that were neither accepted nor refused."""
        known = self.ledger().select("source_file").union(self.rejected().select("source_file"))
        return manifest.join(known, F.col("path") == F.col("source_file"), "left_anti")

    def loads(self) -> DataFrame:
        """Committed loads: one row per batch, not per file or row."""
        return self.ledger().select("load_id").distinct()

    def moves(self) -> DataFrame | None:
        """``load_id, into``: where compaction has put a load; None before the first compaction."""
        if not path_exists(self.spark, self.folder("moves")):
            return None
        rows = self.spark.read.schema(MOVES).parquet(self.folder("moves"))
        newest = rows.groupBy("load_id").agg(F.max_by(F.struct("into", "buckets"), "sequence").alias("_m"))
        return newest.select("load_id", "_m.into", "_m.buckets")

    def _delivered(self, schema: T.StructType, loads: DataFrame | None, only: Sequence[int] | None, tables: Sequence[str]) -> DataFrame:
        """``schema``, ``load_id`` and ``source_table`` of committed loads, each read where it is now.

        The joins with the short list of loads prune folders of others when they
        run.  ``only`` keeps the buckets with these numbers: a folder filter for
        compacted loads, a row filter for others.
        """
        wanted = self.loads() if loads is None else loads
        parts, moves = [], self.moves()
        extra = [T.StructField("load_id", T.StringType()), T.StructField("source_table", T.StringType())]
        named = [*schema.names, "load_id", "source_table"]
        here = F.col("source_table").isin(list(tables))
        if path_exists(self.spark, self.folder("raw")):
            # A row of some 40 bytes per load: 4 MB for a year of five-minute batches.
            unmoved = wanted if moves is None else wanted.join(moves, "load_id", "left_anti")
            events = self.spark.read.schema(T.StructType([*schema.fields, *extra])).parquet(self.folder("raw"))
            if only is not None:
                events = events.filter(self._bucket().isin(list(only)))
            parts.append(events.filter(here).join(F.broadcast(unmoved), "load_id", "left_semi").select(*named))
        if moves is not None:
            held = [T.StructField("landed_by", T.StringType()), *extra, T.StructField("bucket", T.IntegerType())]
            events = self.spark.read.schema(T.StructType([*schema.fields, *held])).parquet(self.folder("laid"))
            if only is not None:
                events = events.filter(F.col("bucket").isin(list(only)))
            moved = moves.join(wanted, "load_id", "left_semi").select(F.col("load_id").alias("_load"), "into")
            at = (F.col("load_id") == F.col("into")) & (F.col("landed_by") == F.col("_load"))
            events = events.filter(here).join(F.broadcast(moved), at, "left_semi")
            parts.append(events.withColumn("load_id", F.col("landed_by")).select(*named))
        if not parts:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *extra]))
        return profiles.union_tables(parts)

    def _bucket(self) -> Column:
        cases = [F.when(F.col("source_table") == t, layout.number(contract.primary_key(t), self.buckets)) for t in contract.TABLES]
        return F.coalesce(*cases)

    def events(self, loads: DataFrame | None = None, table: str | None = None) -> DataFrame:
        """Events of all tables as landed, or of one with its own columns, with the ``load_id`` that delivered them."""
        fields = [f for f in capture.EVENT_SCHEMA.fields if f.name != "source_table"]
        if table is not None:
            fields = [f for f in fields if f.name in ("line", *contract.raw_columns(table))]
        return self._delivered(T.StructType(fields), loads, None, contract.TABLES if table is None else [table])

    def raw(self, table: str, loads: DataFrame | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """Delivered events of committed loads, or of ``loads``; ``only`` those whose primary key falls into these buckets."""
        schema = contract.raw_schema(table)
        if only is None:
            return self._delivered(schema, loads, None, [table]).select(*contract.raw_columns(table))
        # The row filter names the keys of all tables.
        keys = [T.StructField(contract.primary_key(t), T.StringType()) for t in contract.TABLES]
        wider = T.StructType([*schema.fields, *[k for k in keys if k.name not in schema.names]])
        return self._delivered(wider, loads, only, [table]).select(*contract.raw_columns(table))

    def raw_tables(self, loads: DataFrame | None = None) -> dict[str, DataFrame]:
        return {table: self.raw(table, loads) for table in contract.TABLES}

    # landing -----------------------------------------------------------------

    def _written(self, load_id: str) -> DataFrame:
        # An explicit schema also reads a load whose files held no records.
        return self.spark.read.schema(capture.EVENT_SCHEMA).parquet(self.folder(f"raw/load_id={load_id}"))

    def _write(self, events: DataFrame, load_id: str) -> None:
        table = F.when(F.col("_problem").isNull(), F.col("source_table")).otherwise(F.lit(REJECTED))
        stored = events.withColumn("source_table", table)
        with unsorted_writes(self.spark, len(contract.TABLES) + 1):
            stored.write.partitionBy("source_table").parquet(self.folder(f"raw/load_id={load_id}"), compression="zstd")

    def _summary(self, load_id: str) -> list:
        """Rows per file and kind, with each file's first problem: one small scan.

        At most a handful of rows per file of the batch reach the driver.
        """
        events, by = self._written(load_id), ("_source_file", _metric().alias("metric"))
        # Counts alone need no sort; texts are compared among refused rows only, which lie in a folder of their own.
        none = F.lit(None)
        good = events.filter(F.col("source_table") != REJECTED).groupBy(*by).agg(
            F.lit(False).alias("bad"), F.count(F.lit(1)).alias("n"), none.cast("long").alias("line"), none.cast("string").alias("problem")
        )
        bad = events.filter(F.col("source_table") == REJECTED).groupBy(*by).agg(
            F.lit(True).alias("bad"),
            F.count(F.lit(1)).alias("n"),
            F.min("line").alias("line"),
            F.min_by("_problem", "line").alias("problem"),
        )
        return good.unionByName(bad).collect()

    def _commit(self, files: Sequence[tuple[str, int]], load_id: str, summary: list) -> None:
        """Append ledger rows of ``files`` in one file; the load is visible after."""
        counts = dict.fromkeys((name for name, _ in files), 0)
        for row in summary:
            if row["_source_file"] in counts:
                counts[row["_source_file"]] += row["n"]
        now = datetime.now(timezone.utc)
        rows = [(name, now, n, load_id) for name, n in counts.items()]
        ledger = self.spark.createDataFrame(rows, contract.LEDGER_SCHEMA)
        ledger.coalesce(1).write.mode("append").parquet(self.folder("ledger"))

    def _refuse(self, rejected: list[tuple[str, int, str]], run_id: str) -> None:
        now = datetime.now(timezone.utc)
        rows = [(*r, now, run_id) for r in rejected]
        frame = self.spark.createDataFrame(rows, contract.REJECTED_SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(self.folder("rejected"))

    def land(
        self,
        files: Sequence[tuple[str, int]],
        capture_root: str,
        fmt: CaptureFormat = DEFAULT_FORMAT,
        strict: bool = True,
        run_id: str | None = None,
    ) -> Landing:
        """Land (path, size) files in one job.

        A file with any bad row is rejected whole.  Strict: files before the
        first bad one in name order land, then ``RejectedFile`` is raised.
        Otherwise all good files land and the bad ones are returned with reasons.
        Refused files are recorded in ``rejected`` either way.
        """
        files = sorted(files)
        load_id = uuid.uuid4().hex
        run_id = run_id or load_id
        self._write(capture.read_events(self.spark, capture_root, files, fmt), load_id)
        summary = self._summary(load_id)
        bad = sorted((r["_source_file"], r["line"], r["problem"]) for r in summary if r["bad"])
        rejected = list({name: (name, line, text) for name, line, text in reversed(bad)}.values())[::-1]
        names = {name for name, _, _ in rejected}
        kept = files
        if rejected:
            kept = [f for f in files if (f[0] < rejected[0][0] if strict else f[0] not in names)]
            # Rare path: copy the accepted files' rows to a load of their own.
            if kept:
                crossed, load_id = self._written(load_id), uuid.uuid4().hex
                wanted = F.broadcast(self.spark.createDataFrame([(name,) for name, _ in kept], "_kept string"))
                self._write(crossed.join(wanted, F.col("_source_file") == F.col("_kept"), "left_semi"), load_id)
        metrics: dict[str, int] = {}
        if kept:
            self._commit(kept, load_id, summary)
            landed = {name for name, _ in kept}
            metrics["files_committed"] = len(kept)
            for row in summary:
                if row["_source_file"] in landed:
                    metrics[row["metric"]] = metrics.get(row["metric"], 0) + row["n"]
        if rejected:
            # Strict landing stops at the first; the others will be judged again.
            self._refuse(rejected[:1] if strict else rejected, run_id)
        if rejected and strict:
            name, line, text = rejected[0]
            raise RejectedFile(f"{name}:{line}: {text}")
        return Landing(load_id if kept else None, rejected, metrics)

    def pending(self, manifest: DataFrame) -> DataFrame:
        return joins.pending_files(manifest, self.ledger())

    def land_pending(
        self,
        capture_root: str,
        fmt: CaptureFormat = DEFAULT_FORMAT,
        strict: bool = True,
        max_files: int = MAX_FILES,
    ) -> dict[str, int]:
        """Land everything the ledger lacks, in name order, a batch at a time.

        ``files_rejected`` counts what was refused (see ``rejected``); a later
        call offers those files again.
        """
        manifest = capture.require_files(capture.capture_manifest(self.spark, capture_root))
        listed, run_id = manifest.count(), uuid.uuid4().hex
        metrics = {"files_listed": listed, "files_already_loaded": listed - self.pending(manifest).count()}
        while True:
            refused = self.rejected().filter(F.col("run_id") == run_id).select("source_file")
            waiting = self.pending(manifest).join(refused, F.col("path") == F.col("source_file"), "left_anti")
            batch = within_bytes([(r["path"], r["size"]) for r in waiting.orderBy("path").limit(max_files).collect()])
            if not batch:
                return metrics
            landing = self.land(batch, capture_root, fmt, strict, run_id)
            found = dict(landing.metrics)
            if landing.rejected:
                found["files_rejected"] = len(landing.rejected)
            for name, value in found.items():
                metrics[name] = metrics.get(name, 0) + value


def within_bytes(files: list[tuple[str, int]], most: int = MAX_BYTES) -> list[tuple[str, int]]:
    """The first files that together hold at most ``most`` bytes, or the first alone."""
    total, kept = 0, []
    for path, size in files:
        total += size
        if kept and total > most:
            break
        kept.append((path, size))
    return kept


def committed_events(warehouse: Warehouse, load_id: str) -> DataFrame:
    moves = warehouse.moves()
    if moves is None or moves.where(F.col("load_id") == load_id).isEmpty():
        return warehouse._written(load_id)
    own = warehouse.events(warehouse.spark.createDataFrame([(load_id,)], "load_id string"))
    return own.select(*capture.EVENT_SCHEMA.names)


def event_metrics(events: DataFrame) -> DataFrame:
    """``metric, value``: snapshot rows and changes by operation."""
    return events.groupBy(_metric().alias("metric")).agg(F.count(F.lit(1)).alias("value"))


def assert_raw_schema(df: DataFrame, table: str) -> None:
    """Refuse raw tables whose source columns are not plain text."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    wrong = [c for c in contract.source_columns(table) if not isinstance(kinds.get(c), T.StringType)]
    if wrong:
        raise TypeError(f"raw {table} columns must be text: {wrong}; rebuild raw from the capture files")


def too_wide(df: DataFrame, table: str) -> DataFrame:
    """Raw rows beyond the width limits (in characters)."""
    wide = F.lit(False)
    limits = dict.fromkeys(contract.source_columns(table), contract.SOURCE_WIDTH)
    limits |= {"_event_id": contract.EVENT_ID_WIDTH, "_op": 1, "_source_file": contract.SOURCE_FILE_WIDTH}
    for column, limit in limits.items():
        wide = wide | F.coalesce(F.length(column) > limit, F.lit(False))
    return df.filter(wide)
