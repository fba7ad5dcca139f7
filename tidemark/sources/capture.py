"""Capture files to validated events: discovery, layout, envelope, identity."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contract
from tidemark.contract import DEFAULT_FORMAT, CaptureFormat
from tidemark.functions import casts, identity
from tidemark.session import work_folder
from tidemark.sources import records

ALL_COLUMNS = tuple(dict.fromkeys(c for t in contract.TABLES for c in contract.source_columns(t)))

# What ``to_events`` returns.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("line", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ALL_COLUMNS],
        *[T.StructField(c, contract.staged_type(c)) for c in contract.ENVELOPE],
        T.StructField("_problem", T.StringType()),
    ]
)


MANIFEST = "path string, size long, modified timestamp"
# How Hadoop shows a file status; one call shows a whole folder.
_STATUS = re.compile(
    r"FileStatus\{path=(?P<path>.*?); isDirectory=(?P<folder>true|false);(?: length=(?P<size>\d+);.*?)?"
    r" modification_time=(?P<modified>\d+);",
    re.DOTALL,
)


def capture_manifest(spark: SparkSession, root: str) -> DataFrame:
    """``path, size, modified`` of every file under ``root`` whose name ends in .csv.

    Spark's readers pass over empty files and names that begin with ``_`` or
    ``.``; this lists folders through the Hadoop API instead, a call each, and
    reads no contents.
    """
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(top):
        raise FileNotFoundError(root)
    rows, folders = [], [top.toString()]
    while folders:
        listed = fs.listStatus(jvm.org.apache.hadoop.fs.Path(folders.pop()))
        shown = jvm.org.apache.commons.lang3.ArrayUtils.toString(listed)
        for found in _STATUS.finditer(shown):
            if found["folder"] == "true":
                folders.append(found["path"])
            elif found["path"].endswith(".csv"):
                modified = datetime.fromtimestamp(int(found["modified"]) / 1000, timezone.utc)
                rows.append((found["path"], int(found["size"]), modified))
    return spark.createDataFrame(sorted(rows), MANIFEST)


def unseen_by_spark(path: str) -> bool:
    """Names that Spark's readers take for hidden files."""
    return path.rsplit("/", 1)[-1].startswith(("_", "."))


def _readable(spark: SparkSession, files: Sequence[tuple[str, int]]) -> tuple[list[tuple[str, int]], dict[str, str]]:
    """Files under names that Spark reads, and the true names of those copied for it."""
    kept = [f for f in files if not unseen_by_spark(f[0])]
    named: dict[str, str] = {}
    hidden = [f for f in files if unseen_by_spark(f[0])]
    if hidden:
        jvm, folder = spark._jvm, work_folder(spark, "renamed")
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        for n, (path, size) in enumerate(hidden):
            source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}.csv")
            there = target.getFileSystem(conf)
            jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, there, target, False, conf)
            copied = there.getFileStatus(target).getPath().toString()
            named[copied] = path
            kept.append((copied, size))
    return kept, named


def require_files(manifest: DataFrame) -> DataFrame:
    if manifest.isEmpty():
        raise FileNotFoundError("no capture files found; check the capture before loading")
    return manifest


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^[A-Za-z0-9]+:/+", "/")


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``, or NULL when it lies elsewhere."""
    prefix = re.sub("^[A-Za-z0-9]+:/+", "/", root).rstrip("/") + "/"
    plain = _plain(path)
    return F.when(plain.startswith(prefix), F.substring(plain, len(prefix) + 1, 2**31 - 1))


def snapshot_table(relative: Column, fmt: CaptureFormat = DEFAULT_FORMAT) -> Column:
    """Table whose snapshot the file is part of, else NULL."""
    tables = "|".join(contract.TABLES)
    pattern = f"^{re.escape(fmt.snapshot_dir)}/({tables})/{re.escape(fmt.snapshot_prefix)}[^/]*$"
    return F.nullif(F.regexp_extract(relative, pattern, 1), F.lit(""))


def is_change_file(relative: Column, fmt: CaptureFormat = DEFAULT_FORMAT) -> Column:
    return F.coalesce(relative.rlike(f"^{re.escape(fmt.change_dir)}/[^/]+$"), F.lit(False))


def classify_paths(
    manifest: DataFrame, root: str, fmt: CaptureFormat = DEFAULT_FORMAT, path: str = "path"
) -> DataFrame:
    """Adds ``relative, snapshot_of, kind``; kind is NULL for a misplaced file."""
    relative = relative_path(F.col(path), root)
    table = snapshot_table(F.col("relative"), fmt)
    kind = F.when(F.col("snapshot_of").isNotNull(), "snapshot").when(
        is_change_file(F.col("relative"), fmt), "changes"
    )
    return (
        manifest.withColumn("relative", relative).withColumn("snapshot_of", table).withColumn("kind", kind)
    )


def split_envelope(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Adds what the file kind says: ``op, source_table, schema_label, lead, surplus``.

    Change rows lead with operation, table and schema; snapshot rows with the
    operation only, their table coming from the path.  ``surplus`` is how many
    fields follow the source columns: 2 in the current layout, 3 in the legacy
    one, whose first extra field is ignored.
    """
    if "too_long" not in rows.columns:
        rows = rows.withColumn("too_long", F.lit(False))
    kinds = files.select(F.col("source_file").alias("_file"), "snapshot_of", "kind")
    # One short row per file of the batch; a path is judged once, not per row.
    placed = rows.join(F.broadcast(kinds), F.col("source_file") == F.col("_file"), "left")
    fields, snapshot = F.col("fields"), F.col("snapshot_of").isNotNull()
    tabled = placed.select(
        *rows.columns,
        F.col("kind").isNotNull().alias("_placed"),
        snapshot.alias("_is_snapshot"),
        F.get(fields, F.lit(0)).alias("op"),
        F.coalesce("snapshot_of", F.get(fields, F.lit(1))).alias("source_table"),
        F.when(~snapshot, F.get(fields, F.lit(2))).alias("schema_label"),
        F.when(snapshot, F.lit(1)).otherwise(F.lit(3)).alias("lead"),
        F.size(fields).alias("width"),
    )
    number = F.lit(None).cast("int")
    for index, table in enumerate(contract.TABLES):
        number = F.when(F.col("source_table") == table, F.lit(index)).otherwise(number)
    numbered = tabled.withColumn("_table_no", number)
    expected = _by_table({t: len(contract.source_columns(t)) for t in contract.TABLES})
    return numbered.withColumn("surplus", F.col("width") - F.col("lead") - expected)


def _by_table(values: dict[str, int]) -> Column:
    chosen = F.lit(None).cast("int")
    for table, value in values.items():
        chosen = F.when(F.col("_table_no") == contract.TABLES.index(table), F.lit(value)).otherwise(chosen)
    return chosen


def normalize_layout(rows: DataFrame) -> DataFrame:
    """Named source columns, ``sequence`` and ``commit_text`` from either layout.

    Every source column of every table is present and a row fills its own.  A
    table's places are looked up in a constant: a choice among the tables for
    each column makes a method too long for the JVM to compile.
    """
    fields, homes = F.col("fields"), []
    for table in contract.TABLES:
        own = contract.source_columns(table)
        homes.append(F.array(*[F.lit(own.index(c) if c in own else None).cast("int") for c in ALL_COLUMNS]))
    placed = rows.withColumn("_homes", F.get(F.array(*homes), F.col("_table_no")))
    columns = [F.get(fields, F.col("lead") + F.get("_homes", F.lit(n))).alias(c) for n, c in enumerate(ALL_COLUMNS)]
    values = F.slice(fields, F.col("lead") + 1, _by_table({t: len(contract.source_columns(t)) for t in contract.TABLES}))
    return placed.select(
        *[c for c in rows.columns if c != "fields"],
        *columns,
        # No function over the elements, which is not compiled, where all bytes together fit the limit.
        F.when(
            F.octet_length(F.array_join(values, "")) > contract.SOURCE_WIDTH,
            F.exists(values, lambda value: F.length(value) > contract.SOURCE_WIDTH),
        ).alias("_wide"),
        F.get(fields, F.col("lead")).alias("_key"),
        F.get(fields, F.col("width") - 2).alias("sequence"),
        F.get(fields, F.col("width") - 1).alias("commit_text"),
    )


def problem(fmt: CaptureFormat = DEFAULT_FORMAT) -> Column:
    """Why a row cannot be accepted, NULL when it can; one bad row rejects its file."""
    snapshot, op, commit = F.col("_is_snapshot"), F.col("op"), F.col("commit_text")
    label = F.coalesce("schema_label", F.lit(""))
    return (
        F.when(~F.col("_placed"), F.lit("unexpected capture path"))
        .when(F.col("too_long"), F.lit("record is too long"))
        .when(F.col("bad_text"), F.lit("text is not UTF-8"))
        .when(~snapshot & (F.col("width") < 3), F.lit("missing operation, table or schema"))
        .when(~snapshot & ~label.isin(*fmt.schema_labels), F.lit("unexpected schema"))
        .when(
            F.col("_table_no").isNull() | op.isNull() | ~op.isin(*contract.OPERATIONS),
            F.lit("unsupported table or operation"),
        )
        .when(~F.col("surplus").isin(2, 3), F.lit("unexpected number of fields"))
        .when(snapshot & (op != "I"), F.lit("snapshots hold inserts only"))
        .when(~snapshot & ~identity.is_sequence(F.col("sequence")), F.lit("no positive change sequence"))
        .when(commit.isNull() | (commit == ""), F.lit("missing commit time"))
        .when(F.col("_commit_at").isNull(), F.lit("invalid commit time"))
        .when(F.col("_wide"), F.lit("source value is too wide"))
        .when(_wider("_event_id", contract.EVENT_ID_WIDTH), F.lit("event id is too wide"))
        .when(_wider("source_file", contract.SOURCE_FILE_WIDTH), F.lit("file name is too wide"))
    )


def _wider(column: str, limit: int) -> Column:
    """More characters than ``limit``; they are counted only where the bytes are more."""
    return (F.octet_length(column) > limit) & (F.length(column) > limit)


def to_events(rows: DataFrame, files: DataFrame, fmt: CaptureFormat = DEFAULT_FORMAT) -> DataFrame:
    """Events of all tables in one wide frame, with ``line`` and ``_problem``.

    ``rows``: source_file, line, fields, bad_text.  ``files``: source_file,
    snapshot_of, kind.  Plain expressions, no lambdas over arrays, keep this
    compiled; write the result before filtering it, or the filter drags the
    whole judgement below the projection again.
    """
    shaped = normalize_layout(split_envelope(rows, files))
    event_id = identity.event_id(
        F.col("source_table"),
        F.col("_is_snapshot"),
        F.col("_key"),
        F.col("sequence"),
        F.col("source_file"),
        F.col("line"),
    )
    identified = (
        shaped.withColumn("_event_id", event_id)
        .withColumn("_commit_at", casts.try_instant(F.col("commit_text")))
        .withColumn("_problem", problem(fmt))
    )
    order = F.when(F.col("_is_snapshot"), F.lit("0")).otherwise(F.col("sequence"))
    return identified.select(
        "source_table",
        "line",
        *ALL_COLUMNS,
        "_event_id",
        F.col("op").alias("_op"),
        F.when(F.col("_problem").isNull(), order).cast(contract.SEQUENCE_TYPE).alias("_source_order"),
        "_commit_at",
        "_is_snapshot",
        F.col("source_file").alias("_source_file"),
        "_problem",
    )


def batch_kinds(
    spark: SparkSession, root: str, files: Sequence[tuple[str, int]], fmt: CaptureFormat = DEFAULT_FORMAT
) -> DataFrame:
    """``source_file, snapshot_of, kind`` of a batch of listed files."""
    names = spark.createDataFrame([(path,) for path, _ in files], "source_file string")
    return classify_paths(names, root, fmt, "source_file")


def read_events(
    spark: SparkSession, root: str, files: Sequence[tuple[str, int]], fmt: CaptureFormat = DEFAULT_FORMAT
) -> DataFrame:
    """Parsed and judged events of (path, size) capture files below ``root``."""
    readable, named = _readable(spark, files)
    rows = records.read_records(spark, readable, fmt.null_token)
    if named:  # a row for each renamed file of the batch
        true = spark.createDataFrame(list(named.items()), "_copy string, _true string")
        joined = rows.join(F.broadcast(true), F.col("source_file") == F.col("_copy"), "left")
        rows = joined.withColumn("source_file", F.coalesce("_true", "source_file")).drop("_copy", "_true")
    return to_events(rows, batch_kinds(spark, root, files, fmt), fmt)


def table_events(events: DataFrame, table: str) -> DataFrame:
    """Accepted events of one table with its own columns."""
    own = events.filter((F.col("source_table") == table) & F.col("_problem").isNull())
    return own.select(*contract.raw_columns(table))

