"""Derived files: copy-ready CSV, typed Parquet, and a size comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.contract import DEFAULT_FORMAT, CaptureFormat
from tidemark.functions import casts
from tidemark.operators import compare, profiles
from tidemark.plans import layers
from tidemark.session import work_folder


def _csv_options(null_token: str) -> dict:
    # Spark would otherwise trim values and write \" for a doubled quote.
    return {
        "nullValue": null_token,
        "emptyValue": "",
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def _iso_utc(instant: Column) -> Column:
    clock = F.date_format(casts.utc_wall_clock(instant), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    whole = F.when(F.endswith(clock, F.lit(".000000")), F.substring(clock, F.lit(1), F.length(clock) - 7)).otherwise(clock)
    return F.concat(whole, F.lit("+00:00"))


def copy_ready(events: DataFrame, table: str) -> DataFrame:
    """Source text untouched, envelope as text: UTC commit time, true or false."""
    return events.select(
        *contract.source_columns(table),
        "_event_id",
        "_op",
        F.col("_source_order").cast("string").alias("_source_order"),
        _iso_utc(F.col("_commit_at")).alias("_commit_at"),
        F.col("_is_snapshot").cast("string").alias("_is_snapshot"),
        "_source_file",
    )


def _capture_name(source_file: Column) -> Column:
    """Folder and file of the capture path, without its ending."""
    return F.regexp_extract(source_file, r"((?:initial-load/[^/]+|[^/]+)/[^/]+?)(?:\.csv)?$", 1)


def write_copy_ready(
    events: DataFrame, table: str, root: str, fmt: CaptureFormat = DEFAULT_FORMAT
) -> str:
    """CSV per table below a folder named after the capture file.

    A retry overwrites the folders of the captures it holds and no others.  One
    capture's rows may take several part files, so a large one is not one task.
    """
    folder = f"{root.rstrip('/')}/copy-ready/{table}"
    named = copy_ready(events, table).withColumn("capture", _capture_name(F.col("_source_file")))
    (
        named.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("capture")
        .options(**_csv_options(fmt.null_token))
        .csv(folder)
    )
    return folder


def write_typed_parquet(events: DataFrame, table: str, path: str, codec: str = "zstd") -> None:
    """Typed columns in contract order.  A bad value or missing envelope field fails."""
    typed = layers.typed(events, table)
    required = [
        F.when(F.col(c).isNull(), F.raise_error(F.lit(f"required {c} is missing"))).otherwise(F.col(c)).alias(c)
        for c in contract.ENVELOPE
    ]
    typed.select(*contract.source_columns(table), *required).write.mode("overwrite").option(
        "compression", codec
    ).parquet(path)


def stored_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of the data files in ``folder``, from file metadata only."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option(
        "recursiveFileLookup", "true"
    ).load(folder)
    return files.agg(F.sum("length").alias("bytes"))


FORMATS = ("csv_gzip", "parquet_snappy", "parquet_zstd")


def compare_formats(
    spark: SparkSession, events: DataFrame, table: str, fmt: CaptureFormat = DEFAULT_FORMAT, formats: Sequence[str] = FORMATS
) -> DataFrame:
    """``source_table, format, row_count, bytes, roundtrip_ok`` per storage format."""
    parts = []
    typed = layers.typed(events, table)
    for name in formats:
        folder = work_folder(spark, name)
        kind, codec = name.split("_")
        if kind == "csv":
            text = copy_ready(events, table)
            text.write.options(**_csv_options(fmt.null_token)).option("compression", codec).csv(folder)
            # CSV readers here merge NULL and '', so rows are compared as text
            # with both as NULL; multiLine keeps embedded line breaks.
            back = (
                spark.read.schema(text.schema)
                .options(**_csv_options(fmt.null_token))
                .option("multiLine", "true")
                .csv(folder)
            )
            merged = [F.nullif(F.col(c), F.lit("")).alias(c) for c in text.columns]
            same = compare.same_content(text.select(*merged), back.select(*merged))
        else:
            typed.write.option("compression", codec).parquet(folder)
            same = compare.same_content(typed, spark.read.schema(typed.schema).parquet(folder))
        count = spark.read.schema(typed.schema).parquet(folder) if kind == "parquet" else back
        facts = profiles.union_tables(
            [
                stored_bytes(spark, folder).select("bytes", F.lit(None).cast("long").alias("row_count"), F.lit(None).cast("boolean").alias("equal")),
                count.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(None).cast("long").alias("bytes"), "row_count", F.lit(None).cast("boolean").alias("equal")),
                same.select(F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("long").alias("row_count"), "equal"),
            ]
        )
        parts.append(
            facts.agg(F.max("row_count").alias("row_count"), F.max("bytes").alias("bytes"), F.max("equal").alias("roundtrip_ok")).select(
                F.lit(table).alias("source_table"), F.lit(name).alias("format"), "row_count", "bytes", "roundtrip_ok"
            )
        )
    return profiles.union_tables(parts)
