"""Event identities, row keys, hashes and the NULL token."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a change sequence is 1 to 35 digits and not zero.
SEQUENCE = r"^[0-9]{1,35}$"


def decode_null(value: Column, token: str) -> Column:
    """NULL for the capture's token; an empty string stays one."""
    return F.when(value == token, F.lit(None)).otherwise(value)


def empty_to_null(value: Column) -> Column:
    """Only the headered baseline import reads an empty field as NULL."""
    return F.nullif(value, F.lit(""))


def is_sequence(value: Column) -> Column:
    return F.coalesce(value.rlike(SEQUENCE) & ~value.rlike("^0+$"), F.lit(False))


def file_line_digest(source_file: Column, line: Column) -> Column:
    return F.sha2(F.concat(source_file, F.lit(":"), line.cast("string")), 256)


def event_id(
    table: Column, is_snapshot: Column, key: Column, sequence: Column, source_file: Column, line: Column
) -> Column:
    """Stable identity of one captured event.

    Changes are identified by their sequence.  Snapshot rows by their key, and
    rows that lack one by file and record number, so that unrelated bad rows
    stay apart.
    """
    keyless = key.isNull() | (key == "")
    return (
        F.when(~is_snapshot, F.concat(F.lit("cdc:"), table, F.lit(":"), sequence))
        .when(
            keyless,
            F.concat(F.lit("snapshot-missing-key:"), table, F.lit(":"), file_line_digest(source_file, line)),
        )
        .otherwise(F.concat(F.lit("snapshot:"), table, F.lit(":"), key))
    )


def row_key(parent: Column, part: Column) -> Column:
    """``parent:part`` with the part printed as a plain integer."""
    return F.concat(parent, F.lit(":"), part.cast("int").cast("string"))


def length_prefixed(columns: Iterable[str | Column]) -> Column:
    """Unambiguous text of several values; NULL and '' differ."""
    parts = []
    for column in columns:
        value = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-1:"))
        )
    return F.concat(*parts)


def attribute_hash(attributes: Iterable[str], op: str = "_op") -> Column:
    presence = F.when(F.col(op) == "D", F.lit("deleted")).otherwise(F.lit("present"))
    return F.md5(F.concat(length_prefixed(attributes), presence))


def version_id(key: str, order: str = "_source_order") -> Column:
    return F.md5(F.concat(F.col(key), F.lit(":"), F.col(order).cast("string")))


def hex_slice(digest: Column, start: int) -> Column:
    """60 bits of a hex digest as an exact decimal."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)")
