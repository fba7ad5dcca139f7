"""The change-log contract: tables, column order, types and the event envelope.

Everything downstream (parsing, landing, casting, checks, reconciliation) reads
its columns from here, so a schema change is made in one place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Business columns of each source table, in source order.  The
# first column is the row key; every table carries updated_at after these.
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id", "customer_unique_id", "postal_code", "city", "state"),
    "orders": (
        "order_id",
        "customer_id",
        "status",
        "purchased_at",
        "approved_at",
        "carrier_delivered_at",
        "customer_delivered_at",
        "estimated_delivery_at",
    ),
    "order_items": (
        "order_item_key",
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_at",
        "price",
        "freight_value",
    ),
    "order_payments": (
        "payment_key",
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ),
}
TABLES: tuple[str, ...] = tuple(SOURCE_COLUMNS)

# Columns whose staged type is not plain text.
NAIVE_TIMESTAMPS = frozenset(
    {
        "purchased_at",
        "approved_at",
        "carrier_delivered_at",
        "customer_delivered_at",
        "estimated_delivery_at",
        "shipping_limit_at",
    }
)
UTC_TIMESTAMPS = frozenset({"updated_at"})
MONEY = frozenset({"price", "freight_value", "payment_value"})
INTEGERS = frozenset({"order_item_id", "payment_sequential", "payment_installments"})

# The normalized event envelope stored beside the source columns.
ENVELOPE = ("_event_id", "_op", "_source_order", "_commit_at", "_is_snapshot", "_source_file")
OPERATIONS = ("I", "U", "D")

# Attributes whose change opens a new customer version.
CUSTOMER_ATTRIBUTES = ("customer_unique_id", "city", "state", "postal_code")

# Raw width limits, in characters.
SOURCE_WIDTH = 256
EVENT_ID_WIDTH = 128
SOURCE_FILE_WIDTH = 2048

SEQUENCE_TYPE = T.DecimalType(35, 0)
MONEY_TYPE = T.DecimalType(14, 2)
TOTAL_TYPE = T.DecimalType(18, 2)

# The published tables.
MARTS = (
    "dim_customers",
    "dim_customer_history",
    "fct_orders",
    "fct_order_items",
    "fct_order_payments",
)

# The source tables that each published table is made of.
MART_TABLES: dict[str, tuple[str, ...]] = {
    "dim_customers": ("customers",),
    "dim_customer_history": ("customers",),
    "fct_orders": ("orders", "order_items", "order_payments"),
    "fct_order_items": ("order_items",),
    "fct_order_payments": ("order_payments",),
}


@dataclass(frozen=True)
class CaptureFormat:
    """How capture files encode what plain CSV cannot.

    ``null_token`` is the literal the capture writes for NULL; an unquoted or
    quoted empty field is an empty string.  Set it to the token your capture
    uses.  ``schema_labels`` are the source schema names accepted on change
    rows.  Snapshots live in ``<snapshot_dir>/<table>/<snapshot_prefix>*`` and
    changes in ``<change_dir>/<file>``.
    """

    null_token: str = "__NULL__"
    schema_labels: tuple[str, ...] = ("ecommerce", "initial-load")
    snapshot_dir: str = "initial-load"
    snapshot_prefix: str = "LOAD"
    change_dir: str = "cdc"


DEFAULT_FORMAT = CaptureFormat()


def source_columns(table: str) -> list[str]:
    """Source columns of ``table`` including the trailing audit time."""
    return [*SOURCE_COLUMNS[table], "updated_at"]


def primary_key(table: str) -> str:
    return SOURCE_COLUMNS[table][0]


def raw_columns(table: str) -> list[str]:
    return [*source_columns(table), *ENVELOPE]


def staged_type(column: str) -> T.DataType:
    if column in NAIVE_TIMESTAMPS:
        return T.TimestampNTZType()
    if column in UTC_TIMESTAMPS or column == "_commit_at":
        return T.TimestampType()
    if column in MONEY:
        return MONEY_TYPE
    if column in INTEGERS:
        return T.IntegerType()
    if column == "_source_order":
        return SEQUENCE_TYPE
    if column == "_is_snapshot":
        return T.BooleanType()
    return T.StringType()


def raw_schema(table: str) -> T.StructType:
    """Raw keeps every source value as text; only the envelope is typed."""
    source = [T.StructField(c, T.StringType(), True) for c in source_columns(table)]
    envelope = [T.StructField(c, staged_type(c), False) for c in ENVELOPE]
    return T.StructType(source + envelope)


def staged_schema(table: str) -> T.StructType:
    source = [T.StructField(c, staged_type(c), True) for c in source_columns(table)]
    envelope = [T.StructField(c, staged_type(c), False) for c in ENVELOPE]
    return T.StructType(source + envelope)


LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType(), False),
        T.StructField("loaded_at", T.TimestampType(), False),
        T.StructField("row_count", T.LongType(), False),
        T.StructField("load_id", T.StringType(), False),
    ]
)

# Why a file was refused, and in which landing; a file may be offered again.
REJECTED_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType(), False),
        T.StructField("line", T.LongType(), True),
        T.StructField("reason", T.StringType(), False),
        T.StructField("rejected_at", T.TimestampType(), False),
        T.StructField("run_id", T.StringType(), False),
    ]
)
