"""Import of a headered historical export into the four source tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.functions import identity
from tidemark.operators import checks, profiles
from tidemark.sources import records

# Export header of each source column; derived keys have none.
HEADERS: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": "customer_id",
        "customer_unique_id": "customer_unique_id",
        "postal_code": "customer_zip_code_prefix",
        "city": "customer_city",
        "state": "customer_state",
    },
    "orders": {
        "order_id": "order_id",
        "customer_id": "customer_id",
        "status": "order_status",
        "purchased_at": "order_purchase_timestamp",
        "approved_at": "order_approved_at",
        "carrier_delivered_at": "order_delivered_carrier_date",
        "customer_delivered_at": "order_delivered_customer_date",
        "estimated_delivery_at": "order_estimated_delivery_date",
    },
    "order_items": {
        "order_id": "order_id",
        "order_item_id": "order_item_id",
        "product_id": "product_id",
        "seller_id": "seller_id",
        "shipping_limit_at": "shipping_limit_date",
        "price": "price",
        "freight_value": "freight_value",
    },
    "order_payments": {
        "order_id": "order_id",
        "payment_sequential": "payment_sequential",
        "payment_type": "payment_type",
        "payment_installments": "payment_installments",
        "payment_value": "payment_value",
    },
}
# Table -> (derived key, parent, part).
DERIVED_KEYS = checks.SOURCE_PAIRS


def import_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One export file (or folder of files with the same header) as text columns.

    Empty fields are NULL here, unlike in capture files; a byte order mark
    before the header is dropped; leading zeros stay.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = [(r["path"], r["length"]) for r in listing.select("path", "length").collect()]
    if not files:
        raise FileNotFoundError(f"no export file for {table} at {path}")
    rows = records.read_records(spark, files)
    headers = rows.filter(F.col("line") == 1).select("fields").distinct().take(2)
    layouts = {tuple(name.removeprefix("\ufeff") for name in r["fields"]) for r in headers}
    if len(layouts) != 1:
        raise ValueError(f"{table} export has no single header")
    names = list(layouts.pop())
    missing = sorted(set(HEADERS[table].values()) - set(names))
    if missing:
        raise ValueError(f"{table} export lacks columns: {missing}")
    # The header's fields are blanked as well as filtered: Spark may evaluate a
    # cast on them before, or together with, the filter.
    data = F.col("line") > 1
    body = rows.withColumn("fields", F.when(data, F.col("fields"))).filter(data)
    read = {
        column: identity.empty_to_null(F.get("fields", F.lit(names.index(title))))
        for column, title in HEADERS[table].items()
    }
    if table in DERIVED_KEYS:
        key, parent, part = DERIVED_KEYS[table]
        read[key] = identity.row_key(read[parent], read[part])
    return body.select(*[read[c].alias(c) for c in contract.SOURCE_COLUMNS[table]])


def import_baseline(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """All four tables; a missing export is an error before anything is used."""
    lacking = [t for t in contract.TABLES if t not in paths]
    if lacking:
        raise ValueError(f"missing export for: {lacking}")
    return {table: import_table(spark, paths[table], table) for table in contract.TABLES}


def baseline_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return profiles.mart_counts(tables).withColumnRenamed("mart", "source_table")


def validated_baseline(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Import that is accepted or refused as a whole on the source constraints."""
    tables = import_baseline(spark, paths)
    checks.gate(checks.constraint_checks(tables))
    return tables


