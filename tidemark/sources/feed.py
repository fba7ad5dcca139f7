"""Raw change logs derived from the analytic test tables, by plain projection.

Orders, line items, customers and user events become the four raw tables: all
source values as text, with snapshots, changes, deletions, reinserts, late
snapshots, out-of-order files and redelivered copies.  Every derived row comes
from one input row, so the logs grow with the tables and need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.functions import casts, identity


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(value) -> Column:
    return F.col(value).cast("string") if isinstance(value, str) else value.cast("string")


def _money(value: Column) -> Column:
    return value.cast("decimal(14,2)").cast("string")


def _seq(value: Column) -> Column:
    return value.cast(contract.SEQUENCE_TYPE)


def _assemble(df: DataFrame, table: str) -> DataFrame:
    return df.select(*contract.raw_columns(table))


def _envelope(df: DataFrame, table: str, snapshot: bool, commit: Column) -> DataFrame:
    """Add id and commit time; ``_op``, ``_seq`` and ``_source_file`` exist already."""
    key = F.col(contract.primary_key(table))
    kind = F.lit(f"snapshot:{table}:") if snapshot else F.lit(f"cdc:{table}:")
    tail = key if snapshot else F.col("_seq").cast("string")
    return (
        df.withColumn("_event_id", F.concat(kind, tail))
        .withColumn("_source_order", _seq(F.lit(0)) if snapshot else F.col("_seq"))
        .withColumn("_commit_text", commit)
        .withColumn("updated_at", F.col("_commit_text"))
        .withColumn("_commit_at", casts.source_instant(F.col("_commit_text")))
        .withColumn("_is_snapshot", F.lit(snapshot))
    )


def _with_copies(df: DataFrame, every: int) -> DataFrame:
    """Redeliver each event whose sequence divides by ``every`` in a replay file."""
    again = F.col("_source_order") % every == 0
    files = F.when(again, F.array(F.col("_source_file"), F.lit("cdc/replay-000.csv"))).otherwise(
        F.array(F.col("_source_file"))
    )
    return df.withColumn("_source_file", F.explode(files))


def _person(key: Column) -> tuple[Column, Column, Column, Column]:
    return (
        F.concat(F.lit("P"), (key % 1000).cast("string")),
        F.lpad(key.cast("string"), 8, "0"),
        F.concat(F.lit("base-"), (key % 7).cast("string")),
        F.concat(F.lit("N"), (key % 25).cast("string")),
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    person, postal, city, state = _person(F.col("c_custkey"))
    snapshot = _table(spark, folder, "customer").select(
        _text("c_custkey").alias("customer_id"),
        person.alias("customer_unique_id"),
        postal.alias("postal_code"),
        city.alias("city"),
        state.alias("state"),
        F.lit("I").alias("_op"),
        F.lit("initial-load/customers/LOAD00000001.csv").alias("_source_file"),
        (F.col("c_custkey") % 10 == 3).alias("_late"),
    )
    taken = F.when(F.col("_late"), F.lit("2024-02-01 00:00:00")).otherwise(F.lit("2023-12-31 00:00:00"))
    snapshot = _assemble(_envelope(snapshot, "customers", True, taken), "customers")

    person, postal, city, state = _person(F.col("user_id"))
    number, kind = F.col("event_id"), F.col("event_type")
    moved = (
        F.when(kind.isin("purchase", "signup"), F.concat(F.lit("segment, \""), (number % 3).cast("string"), F.lit('"')))
        .when((kind == "click") & (number % 13 == 0), F.lit(""))
        .when((kind == "view") & (number % 17 == 0), F.concat(F.lit("line one\nline "), (number % 2).cast("string")))
        .otherwise(city)
    )
    changes = _table(spark, folder, "events").select(
        _text("user_id").alias("customer_id"),
        person.alias("customer_unique_id"),
        F.when(number % 11 != 0, postal).alias("postal_code"),
        moved.alias("city"),
        state.alias("state"),
        F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U").alias("_op"),
        _seq(number + 1).alias("_seq"),
        F.concat(
            F.lit("cdc/"), F.lpad((number * 7919 % 64).cast("string"), 3, "0"), F.lit(".csv")
        ).alias("_source_file"),
        _text("ts").alias("_ts"),
    )
    changes = _with_copies(_envelope(changes, "customers", False, F.col("_ts")), 7)
    return snapshot.unionByName(_assemble(changes, "customers"))


def _order_columns(step: Column) -> list[Column]:
    day = F.col("o_orderdate").cast("date")

    def stamp(days: int, clock: str) -> Column:
        return F.concat(F.date_add(day, days).cast("string"), F.lit(clock))

    return [
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        F.element_at(F.array(*[F.lit(s) for s in ("created", "approved", "shipped", "delivered")]), step + 1).alias(
            "status"
        ),
        stamp(0, " 08:15:00").alias("purchased_at"),
        F.when(step >= 1, stamp(1, " 10:00:00.250000")).alias("approved_at"),
        F.when(step >= 2, stamp(3, "T06:30:00")).alias("carrier_delivered_at"),
        F.when(step >= 3, stamp(8, " 17:45:10")).alias("customer_delivered_at"),
        stamp(20, "").alias("estimated_delivery_at"),
    ]


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = _table(spark, folder, "orders")
    snapshot = orders.select(
        *_order_columns(F.lit(0)),
        F.lit("I").alias("_op"),
        F.lit("initial-load/orders/LOAD00000001.csv").alias("_source_file"),
    )
    snapshot = _assemble(
        _envelope(snapshot, "orders", True, F.lit("2023-12-31 00:00:00")), "orders"
    )
    number = F.col("o_orderkey")
    steps = orders.filter(number % 5 == 0).withColumn(
        "_step", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    )
    step = F.col("_step")
    op = (
        F.when((number % 20 == 5) & (step == 2), "D")
        .when((number % 20 == 5) & (step == 3), "I")
        .when((number % 20 == 10) & (step == 3), "D")
        .otherwise("U")
    )
    changes = steps.select(
        *_order_columns(step),
        op.alias("_op"),
        _seq(number * 10 + step).alias("_seq"),
        F.concat(F.lit("cdc/"), F.lpad((number * 31 % 64).cast("string"), 3, "0"), F.lit(".csv")).alias(
            "_source_file"
        ),
        F.concat(F.lit("2024-03-0"), step.cast("string"), F.lit(" 12:00:00+02:00")).alias("_ts"),
    )
    changes = _with_copies(_envelope(changes, "orders", False, F.col("_ts")), 9)
    return snapshot.unionByName(_assemble(changes, "orders"))


def raw_order_items(spark: SparkSession, folder: str) -> DataFrame:
    line = _table(spark, folder, "lineitem")
    number = F.col("l_linenumber").cast("string")
    price, freight = _money(F.col("l_extendedprice")), _money(F.col("l_quantity"))
    contents = F.concat_ws(
        "|", "l_orderkey", number, "l_partkey", "l_suppkey", price, freight, "l_returnflag", "l_linestatus"
    )
    items = line.select(
        F.concat(_text("l_orderkey"), F.lit(":"), number).alias("order_item_key"),
        _text("l_orderkey").alias("order_id"),
        number.alias("order_item_id"),
        F.concat(F.lit("p"), _text("l_partkey")).alias("product_id"),
        F.concat(F.lit("s"), _text("l_suppkey")).alias("seller_id"),
        F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit(" 00:00:00")).alias("shipping_limit_at"),
        price.alias("price"),
        freight.alias("freight_value"),
        F.when(F.col("l_returnflag") == "R", "D").when(F.col("l_linestatus") == "F", "U").otherwise("I").alias("_op"),
        _seq(identity.hex_slice(F.md5(contents), 1) + 1).alias("_seq"),
        F.concat(F.lit("cdc/"), F.lpad((F.col("l_partkey") % 64).cast("string"), 3, "0"), F.lit(".csv")).alias(
            "_source_file"
        ),
    )
    changes = _envelope(items, "order_items", False, F.concat(F.substring("shipping_limit_at", 1, 10), F.lit(" 09:00:00Z")))
    return _assemble(_with_copies(changes, 11), "order_items")


def raw_order_payments(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("o_orderkey")
    entries = F.sequence(F.lit(1), (number % 3).cast("int"))
    orders = _table(spark, folder, "orders").filter(number % 3 > 0).withColumn("_part", F.explode(entries))
    part = F.col("_part")
    total = F.col("o_totalprice").cast("decimal(14,2)")
    payments = orders.select(
        F.concat(_text("o_orderkey"), F.lit(":"), part.cast("string")).alias("payment_key"),
        _text("o_orderkey").alias("order_id"),
        part.cast("string").alias("payment_sequential"),
        F.when(part == 1, "credit_card").otherwise("voucher").alias("payment_type"),
        ((number % 10) + 1).cast("string").alias("payment_installments"),
        F.when(part == 1, (total - 10).cast("decimal(14,2)").cast("string")).otherwise("10.00").alias("payment_value"),
        F.lit("I").alias("_op"),
        F.lit("initial-load/order_payments/LOAD00000001.csv").alias("_source_file"),
    )
    taken = F.lit("2023-12-31 00:00:00")
    return _assemble(_envelope(payments, "order_payments", True, taken), "order_payments")


READERS = {
    "customers": raw_customers,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
}


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {table: read(spark, folder) for table, read in READERS.items()}
