"""Joins between facts, dimensions, ledgers and load intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.operators import profiles, skew


def fct_orders(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with detail totals.

    Each detail side is aggregated first: joining two items with two payments
    would make four rows, and an order with very many details would meet its
    copies in one task.  All three inputs end up hashed on ``order_id``.
    """
    columns = [c for c in contract.SOURCE_COLUMNS["orders"]]
    by_item = profiles.item_totals(items).withColumnRenamed("order_id", "_item_order")
    by_payment = profiles.payment_totals(payments).withColumnRenamed("order_id", "_payment_order")
    joined = orders.join(by_item, F.col("order_id") == F.col("_item_order"), "left").join(
        by_payment, F.col("order_id") == F.col("_payment_order"), "left"
    )

    def total(column: str):
        return F.coalesce(F.col(column), F.lit(0)).cast(contract.TOTAL_TYPE)

    return joined.select(
        *columns,
        total("item_total").alias("item_total"),
        total("freight_total").alias("freight_total"),
        (total("item_total") + total("freight_total")).cast(contract.TOTAL_TYPE).alias("order_total"),
        F.coalesce("item_count", F.lit(0)).cast("long").alias("item_count"),
        total("payment_total").alias("payment_total"),
        F.coalesce("payment_count", F.lit(0)).cast("long").alias("payment_count"),
        F.col("_item_order").isNotNull().alias("has_items"),
        F.col("_payment_order").isNotNull().alias("has_payments"),
    )


def orders_with_customer(
    orders: DataFrame, customers: DataFrame, heavy: DataFrame | None = None
) -> DataFrame:
    """Every order beside its customer as of now, old orders included.

    One customer may own a large share of the orders: see ``skew.lookup_join``
    for ``heavy``.
    """
    attributes = customers.select(
        F.col("customer_id").alias("_dim_customer"), *contract.SOURCE_COLUMNS["customers"][1:]
    )
    joined = skew.lookup_join(orders, attributes, "customer_id", "_dim_customer", "inner", heavy)
    return joined.drop("_dim_customer")


def orphans(
    child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str, heavy: DataFrame | None = None
) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    referring = child.filter(F.col(foreign_key).isNotNull())
    return skew.lookup_join(referring, keys, foreign_key, "_parent_key", "left_anti", heavy)


def orphan_keys(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Missing parents with the number of rows that point at them.

    Child keys are counted before the join, so a key that half of the children
    share travels as one row.
    """
    counted = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key)
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    return counted.agg(F.count(F.lit(1)).alias("child_rows")).join(
        keys, F.col(foreign_key) == F.col("_parent_key"), "left_anti"
    )


def pending_files(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger does not know yet; only names are compared."""
    done = ledger.select(F.col("source_file").alias("_done"))
    return manifest.join(done, F.col("path") == F.col("_done"), "left_anti")


def known_events(new: DataFrame, raw: DataFrame) -> DataFrame:
    """Distinct event ids of ``new`` with whether raw already holds them.

    Both sides are reduced to distinct ids in one aggregate; nothing is joined.
    """
    tagged = new.select("_event_id", F.lit(1).alias("_new"), F.lit(0).alias("_old")).unionByName(
        raw.select("_event_id", F.lit(0).alias("_new"), F.lit(1).alias("_old"))
    )
    merged = tagged.groupBy("_event_id").agg(F.max("_new").alias("_new"), F.max("_old").alias("_old"))
    return merged.filter(F.col("_new") == 1).select("_event_id", (F.col("_old") == 1).alias("known"))


def commits_inside_load(commits: DataFrame, loads: DataFrame) -> DataFrame:
    """Commits with ``inside_load``: start < before <= after < end of their table's load.

    ``commits``: source_table, before_commit, after_commit, ...; ``loads``:
    source_table, load_start, load_end with one row per table.  An equality on
    the table keeps this a hash join; Spark broadcasts the small side by size.
    """
    bounds = loads.select(F.col("source_table").alias("_load_table"), "load_start", "load_end")
    joined = commits.join(bounds, F.col("source_table") == F.col("_load_table"), "left")
    inside = (
        (F.col("load_start") < F.col("before_commit"))
        & (F.col("before_commit") <= F.col("after_commit"))
        & (F.col("after_commit") < F.col("load_end"))
    )
    return joined.withColumn("inside_load", F.coalesce(inside, F.lit(False))).drop(
        "_load_table", "load_start", "load_end"
    )


_PART = 1000


def missing_overlap_events(commits: DataFrame, staged: DataFrame) -> DataFrame:
    """Expected I, U and D events of each commit that are not staged exactly once, a row for each commit.

    Both sides are counted before they meet, so very many commits that name one
    key are one row in the join; their rows are made again after it.

    ``commits``: inserted, updated, deleted (customer ids) and city; the U must
    also carry that city.
    """
    no_city = F.lit(None).cast("string")
    expected = commits.select(
        F.explode(
            F.array(
                F.struct(F.lit("I").alias("_op"), F.col("inserted").alias("customer_id"), no_city.alias("city")),
                F.struct(F.lit("U").alias("_op"), F.col("updated").alias("customer_id"), F.col("city").alias("city")),
                F.struct(F.lit("D").alias("_op"), F.col("deleted").alias("customer_id"), no_city.alias("city")),
            )
        ).alias("_e")
    ).select("_e.*")
    found = (
        staged.filter(~F.col("_is_snapshot"))
        .groupBy(
            F.col("_op").alias("_f_op"),
            F.col("customer_id").alias("_f_key"),
            F.when(F.col("_op") == "U", F.col("city")).alias("_f_city"),
        )
        .agg(F.count(F.lit(1)).alias("_found"))
    )
    match = (
        (F.col("_op") == F.col("_f_op"))
        & (F.col("customer_id") == F.col("_f_key"))
        & skew.same(F.col("city"), F.col("_f_city"))
    )
    staged_events = F.coalesce(F.col("_found"), F.lit(0)).alias("staged_events")
    counted = expected.groupBy("_op", "customer_id", "city").agg(F.count(F.lit(1)).alias("_commits"))
    wrong = counted.join(found, match, "left").select("_op", "customer_id", "city", staged_events, "_commits")
    # In parts, so that no row holds a list as long as the commits of a key.
    part = F.explode(F.sequence(F.lit(0), F.floor((F.col("_commits") - 1) / _PART))).alias("_part")
    parts = wrong.filter("staged_events <> 1").select("*", part)
    size = F.least(F.lit(_PART), F.col("_commits") - F.col("_part") * _PART)
    return parts.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size))).drop("_commits", "_part", "_copy")
