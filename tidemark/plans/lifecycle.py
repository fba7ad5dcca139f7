"""Report on the life of a set of orders and customers across all layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import joins, profiles


def _row(df: DataFrame, check: str, key: str, value) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.col(key).alias("key"), value.cast("string").alias("value"))


def lifecycle_report(
    raw: Mapping[str, DataFrame],
    staged: Mapping[str, DataFrame],
    marts: Mapping[str, DataFrame],
    orders: DataFrame,
    customers: DataFrame,
    sentinel: str = "ROLLBACK_SENTINEL",
) -> DataFrame:
    """``check, key, value`` for the given ``order_id`` and ``customer_id`` sets.

    Counts and latest values only: no event list is gathered per key, so a key
    with very many events costs no more than another.  ``lifecycle_events``
    returns the ordered events themselves.  Every input is limited to the wanted
    keys before it is aggregated.
    """
    wanted_orders = orders.select("order_id").distinct()
    wanted_customers = customers.select("customer_id").distinct()

    def of_orders(df: DataFrame) -> DataFrame:
        return df.join(wanted_orders, "order_id", "left_semi")

    def of_customers(df: DataFrame) -> DataFrame:
        return df.join(wanted_customers, "customer_id", "left_semi")

    facts = of_orders(marts["fct_orders"])
    detail = F.concat_ws(
        "|", "status", "item_total", "freight_total", "payment_total", "item_count", "payment_count"
    )
    status_steps = (
        of_orders(staged["orders"].filter(~F.col("_is_snapshot") & F.col("_op").isin("I", "U")))
        .groupBy("order_id", "status")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("order_id")
        .agg(F.concat_ws("|", F.count(F.lit(1)), F.sum("_n")).alias("_steps"))
    )
    versions = (
        of_customers(marts["dim_customer_history"])
        .groupBy("customer_id")
        .agg(
            F.concat_ws(
                "|", F.count(F.lit(1)), F.count_if("is_deleted"), F.count_if("is_current")
            ).alias("_versions")
        )
    )
    gone_orders = wanted_orders.join(marts["fct_orders"], "order_id", "left_anti")
    gone_customers = wanted_customers.join(marts["dim_customers"], "customer_id", "left_anti")
    unfinished = of_orders(raw["orders"].filter(F.col("status") == sentinel)).groupBy("order_id").agg(F.count(F.lit(1)).alias("_n"))
    cities = joins.orders_with_customer(facts.select("order_id", "customer_id"), marts["dim_customers"])
    operations = []
    for table, df in staged.items():
        own = of_customers(df) if table == "customers" else of_orders(df)
        changes = own.filter(~F.col("_is_snapshot")).groupBy("_op", "_event_id").agg(F.count(F.lit(1)).alias("_n"))
        counts = changes.groupBy("_op").agg(F.concat_ws("|", F.sum("_n"), F.count(F.lit(1))).alias("_count"))
        operations.append(_row(counts, f"{table}_operations", "_op", F.col("_count")))
    return profiles.union_tables(
        [
            _row(facts, "order_totals", "order_id", detail),
            _row(status_steps, "status_steps", "order_id", F.col("_steps")),
            _row(versions, "customer_versions", "customer_id", F.col("_versions")),
            _row(gone_orders, "order_absent", "order_id", F.lit("absent")),
            _row(gone_customers, "customer_absent", "customer_id", F.lit("absent")),
            _row(unfinished, "rolled_back_status", "order_id", F.col("_n")),
            _row(cities, "current_city", "order_id", F.col("city")),
            *operations,
        ]
    )


def lifecycle_events(
    staged: Mapping[str, DataFrame], marts: Mapping[str, DataFrame], orders: DataFrame, customers: DataFrame
) -> DataFrame:
    """``check, key, position, value``: a row per status change, city version and deletion flag of the wanted keys.

    ``position`` is the change sequence, so sorting by it gives the life of a key.
    """
    steps = staged["orders"].filter(~F.col("_is_snapshot")).join(orders.select("order_id").distinct(), "order_id", "left_semi")
    versions = marts["dim_customer_history"].join(customers.select("customer_id").distinct(), "customer_id", "left_semi")

    def placed(df: DataFrame, key: str, position: str, **values) -> DataFrame:
        # A row per check from one reading, however many checks.
        rows = [F.struct(F.lit(check).alias("check"), value.cast("string").alias("value")) for check, value in values.items()]
        told = df.select(F.col(key).alias("key"), F.col(position).alias("position"), F.inline(F.array(*rows)))
        return told.select("check", "key", "position", "value")

    return profiles.union_tables(
        [
            placed(steps, "order_id", "_source_order", status=F.concat_ws("|", "_op", "status")),
            placed(versions, "customer_id", "source_order_from", city=F.col("city"), deleted=F.col("is_deleted")),
        ]
    )
