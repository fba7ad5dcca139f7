"""Aggregates that describe change logs and marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import contract


def union_tables(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _money_sum(column: str):
    return F.sum(column).cast(contract.TOTAL_TYPE)


def item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        _money_sum("price").alias("item_total"),
        _money_sum("freight_value").alias("freight_total"),
        F.count(F.lit(1)).alias("item_count"),
    )


def payment_totals(payments: DataFrame) -> DataFrame:
    """Entry values summed once each, whatever their number of instalments."""
    return payments.groupBy("order_id").agg(
        _money_sum("payment_value").alias("payment_total"),
        F.count(F.lit(1)).alias("payment_count"),
    )


def delivery_profile(raw: Mapping[str, DataFrame], staged: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: deliveries, distinct events, top sequence, and staged rows."""
    parts = []
    for table in raw:
        delivered = raw[table].select(
            F.lit("raw").alias("layer"), F.lit(table).alias("source_table"), "_event_id", "_source_order"
        )
        typed = staged[table].select(
            F.lit("staged").alias("layer"), F.lit(table).alias("source_table"), "_event_id", "_source_order"
        )
        parts += [delivered, typed]
    # Counting per event first gives an exact distinct count with partial
    # aggregation at both levels, also when one event was delivered very often.
    per_event = (
        union_tables(parts)
        .groupBy("source_table", "_event_id")
        .agg(
            F.count_if(F.col("layer") == "raw").alias("_raw"),
            F.count_if(F.col("layer") == "staged").alias("_staged"),
            F.max(F.when(F.col("layer") == "raw", F.col("_source_order"))).alias("_order"),
        )
    )
    profile = per_event.groupBy("source_table").agg(
        F.sum("_raw").alias("raw_rows"),
        F.count_if(F.col("_raw") > 0).alias("unique_events"),
        F.max("_order").alias("max_order"),
        F.sum("_staged").alias("staged_rows"),
        F.count_if(F.col("_staged") > 0).alias("staged_unique"),
    )
    agree = (F.col("staged_rows") == F.col("unique_events")) & (
        F.col("staged_unique") == F.col("unique_events")
    )
    return profile.withColumn("staged_is_unique", agree)


def operation_counts(staged: DataFrame, *by: str) -> DataFrame:
    """Captured operations, with distinct events beside rows."""
    return (
        staged.filter(~F.col("_is_snapshot"))
        .groupBy(*by, "_op")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.countDistinct("_event_id").alias("unique_events"),
        )
    )


def order_gap_profile(orders: DataFrame) -> DataFrame:
    """Orders lacking details, and detail totals at order grain."""
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(~F.col("has_items")).alias("without_items"),
        F.count_if(~F.col("has_payments")).alias("without_payments"),
        *[
            F.sum(c).cast("decimal(28,2)").alias(c)
            for c in ("item_total", "freight_total", "payment_total")
        ],
    )


def people_vs_records(customers: DataFrame) -> DataFrame:
    """Customer records against distinct people, exactly."""
    per_person = customers.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("_records"))
    return per_person.agg(
        F.coalesce(F.sum("_records"), F.lit(0)).alias("customer_records"),
        F.count("customer_unique_id").alias("people"),
    )


def mart_counts(marts: Mapping[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("mart"), "row_count")
        for name, df in marts.items()
    ]
    return union_tables(counted)
