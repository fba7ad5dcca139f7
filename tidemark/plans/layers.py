"""Raw to staging to current state to marts, as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark import contract
from tidemark.functions import casts
from tidemark.operators import changelog, history, joins


def typed(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[casts.staged(c) for c in contract.source_columns(table)], *contract.ENVELOPE)


def stage(raw: DataFrame, table: str) -> DataFrame:
    """One typed row per distinct event."""
    return typed(changelog.deduplicate_events(raw.select(*contract.raw_columns(table))), table)


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {table: stage(df, table) for table, df in raw.items()}


def current(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {table: changelog.live_rows(df, table) for table, df in staged.items()}


def current_from_raw(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Current state with dedup and ranking folded into one shuffle per table.

    Ranking delivered copies by (sequence, event id, file) keeps exactly the row
    that dedup-then-rank keeps, provided copies of an id agree.  That is what the
    conflict check establishes, so run it first.  Values are cast after ranking.
    """
    return {table: current_table_from_raw(df, table) for table, df in raw.items()}


def current_table_from_raw(raw: DataFrame, table: str) -> DataFrame:
    kept = changelog.current_state(raw.select(*contract.raw_columns(table)), contract.primary_key(table))
    return typed(kept, table).select(*contract.source_columns(table))


def detail_marts(live: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Item and payment facts: current details without the audit time."""
    return {
        f"fct_{t}": live[t].select(*contract.SOURCE_COLUMNS[t]) for t in ("order_items", "order_payments")
    }


def marts_from(live: Mapping[str, DataFrame], customer_events: DataFrame, slicing: history.Slicing | None = None) -> dict[str, DataFrame]:
    """The five marts from current state and the customer change log."""
    return {
        "dim_customers": live["customers"].select(*contract.SOURCE_COLUMNS["customers"]),
        "dim_customer_history": history.customer_history(customer_events, slicing),
        "fct_orders": joins.fct_orders(live["orders"], live["order_items"], live["order_payments"]),
        **detail_marts(live),
    }


def marts(raw: Mapping[str, DataFrame], slicing: history.Slicing | None = None) -> dict[str, DataFrame]:
    """Marts by the layered route: stage, then fold."""
    staged = stage_all(raw)
    return marts_from(current(staged), staged["customers"], slicing)


def marts_from_raw(raw: Mapping[str, DataFrame], slicing: history.Slicing | None = None) -> dict[str, DataFrame]:
    """Marts by the short route, for raw that has passed the conflict check."""
    return marts_from(current_from_raw(raw), raw["customers"], slicing)


def mart_from_raw(raw: Mapping[str, DataFrame], mart: str, slicing: history.Slicing | None = None) -> DataFrame:
    """One of ``marts_from_raw``; asks ``raw`` for no table that this mart does not need."""
    if mart == "dim_customer_history":
        return history.customer_history(raw["customers"], slicing)
    live = {table: current_table_from_raw(raw[table], table) for table in contract.MART_TABLES[mart]}
    if mart == "fct_orders":
        return joins.fct_orders(live["orders"], live["order_items"], live["order_payments"])
    ((table, df),) = live.items()
    return df.select(*contract.SOURCE_COLUMNS[table])


def register_views(spark: SparkSession, raw: Mapping[str, DataFrame]) -> list[str]:
    """Temporary views stg_*, int_*_current, int_customer_history and the marts."""
    staged = stage_all(raw)
    live = current(staged)
    views = {f"stg_{t}": df for t, df in staged.items()}
    views |= {f"int_{t}_current": df for t, df in live.items()}
    views |= marts_from(live, staged["customers"])
    views["int_customer_history"] = views["dim_customer_history"]
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
