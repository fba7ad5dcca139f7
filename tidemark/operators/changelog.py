"""Delivery dedup, current state and timelines of a change log.

Ranks keep one row per key, so Spark plans a group limit before the shuffle:
however many copies one key has, each map task sends one of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract


def _tie_breakers(df: DataFrame, used: Iterable[str]) -> list[str]:
    """Remaining columns, so that the kept row never depends on arrival order."""
    taken = set(used)
    return [c for c in df.columns if c not in taken]


def deduplicate_events(raw: DataFrame) -> DataFrame:
    """One row per ``_event_id``: the copy from the first source file by name."""
    order = ["_source_file", *_tie_breakers(raw, ("_event_id", "_source_file"))]
    rank = F.row_number().over(Window.partitionBy("_event_id").orderBy(*order))
    return raw.withColumn("_delivery", rank).filter(F.col("_delivery") == 1).drop("_delivery")


def latest_per_key(events: DataFrame, key: str) -> DataFrame:
    """The newest event of each key, deletions included.

    ``_source_file`` comes last in the order, so delivered copies may still be
    present: the copy kept is the one ``deduplicate_events`` keeps.  Copies left
    equal by these three are the same event; ordering by more columns would
    only force all of them through the shuffle.
    """
    order = [F.desc("_source_order"), F.desc("_event_id"), F.asc("_source_file")]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return events.withColumn("_state", rank).filter(F.col("_state") == 1).drop("_state")


def current_state(events: DataFrame, key: str) -> DataFrame:
    """Rows alive now.  Deletions are dropped only after ranking: dropping them
    first would bring older rows back."""
    return latest_per_key(events, key).filter(F.col("_op") != "D")


def live_rows(events: DataFrame, table: str) -> DataFrame:
    """Current state of a contract table with source columns only."""
    state = current_state(events, contract.primary_key(table))
    return state.select(*contract.source_columns(table))


def timeline(events: DataFrame, key: str, *columns: str) -> DataFrame:
    """Change events (snapshots excluded) of every key in sequence order.

    A range-partitioned sort: a key with very many events spreads over several
    partitions, which a collected list per key would not.
    """
    changes = events.filter(~F.col("_is_snapshot"))
    return changes.select(key, "_source_order", "_event_id", *columns).orderBy(
        key, "_source_order", "_event_id"
    )
