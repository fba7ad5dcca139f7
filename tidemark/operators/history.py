"""Type 2 history from a change log, for any key and attribute list.

Ordinary keys take one shuffle and one sort: every window below shares the same
partitioning and order.  Keys too big for a task go through order slices
instead and only the slice edges travel between tasks: find them once with
``Slicing.of`` and hand it to every step.  Planning a step runs no job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.functions import identity
from tidemark.operators import skew

ORDER = ("_source_order", "_event_id")


def _state(attributes: Sequence[str]) -> Column:
    """What a version is made of; compared null-safely, so NULL and '' differ."""
    return F.struct(*attributes, (F.col("_op") == "D").alias("_gone"))


def _first_change() -> Column:
    return F.min(F.when(~F.col("_is_snapshot"), F.col("_commit_at")))


def _unambiguous(first_change: Column) -> Column:
    # A snapshot taken after captured changes began may already contain one.
    return ~F.col("_is_snapshot") | first_change.isNull() | (F.col("_commit_at") < first_change)


def with_first_change(events: DataFrame, key: str, slicing: Slicing | None = None) -> DataFrame:
    """Events with ``first_cdc_at``, the first change commit of their key.

    An aggregate joined back, not a window: partial aggregation keeps a heavy
    key from meeting in one task, and so does the join.
    """
    first = events.groupBy(F.col(key).alias("_k")).agg(_first_change().alias("first_cdc_at"))
    heavy = slicing.heavy if slicing else None
    return skew.lookup_join(events, first, key, "_k", "left", heavy, null_safe=True).drop("_k")


def drop_ambiguous_snapshots(events: DataFrame) -> DataFrame:
    return events.filter(_unambiguous(F.col("first_cdc_at")))


@dataclass(frozen=True)
class Slicing:
    """The keys of an event table that are too big for one task, and how finely they are cut."""

    heavy: DataFrame | None
    slice_rows: int = skew.SLICE_ROWS
    grid: int = skew.GRID

    @classmethod
    def of(
        cls,
        events: DataFrame,
        key: str,
        heavy_rows: int = skew.HEAVY_ROWS,
        slice_rows: int = skew.SLICE_ROWS,
        grid: int = skew.GRID,
    ) -> Slicing:
        """Finds them with one partially aggregated count, now."""
        span = skew.order_span(*ORDER)
        found = skew.heavy_keys(events, key, heavy_rows, _first_change().alias("_first_change"), *span)
        return cls(skew.known(found), slice_rows, grid)

    def cut(self, events: DataFrame, key: str) -> DataFrame:
        return skew.order_slices(events, key, *ORDER, self.heavy, self.slice_rows, self.grid)


def detect_changes(
    events: DataFrame, key: str, attributes: Sequence[str], slicing: Slicing | None = None
) -> DataFrame:
    """Events that open a version: the first of their key, or a changed one."""
    if slicing is None or slicing.heavy is None:
        return _plain_changes(events, key, attributes)
    plain = _plain_changes(skew.without_keys(events, key, slicing.heavy), key, attributes)
    sliced = _sliced_changes(slicing.cut(events, key), attributes)
    return plain.unionByName(sliced.select(*events.columns))


def with_bounds(changes: DataFrame, key: str, slicing: Slicing | None = None) -> DataFrame:
    """Validity of each version in time and in sequence, open at the end."""
    if slicing is None or slicing.heavy is None:
        return _plain_bounds(changes, key)
    plain = _plain_bounds(skew.without_keys(changes, key, slicing.heavy), key)
    sliced = _sliced_bounds(slicing.cut(changes, key))
    return plain.unionByName(sliced.select(*plain.columns))


def _plain_changes(events: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*ORDER)
    before = events.withColumn("_now", _state(attributes)).withColumn("_before", F.lag("_now").over(w))
    return _only_changes(before).drop("_now", "_before")


def _plain_bounds(changes: DataFrame, key: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*ORDER)
    after = F.lead(F.struct("_commit_at", "_source_order")).over(w)
    return _bounds(changes.withColumn("_after", after)).drop("_after")


def _bounds(rows: DataFrame) -> DataFrame:
    return (
        rows.withColumn("observed_from", F.col("_commit_at"))
        .withColumn("observed_to", F.col("_after._commit_at"))
        .withColumn("source_order_from", F.col("_source_order"))
        .withColumn("source_order_to", F.col("_after._source_order"))
    )


def _only_changes(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col("_now")))


def _versions(bounded: DataFrame, key: str, attributes: Sequence[str], version: str) -> DataFrame:
    deleted = F.col("_op") == "D"
    return bounded.select(
        identity.version_id(key).alias(version),
        key,
        *attributes,
        "observed_from",
        "observed_to",
        "source_order_from",
        "source_order_to",
        deleted.alias("is_deleted"),
        F.col("_is_snapshot").alias("is_initial_snapshot"),
        (F.col("observed_to").isNull() & ~deleted).alias("is_current"),
    )


def _plain_history(events: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*ORDER)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    timed = events.withColumn("first_cdc_at", _first_change().over(whole))
    return _plain_bounds(_plain_changes(drop_ambiguous_snapshots(timed), key, attributes), key)


def _carry(edges: DataFrame, step) -> DataFrame:
    """The neighbouring slice's edge per (key, slice): one row per slice."""
    w = Window.partitionBy("_heavy_key").orderBy("_slice")
    return edges.select(
        F.col("_heavy_key").alias("_edge_key"),
        F.col("_slice").alias("_edge_slice"),
        step("_edge").over(w).alias("_carry"),
    )


def _join_carry(rows: DataFrame, carried: DataFrame) -> DataFrame:
    at = skew.same(F.col("_heavy_key"), F.col("_edge_key")) & (F.col("_slice") == F.col("_edge_slice"))
    return rows.join(carried, at, "left").drop("_edge_key", "_edge_slice")


SLICE = ("_heavy_key", "_slice")


def _sliced_changes(sliced: DataFrame, attributes: Sequence[str]) -> DataFrame:
    rows = sliced.withColumn("_now", _state(attributes))
    last = rows.groupBy(*SLICE).agg(F.max_by("_now", F.struct(*ORDER)).alias("_edge"))
    w = Window.partitionBy(*SLICE).orderBy(*ORDER)
    before = _join_carry(rows.withColumn("_lag", F.lag("_now").over(w)), _carry(last, F.lag))
    changes = _only_changes(before.withColumn("_before", F.coalesce("_lag", "_carry")))
    return changes.drop("_lag", "_carry", "_now", "_before")


def _sliced_bounds(changes: DataFrame) -> DataFrame:
    opening = F.struct("_commit_at", "_source_order")
    first = changes.groupBy(*SLICE).agg(F.min_by(opening, F.struct(*ORDER)).alias("_edge"))
    w = Window.partitionBy(*SLICE).orderBy(*ORDER)
    after = _join_carry(changes.withColumn("_lead", F.lead(opening).over(w)), _carry(first, F.lead))
    return _bounds(after.withColumn("_after", F.coalesce("_lead", "_carry"))).drop("_after", "_lead", "_carry")


def scd2_history(
    events: DataFrame,
    key: str,
    attributes: Sequence[str],
    version: str = "version_id",
    slicing: Slicing | None = None,
) -> DataFrame:
    """Versions of every key, deletion markers included.

    Delivered copies of one event carry equal state, so they never open a
    version; events may therefore come straight from raw.
    """
    columns = [key, *attributes, "_op", "_source_order", "_event_id", "_commit_at", "_is_snapshot"]
    events = events.select(*columns)
    if slicing is None or slicing.heavy is None:
        return _versions(_plain_history(events, key, attributes), key, attributes, version)
    plain = _plain_history(skew.without_keys(events, key, slicing.heavy), key, attributes)
    timed = slicing.cut(events, key).withColumnRenamed("_first_change", "first_cdc_at")
    sliced = _sliced_bounds(_sliced_changes(drop_ambiguous_snapshots(timed), attributes))
    return _versions(plain, key, attributes, version).unionByName(
        _versions(sliced, key, attributes, version)
    )


def customer_history(events: DataFrame, slicing: Slicing | None = None) -> DataFrame:
    return scd2_history(events, "customer_id", contract.CUSTOMER_ATTRIBUTES, "customer_version_id", slicing)
