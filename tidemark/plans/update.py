"""Marts brought up to date for the keys of new loads only.

Equal to a full rebuild: a touched key is folded again from all its raw events,
whatever order they came in, and every other row stays as published.  An order
is touched by its own events and by those of any item or payment that ever
named it.

Only buckets with a touched key are read, rewritten and checked: of raw where
``maintenance.compact`` has laid it out, of marts always.  Others are carried by
reference.  The one look beyond them is for orders whose customer is gone.

The loads to fold in are those that the published version does not hold; a
caller who names loads and leaves one of these out is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark import contract
from tidemark.operators import checks, history, joins, profiles
from tidemark.plans import layers, publish
from tidemark.plans.build import BuildResult
from tidemark.session import small_splits
from tidemark.sources import buckets
from tidemark.sources.warehouse import Warehouse


def touched_keys(warehouse: Warehouse, loads: Sequence[str]) -> dict[str, DataFrame]:
    """Primary keys of each table that the loads delivered events of."""
    chosen = warehouse.spark.createDataFrame([(i,) for i in loads], "load_id string")
    return {t: warehouse.raw(t, chosen).select(contract.primary_key(t)).distinct() for t in contract.TABLES}


def _only(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.join(keys, keys.columns[0], "left_semi")


def _merged(before: DataFrame, now: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``keys`` from ``now``, all others as they were."""
    return before.join(keys, keys.columns[0], "left_anti").select(*now.columns).unionByName(now)


class OmittedLoad(ValueError):
    """An update would have left out a committed load."""


def missing_loads(warehouse: Warehouse) -> list[str] | None:
    """Committed loads that the published marts lack; None where no record says."""
    known = publish.contained(warehouse)
    if known is None:
        return None
    # One short row for each load since the last publication.
    return sorted(r["load_id"] for r in warehouse.loads().join(known, "load_id", "left_anti").collect())


def update(warehouse: Warehouse, loads: Sequence[str] | None = None, allow: Sequence[str] = ()) -> BuildResult:
    """Publish marts that include all committed loads.

    Without ``loads``, what is missing is found from the record of
    publications.  Where there is none, the caller must name the loads, and the
    published version must hold everything before them.
    """
    with small_splits(warehouse.spark):
        return _update(warehouse, loads, allow)


def _update(warehouse: Warehouse, loads: Sequence[str] | None, allow: Sequence[str]) -> BuildResult:
    missing = missing_loads(warehouse)
    if missing is None and loads is None:
        raise LookupError("no record says which loads are published: build first or name the loads")
    if missing is not None:
        left = sorted(set(missing) - set(loads if loads is not None else missing))
        if left:
            raise OmittedLoad(f"loads are neither published nor named: {left[:5]}")
        loads = missing
    if not loads:
        return BuildResult(publish.current_versions(warehouse)["fct_orders"], [], [])
    at = publish.current(warehouse)
    count = warehouse.buckets
    if {at[m].buckets for m in contract.MARTS} != {count}:
        raise ValueError(f"the published marts are not laid out in {count} buckets: build again")
    keys = touched_keys(warehouse, loads)
    touched = {t: buckets.numbers(keys[t], count) for t in contract.TABLES}
    own = {t: _only(warehouse.raw(t, only=touched[t]), keys[t]) for t in contract.TABLES}
    gated = checks.gate(checks.raw_checks(own), allow)
    details = {t: layers.typed(own[t], t).select("order_id") for t in ("order_items", "order_payments")}
    orders = profiles.union_tables([keys["orders"], *details.values()]).distinct()
    of_orders = buckets.numbers(orders, count)
    all_of = {**own, "orders": _only(warehouse.raw("orders", only=of_orders), orders)}
    live = layers.current_from_raw(all_of)
    slicing = history.Slicing.of(own["customers"], "customer_id")
    changed = {
        "dim_customers": (live["customers"].select(*contract.SOURCE_COLUMNS["customers"]), keys["customers"]),
        "dim_customer_history": (history.customer_history(own["customers"], slicing), keys["customers"]),
        **{name: (df, keys[name.removeprefix("fct_")]) for name, df in layers.detail_marts(live).items()},
    }
    # A detail's rows, now and before, lie in buckets of orders that its events name.
    rewritten = {m: touched["customers"] if m.startswith("dim_") else of_orders for m in contract.MARTS}
    before = {m: publish.read_buckets(warehouse, m, at[m], rewritten[m]) for m in contract.MARTS}
    version = publish.new_version()
    first = {name: _merged(before[name], now, of) for name, (now, of) in changed.items()}
    written = publish.write_version(warehouse, first, version)
    facts = joins.fct_orders(live["orders"], _only(written["fct_order_items"], orders), _only(written["fct_order_payments"], orders))
    written |= publish.write_version(warehouse, {"fct_orders": _merged(before["fct_orders"], facts, orders)}, version)
    after = checks.gate(checks.mart_checks(written, _customer_references(warehouse, at, rewritten, written, keys["customers"])), allow)
    named = None
    if missing is not None:
        named = warehouse.spark.createDataFrame([(i,) for i in loads], "load_id string")
    publish.point_to(warehouse, written, version, named, rewritten)
    return BuildResult(version, gated, after)


def _customer_references(
    warehouse: Warehouse,
    at: dict[str, publish.Published],
    rewritten: dict[str, list[int]],
    written: dict[str, DataFrame],
    customers: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """Orders whose customer may be missing now, and all customers: a column of each."""

    def kept(mart: str) -> DataFrame:
        others = sorted(set(at[mart].versions) - set(rewritten[mart]))
        return publish.read_buckets(warehouse, mart, at[mart], others).select("customer_id")

    now = written["dim_customers"].select("customer_id")
    gone = customers.join(now, "customer_id", "left_anti")
    naming = written["fct_orders"].select("customer_id").unionByName(_only(kept("fct_orders"), gone))
    return naming, kept("dim_customers").unionByName(now)
