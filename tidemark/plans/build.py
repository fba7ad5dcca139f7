"""Raw to published marts, gated by checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark import contract
from tidemark.operators import checks, history, joins
from tidemark.plans import layers, publish
from tidemark.session import small_splits
from tidemark.sources.warehouse import Warehouse


@dataclass(frozen=True)
class BuildResult:
    version: str
    raw_checks: list
    mart_checks: list


def build(
    warehouse: Warehouse,
    raw: Mapping[str, DataFrame] | None = None,
    allow: Sequence[str] = (),
    loads: Sequence[str] | None = None,
) -> BuildResult:
    """Rebuild and publish the five marts.

    1. One scan per raw table checks rows and casts; one shuffle per table finds
       conflicting copies.  A violation stops here.  One count finds customers
       with more events than a task should hold.
    2. Marts are written to a new version by the short route, which those
       checks make safe.  Order totals come from the written item and payment
       facts, so their raw events are folded once.
    3. Grain, reference, history and total checks read the written marts.  A
       violation leaves the previous version published.

    ``allow`` names checks whose violations are reported but do not stop a build.
    ``loads`` builds from these loads alone; the publication records which loads
    it holds, unless ``raw`` comes from elsewhere.
    """
    with small_splits(warehouse.spark):
        return _build(warehouse, raw, allow, loads)


def _build(
    warehouse: Warehouse, raw: Mapping[str, DataFrame] | None, allow: Sequence[str], loads: Sequence[str] | None
) -> BuildResult:
    known = None
    if raw is None:
        known = warehouse.loads()
        if loads is not None:
            known = warehouse.spark.createDataFrame([(i,) for i in loads], "load_id string")
        # Written down now: loads that arrive meanwhile are not part of it.
        known = warehouse.spark.createDataFrame(known.collect(), "load_id string")
        raw = warehouse.raw_tables(known)
    before = checks.gate(checks.raw_checks(raw), allow)
    slicing = history.Slicing.of(raw["customers"], "customer_id")
    live, version = layers.current_from_raw(raw), publish.new_version()
    first = {
        "dim_customers": live["customers"].select(*contract.SOURCE_COLUMNS["customers"]),
        "dim_customer_history": history.customer_history(raw["customers"], slicing),
        **layers.detail_marts(live),
    }
    written = publish.write_version(warehouse, first, version)
    orders = joins.fct_orders(live["orders"], written["fct_order_items"], written["fct_order_payments"])
    written |= publish.write_version(warehouse, {"fct_orders": orders}, version)
    after = checks.gate(checks.mart_checks(written), allow)
    publish.point_to(warehouse, written, version, known)
    return BuildResult(version, before, after)
