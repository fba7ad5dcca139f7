"""Data-quality checks: each returns the violating rows, an empty result passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.functions import casts, identity
from tidemark.operators import compare, joins, profiles


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated non-null values with their number."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1)


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: Sequence[str]) -> Column:
    return ~F.col(column).isin(*values)


def lacks_source_key(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_null(column))


def check_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list; NULL is the not-null check's business."""
    return df.filter(not_accepted(column, values))


def check_source_key(df: DataFrame, column: str) -> DataFrame:
    return df.filter(lacks_source_key(column))


check_relationship = joins.orphans


def conflicting_copies(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Event ids delivered with differing contents; the file name may differ.

    Two digests of the contents, nulls marked, have one value for an id unless
    copies differ.  Their extremes are numbers, so this is one hash aggregate,
    partially done before its shuffle, however often an id was delivered.
    """
    parts = []
    for table, df in raw.items():
        names = [c for c in contract.raw_columns(table) if c not in ("_event_id", "_source_file")]
        marked = [x for c in names for x in (F.col(c).isNull(), F.col(c))]
        digests = {"_a": F.xxhash64(F.lit(1), *marked), "_b": F.xxhash64(F.lit(2), *reversed(marked))}
        hashed = df.select("_event_id", *[v.alias(k) for k, v in digests.items()])
        extremes = [f(k).alias(f"{k}_{f.__name__}") for k in digests for f in (F.min, F.max)]
        differs = (F.col("_a_min") != F.col("_a_max")) | (F.col("_b_min") != F.col("_b_max"))
        differing = hashed.groupBy("_event_id").agg(*extremes).filter(differs)
        parts.append(differing.select(F.lit(table).alias("source_table"), "_event_id"))
    return profiles.union_tables(parts)


def history_vs_dimension(
    dimension: DataFrame,
    history: DataFrame,
    key: str = "customer_id",
    attributes: Sequence[str] = contract.CUSTOMER_ATTRIBUTES,
) -> DataFrame:
    """Keys whose open version and dimension row are not the same."""
    active = history.filter(F.col("is_current"))
    columns = [key, *attributes]
    differing = compare.signed_difference(dimension, active, columns).select(key)
    # A missing key can match nothing, not even another missing key.
    keyless = dimension.select(key).unionByName(active.select(key)).filter(is_null(key))
    return differing.unionByName(keyless).distinct()


def check_intervals(history: DataFrame, version: str = "customer_version_id") -> DataFrame:
    backwards = (F.col("source_order_to") <= F.col("source_order_from")) | (
        F.col("observed_to") < F.col("observed_from")
    )
    return history.filter(backwards).select(version)


def order_totals_mismatches(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders whose stored totals differ from their facts, aggregated again."""
    compared = ("item_total", "freight_total", "payment_total", "item_count", "payment_count")
    stored = orders.select("order_id", *compared)
    sides = [totals.toDF(*[f"_{c}" for c in totals.columns]) for totals in (profiles.item_totals(items), profiles.payment_totals(payments))]
    for side in sides:
        side_key = side.columns[0]
        stored = stored.join(side, F.col("order_id") == F.col(side_key), "left").drop(side_key)
    differs = F.lit(False)
    for column in compared:
        differs = differs | (F.col(column) != F.coalesce(F.col(f"_{column}"), F.lit(0)))
    return stored.filter(differs).select("order_id")


def check_row_key(df: DataFrame, key: str, parent: str, part: str) -> DataFrame:
    """Rows whose derived key is not ``parent:part``."""
    return df.filter(F.col(key) != identity.row_key(F.col(parent), F.col(part)))


def check_pair_unique(df: DataFrame, *columns: str) -> DataFrame:
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1)


# What the source schema declares for each table.
SOURCE_NOT_NULL = {
    "customers": ("customer_id", "customer_unique_id", "updated_at"),
    "orders": ("order_id", "customer_id", "status", "purchased_at", "updated_at"),
    "order_items": (
        "order_item_key",
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_at",
        "price",
        "freight_value",
        "updated_at",
    ),
    "order_payments": (
        "payment_key",
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
        "updated_at",
    ),
}
SOURCE_REFERENCES = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_payments", "order_id", "orders", "order_id"),
)
SOURCE_PAIRS = {
    "order_items": ("order_item_key", "order_id", "order_item_id"),
    "order_payments": ("payment_key", "order_id", "payment_sequential"),
}


@dataclass(frozen=True)
class Check:
    """A named check; ``violations`` is a one-row DataFrame with a count."""

    name: str
    model: str
    column: str
    violations: DataFrame


def _counted(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations"))


def row_checks(df: DataFrame, model: str, rules: Mapping[tuple[str, str], Column]) -> DataFrame:
    """All row-level rules of one table in a single scan.

    Returns check, model, column, violations.
    """
    counts = [F.count_if(rule).alias(f"_{i}") for i, rule in enumerate(rules.values())]
    entries = [
        F.struct(
            F.lit(name).alias("check"),
            F.lit(model).alias("model"),
            F.lit(column).alias("column"),
            F.col(f"_{i}").alias("violations"),
        )
        for i, (name, column) in enumerate(rules)
    ]
    return df.agg(*counts).select(F.explode(F.array(*entries)).alias("_c")).select("_c.*")


def staging_rules(table: str) -> dict[tuple[str, str], Column]:
    key = contract.primary_key(table)
    return {
        ("not_null", "_event_id"): is_null("_event_id"),
        ("not_null", "_source_order"): is_null("_source_order"),
        ("accepted_values", "_op"): not_accepted("_op", contract.OPERATIONS),
        ("required_source_key", key): lacks_source_key(key),
    }


def cast_rules(table: str) -> dict[tuple[str, str], Column]:
    """Raw text that its staged type would refuse."""
    bad = {c: casts.bad_value(c) for c in contract.source_columns(table)}
    return {("castable", c): rule for c, rule in bad.items() if rule is not None}


def counted(name: str, model: str, column: str, violations: DataFrame) -> DataFrame:
    """A violating-rows result as one summary row."""
    return _counted(violations).select(
        F.lit(name).alias("check"), F.lit(model).alias("model"), F.lit(column).alias("column"), "violations"
    )


def key_checks(df: DataFrame, model: str, key: str, required: Sequence[str]) -> DataFrame:
    """Uniqueness of ``key`` and nulls in ``required`` columns, from one aggregate per key."""
    nulls = [F.count_if(is_null(c)).alias(f"_null_{c}") for c in required]
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"), *nulls)
    repeated = F.count_if((F.col("_copies") > 1) & F.col(key).isNotNull()).alias("_repeated")
    totals = per_key.agg(repeated, *[F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"_null_{c}") for c in required])

    def row(check: str, column: str, value: str) -> Column:
        return F.struct(
            F.lit(check).alias("check"), F.lit(model).alias("model"), F.lit(column).alias("column"), F.col(value).alias("violations")
        )

    rows = [row("unique", key, "_repeated"), *(row("not_null", c, f"_null_{c}") for c in required)]
    return totals.select(F.inline(F.array(*rows)))


def staging_checks(raw: Mapping[str, DataFrame], staged: Mapping[str, DataFrame]) -> DataFrame:
    """Checks that must pass before marts are built."""
    parts = []
    for table, df in staged.items():
        model = f"stg_{table}"
        parts.append(counted("unique", model, "_event_id", check_unique(df, "_event_id")))
        parts.append(row_checks(df, model, staging_rules(table)))
    conflicts = counted("conflicting_event_copies", "raw", "_event_id", conflicting_copies(raw))
    return profiles.union_tables([*parts, conflicts])


def raw_checks(raw: Mapping[str, DataFrame]) -> DataFrame:
    """The staging gate evaluated on raw rows.

    A row rule that holds for every delivered copy holds for the copy that is
    kept, so nothing has to be deduplicated first: one scan per table for the
    rules and casts, one shuffle for conflicts.  Event ids are unique after
    dedup by construction.
    """
    parts = [
        row_checks(df, f"stg_{table}", {**staging_rules(table), **cast_rules(table)})
        for table, df in raw.items()
    ]
    conflicts = counted("conflicting_event_copies", "raw", "_event_id", conflicting_copies(raw))
    return profiles.union_tables([*parts, conflicts])


def mart_checks(marts: Mapping[str, DataFrame], customer_references: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Checks on published grains, references, history and totals.

    ``marts`` may be the buckets of an update.  Orders and customers lie in
    buckets of different numbers, so ``customer_references`` then holds the
    orders whose customer is to be looked up, and all customers.
    """
    customers, history = marts["dim_customers"], marts["dim_customer_history"]
    orders, items, payments = marts["fct_orders"], marts["fct_order_items"], marts["fct_order_payments"]
    unique = {
        "dim_customers": "customer_id",
        "dim_customer_history": "customer_version_id",
        "fct_orders": "order_id",
        "fct_order_items": "order_item_key",
        "fct_order_payments": "payment_key",
    }
    required = {
        "dim_customers": ("customer_id",),
        "dim_customer_history": ("customer_version_id",),
        "fct_orders": ("order_id", "customer_id"),
        "fct_order_items": ("order_item_key", "order_id"),
        "fct_order_payments": ("payment_key", "order_id"),
    }
    parts = [key_checks(marts[m], m, c, required[m]) for m, c in unique.items()]
    naming, named = customer_references or (orders, customers)
    for model, child, column, parent, parent_key in (
        ("fct_orders", naming, "customer_id", named, "customer_id"),
        ("fct_order_items", items, "order_id", orders, "order_id"),
        ("fct_order_payments", payments, "order_id", orders, "order_id"),
    ):
        missing = joins.orphan_keys(child, column, parent, parent_key)
        total = missing.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("violations"))
        parts.append(
            total.select(
                F.lit("relationships").alias("check"),
                F.lit(model).alias("model"),
                F.lit(column).alias("column"),
                "violations",
            )
        )
    parts.append(
        counted(
            "history_matches_dimension",
            "dim_customer_history",
            "customer_id",
            history_vs_dimension(customers, history),
        )
    )
    parts.append(counted("history_intervals", "dim_customer_history", "customer_version_id", check_intervals(history)))
    parts.append(
        counted("order_totals", "fct_orders", "order_id", order_totals_mismatches(orders, items, payments))
    )
    return profiles.union_tables(parts)


def constraint_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Primary keys, pairs, references, derived keys and not-null of source tables."""
    parts = []
    for table, df in tables.items():
        key = contract.primary_key(table)
        parts.append(counted("primary_key", table, key, check_unique(df, key)))
        parts.append(
            row_checks(df, table, {("not_null", c): is_null(c) for c in SOURCE_NOT_NULL[table] if c in df.columns})
        )
    for table, (key, parent, part) in SOURCE_PAIRS.items():
        parts.append(counted("unique_pair", table, f"{parent},{part}", check_pair_unique(tables[table], parent, part)))
        parts.append(counted("derived_key", table, key, check_row_key(tables[table], key, parent, part)))
    for table, column, parent, parent_key in SOURCE_REFERENCES:
        missing = joins.orphan_keys(tables[table], column, tables[parent], parent_key)
        total = missing.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("violations"))
        parts.append(
            total.select(
                F.lit("foreign_key").alias("check"),
                F.lit(table).alias("model"),
                F.lit(column).alias("column"),
                "violations",
            )
        )
    return profiles.union_tables(parts)


class CheckFailure(RuntimeError):
    """A gate found violations; ``failures`` lists the failing checks."""

    def __init__(self, failures):
        self.failures = failures
        names = ", ".join(f"{r['check']}({r['model']}.{r['column']})={r['violations']}" for r in failures)
        super().__init__(f"data checks failed: {names}")


def gate(results: DataFrame, allow: Sequence[str] = ()) -> list:
    """Raise when a check has violations.  Only summary rows reach the driver."""
    rows = results.collect()
    failures = [r for r in rows if r["violations"] and r["check"] not in allow]
    if failures:
        raise CheckFailure(failures)
    return rows
