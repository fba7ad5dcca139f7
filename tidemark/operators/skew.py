"""Keys too big for one task, and how to slice them by order.

A window over ``partitionBy(key)`` sends a whole key to one task.  When one key
holds a large share of the table that task never ends.  ``heavy_keys`` finds
such keys with one partially aggregated count, ``known`` runs it, once, for all
operators over the same input; planning an operator itself runs nothing.
``order_slices`` cuts heavy keys into consecutive ranges of the event order, so
that every (key, slice) group is small and slices keep that order.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key above this many rows is sliced.  There are at most rows/HEAVY_ROWS of
# them, which bounds every broadcast below (1e12 rows: 200,000 short rows).
HEAVY_ROWS = 5_000_000
SLICE_ROWS = 2_000_000
# Resolution of the quantile grid behind the slices of one key.
GRID = 10_000


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def heavy_keys(df: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS, *extra: Column) -> DataFrame:
    """``_heavy_key, _rows`` (and ``extra`` aggregates) of keys above ``heavy_rows``."""
    sizes = df.groupBy(F.col(key).alias("_heavy_key")).agg(F.count(F.lit(1)).alias("_rows"), *extra)
    return sizes.filter(F.col("_rows") > heavy_rows)


def known(heavy: DataFrame) -> DataFrame | None:
    """The rows of ``heavy`` found now, by one job, or None when there are none.

    At most rows/HEAVY_ROWS short rows reach the driver.
    """
    rows = heavy.collect()
    return heavy.sparkSession.createDataFrame(rows, heavy.schema) if rows else None


def without_keys(df: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    # Bounded by HEAVY_ROWS (see above), so a broadcast keeps heavy rows out of
    # the shuffle altogether.
    keys = F.broadcast(heavy.select("_heavy_key"))
    return df.join(keys, same(F.col(key), F.col("_heavy_key")), "left_anti")


def lookup_join(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    how: str = "inner",
    heavy: DataFrame | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join to a table with one row per key, whatever share of rows a key holds.

    AQE splits a skewed sort-merge join only when both inputs come straight from
    a shuffle, which a windowed or aggregated dimension does not.  So rows of
    ``heavy`` keys (``known(heavy_keys(...))`` of the facts) stay where they are
    and meet a broadcast of just those keys' dimension rows, of which there are
    at most rows/HEAVY_ROWS; all others join by shuffle.
    """
    left, right = F.col(fact_key), F.col(dimension_key)
    match = same(left, right) if null_safe else left == right
    if heavy is None:
        return facts.join(dimension, match, how)
    keys = F.broadcast(heavy.select("_heavy_key"))
    few = dimension.join(keys, same(right, F.col("_heavy_key")), "left_semi")
    many = facts.join(keys, same(left, F.col("_heavy_key")), "left_semi")
    rest = without_keys(facts, fact_key, heavy)
    return rest.join(dimension, match, how).unionByName(many.join(F.broadcast(few), match, how))


# Characters of a tie's text that make its fraction, after what all texts of the key share.
_TIE_BYTES = 6


def order_span(order: str, tie: str) -> list[Column]:
    """What ``order_slices`` needs to know of a heavy key, as aggregates."""
    return [F.min(order).alias("_low"), F.min(tie).alias("_first_tie"), F.max(tie).alias("_last_tie")]


def _rank(order: str, tie: str) -> Column:
    """A double that never falls along (order, tie) within a key.

    Distances from the key's lowest sequence are exact for neighbouring numbers
    of any length; equal ones are told apart by the text of the tie.
    """
    upto = F.least(F.length("_first_tie"), F.length("_last_tie"))
    shared = F.aggregate(
        F.when(upto > 0, F.sequence(F.lit(1), upto)).otherwise(F.array().cast("array<int>")),
        F.lit(0),
        lambda n, i: F.when((n == i - 1) & (F.substring("_first_tie", F.lit(1), i) == F.substring("_last_tie", F.lit(1), i)), i).otherwise(n),
    )
    differing = F.substring(F.col(tie).cast("binary"), F.octet_length(F.substring("_first_tie", F.lit(1), shared)) + 1, F.lit(_TIE_BYTES))
    digits = F.rpad(F.hex(differing), 2 * _TIE_BYTES, "0")
    fraction = F.conv(digits, 16, 10).cast("double") / float(1 << 8 * _TIE_BYTES)
    return (F.col(order) - F.col("_low")).cast("double") + F.coalesce(fraction, F.lit(0.0))


def order_slices(
    df: DataFrame,
    key: str,
    order: str,
    tie: str,
    heavy: DataFrame,
    slice_rows: int = SLICE_ROWS,
    grid: int = GRID,
) -> DataFrame:
    """Rows of the heavy keys with ``_slice``, plus the columns of ``heavy``.

    ``heavy`` has the aggregates of ``order_span``.  Boundaries are approximate
    quantiles of (order, tie) per key, at most one per ``slice_rows`` rows; only
    their balance is approximate, never the result.  A grid tells ``grid``
    slices apart, so a key that needs more is cut twice: into parts for which
    half a grid suffices, then each part by a grid of its own.
    """
    rows = df.join(F.broadcast(heavy), same(F.col(key), F.col("_heavy_key")), "inner").withColumn("_rank", _rank(order, tie))
    many = F.ceil(F.col("_rows") / slice_rows) > grid
    parted = _cut(rows, rows.filter(many), ["_heavy_key"], "_part", slice_rows * max(grid // 2, 1), grid)
    sliced = _cut(parted, parted, ["_heavy_key", "_part"], "_fine", slice_rows, grid)
    return sliced.withColumn("_slice", F.col("_part") * (grid + 1) + F.col("_fine")).drop(
        "_part", "_fine", "_rank", "_low", "_first_tie", "_last_tie"
    )


def _cut(rows: DataFrame, counted: DataFrame, by: list[str], name: str, size: int, grid: int) -> DataFrame:
    """``rows`` with the number ``name`` of their range of ``_rank`` among those of ``by``; 0 for groups not in ``counted``."""
    # One text literal plans much faster than an array of thousands of numbers.
    quantiles = " ".join(str(i / grid) for i in range(1, grid))
    sketch = F.expr(
        f"percentile_approx(_rank, cast(split('{quantiles}', ' ') as array<double>), {grid * 10})"
    )
    wanted = F.least(F.lit(grid), F.ceil(F.col("_n") / size)).cast("int")
    picks = F.when(wanted > 1, F.sequence(F.lit(1), wanted - 1)).otherwise(F.array().cast("array<int>"))
    bounds = (
        counted.groupBy(*[F.col(c).alias(f"_of{c}") for c in by])
        .agg(sketch.alias("_grid"), F.count(F.lit(1)).alias("_n"))
        .select(
            *[f"_of{c}" for c in by],
            F.transform(
                picks,
                lambda i: F.element_at("_grid", F.greatest(F.lit(1), F.floor(i * grid / wanted).cast("int"))),
            ).alias("_bounds"),
        )
    )
    # One row per group and one number per slice: bounded by rows/SLICE_ROWS.
    at = functools.reduce(Column.__and__, [same(F.col(c), F.col(f"_of{c}")) for c in by])
    placed = rows.join(F.broadcast(bounds), at, "left")
    found = _position(F.coalesce("_bounds", F.array().cast("array<double>")), F.col("_rank"))
    return placed.withColumn(name, found).drop("_bounds", *[f"_of{c}" for c in by])


def _position(bounds: Column, value: Column) -> Column:
    """How many sorted ``bounds`` are <= ``value``, by halving."""
    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))

    def halve(span: Column, _: Column) -> Column:
        lo, hi = span["lo"], span["hi"]
        middle = F.floor((lo + hi) / 2).cast("int")
        below = F.coalesce(F.get(bounds, middle) <= value, F.lit(False))
        narrowed = F.struct(
            F.when(below, middle + 1).otherwise(lo).alias("lo"),
            F.when(below, hi).otherwise(middle).alias("hi"),
        )
        return F.when(lo < hi, narrowed).otherwise(span)

    steps = F.sequence(F.lit(1), F.lit(GRID.bit_length() + 1))
    return F.aggregate(steps, start, halve, lambda span: span["lo"])
