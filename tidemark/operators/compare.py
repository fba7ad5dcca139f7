"""Comparing tables: set equality, fingerprints, reconciliation, state diffs.

Both sides are unioned with a sign and summed per distinct row.  That needs one
partially aggregated shuffle, treats NULL as a value, counts repeated rows, and
never pairs rows up, so a repeated key cannot multiply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import identity


def signed_difference(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows whose number differs; ``_surplus`` > 0 means more on the left."""
    signed = left.select(*columns, F.lit(1).alias("_sign")).unionByName(
        right.select(*columns, F.lit(-1).alias("_sign"))
    )
    summed = signed.groupBy(*columns).agg(F.sum("_sign").alias("_surplus"))
    return summed.filter(F.col("_surplus") != 0)


def same_content(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: how many copies only one side has, and whether both are equal.

    Checksums of ranges of row hashes say where the sides differ; only rows of
    those ranges are dealt out and counted.
    """
    names = list(columns or left.columns)
    differ = differing_ranges(_row_sums(left, names), _row_sums(right, names))
    diff = signed_difference(*(in_ranges(df.select(*names), names, differ) for df in (left, right)), names)
    surplus = F.col("_surplus")
    totals = diff.agg(
        F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-surplus, F.lit(0))), F.lit(0)).alias("only_right"),
    )
    return totals.withColumn("equal", (F.col("only_left") + F.col("only_right")) == 0)


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Order-independent content fingerprint: row count and two summed digest slices."""
    digest = F.md5(identity.length_prefixed(columns or df.columns))
    hashed = df.select(digest.alias("_digest"))
    return hashed.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(identity.hex_slice(F.col("_digest"), 1)).cast("decimal(38,0)").alias("digest_low"),
        F.sum(identity.hex_slice(F.col("_digest"), 16)).cast("decimal(38,0)").alias("digest_high"),
    )


def _side(side: int, values: Column) -> Column:
    return F.max(F.when(F.sign("_surplus") == side, values))


def mismatches(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per differing key: what is missing, or which columns changed.

    Instants compare as instants and NULL differs from ''.
    """
    columns = [c for c in columns if c != key]
    diff = signed_difference(source, target, [key, *columns])
    row = F.struct(F.lit(True).alias("_present"), *columns)
    sides = diff.groupBy(key).agg(_side(1, row).alias("_source"), _side(-1, row).alias("_target"))
    changed = [
        F.when(~F.col(f"_source.{c}").eqNullSafe(F.col(f"_target.{c}")), F.lit(c)) for c in columns
    ]
    kind = (
        F.when(F.col("_target").isNull(), F.lit("missing_in_target"))
        .when(F.col("_source").isNull(), F.lit("missing_in_source"))
        .otherwise(F.lit("changed"))
    )
    return sides.select(
        key,
        kind.alias("kind"),
        F.when(kind == "changed", F.array_compact(F.array(*changed))).alias("changed_columns"),
    )


def reconcile(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row: counts per side, differences by kind and the first differing key."""
    wrong = mismatches(source, target, key, columns).agg(
        *[
            F.count_if(F.col("kind") == kind).alias(kind)
            for kind in ("missing_in_target", "missing_in_source", "changed")
        ],
        F.min(key).alias("first_mismatch"),
    )
    sides = source.select(F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target.select(F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    counts = sides.agg(
        F.coalesce(F.sum("_s"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("_t"), F.lit(0)).alias("target_rows"),
    )
    # Two one-row aggregates stacked and folded into one row.
    stacked = counts.unionByName(wrong, allowMissingColumns=True)
    folded = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    trouble = F.col("missing_in_target") + F.col("missing_in_source") + F.col("changed")
    return folded.withColumn("all_fields_match", trouble == 0)


def diff_states(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Change events that turn ``before`` into ``after``; a D carries the old image."""
    columns = [c for c in columns if c != key]
    diff = signed_difference(after, before, [key, *columns])
    row = F.struct(F.lit(True).alias("_present"), *columns)
    sides = diff.groupBy(key).agg(_side(1, row).alias("_after"), _side(-1, row).alias("_before"))
    op = (
        F.when(F.col("_before").isNull(), F.lit("I"))
        .when(F.col("_after").isNull(), F.lit("D"))
        .otherwise(F.lit("U"))
    )
    image = F.coalesce("_after", "_before")
    return sides.select(op.alias("_op"), key, *[image[c].alias(c) for c in columns])


# Ranges of key hashes with a checksum each; at most so many rows describe a table.
LEAVES = 4096


def _leaf(key: str | Sequence[str], leaves: int) -> Column:
    names = [key] if isinstance(key, str) else key
    return F.pmod(F.xxhash64(*names), F.lit(leaves)).cast("int")


def range_sums(df: DataFrame, key: str, columns: Sequence[str], leaves: int = LEAVES) -> DataFrame:
    """``leaf, row_count, digest_low, digest_high`` of each range of key hashes: at most ``leaves`` rows.

    Written beside a version of a table they stand for it: a later comparison
    needs the other side's sums only.
    """
    return _sums(df, _leaf(key, leaves), F.md5(identity.length_prefixed(columns)))


def _row_sums(df: DataFrame, columns: Sequence[str], leaves: int = LEAVES) -> DataFrame:
    """``range_sums`` by the hash of the whole row, with two digests that need no text of it.

    NULLs are marked, since a hash passes over them.  The types are part of the
    digests: sides of other types differ in every range and are compared by value.
    """
    names = list(columns)
    kinds = F.lit(",".join(df.schema[c].dataType.simpleString() for c in names))
    marked = [x for c in names for x in (F.col(c).isNull(), F.col(c))]
    digests = {"low": F.xxhash64(F.lit(1), kinds, *marked), "high": F.xxhash64(F.lit(2), kinds, *reversed(marked))}
    hashed = df.select(_leaf(names, leaves).alias("leaf"), *[digest.alias(k) for k, digest in digests.items()])
    # Halves of 32 bits: sums of two billion of them fit a long.
    halves = [(k, bits) for k in digests for bits in ("upper", "lower")]
    summed = hashed.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.sum(F.shiftright(k, 32) if bits == "upper" else F.col(k).bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"{k}_{bits}") for k, bits in halves],
    )

    def whole(k: str) -> Column:
        return F.col(f"{k}_upper").cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col(f"{k}_lower")

    return summed.select("leaf", "row_count", *[whole(k).cast("decimal(38,0)").alias(f"digest_{k}") for k in digests])


def _sums(df: DataFrame, leaf: Column, digest: Column) -> DataFrame:
    hashed = df.select(leaf.alias("leaf"), digest.alias("_digest"))
    return hashed.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(identity.hex_slice(F.col("_digest"), 1)).cast("decimal(38,0)").alias("digest_low"),
        F.sum(identity.hex_slice(F.col("_digest"), 16)).cast("decimal(38,0)").alias("digest_high"),
    )


def folded(sums: DataFrame, ranges: int) -> DataFrame:
    """The sums of fewer, wider ranges: a higher level of the tree, from the level below alone."""
    wider = sums.groupBy(F.pmod("leaf", F.lit(ranges)).alias("leaf"))
    return wider.agg(*[F.sum(c).cast(t).alias(c) for c, t in (("row_count", "long"), ("digest_low", "decimal(38,0)"), ("digest_high", "decimal(38,0)"))])


def differing_ranges(left: DataFrame, right: DataFrame) -> DataFrame:
    """``leaf`` of the ranges whose sums differ."""
    return signed_difference(left, right, ["leaf", "row_count", "digest_low", "digest_high"]).select("leaf").distinct()


def in_ranges(df: DataFrame, key: str | Sequence[str], ranges: DataFrame, leaves: int = LEAVES) -> DataFrame:
    """Rows of ``df`` in these ranges, where they are: the list of ranges is broadcast."""
    wanted = F.broadcast(ranges.select(F.col("leaf").alias("_leaf")))  # at most ``leaves`` numbers
    return df.join(wanted, _leaf(key, leaves) == F.col("_leaf"), "left_semi")


def mismatches_by_range(
    source: DataFrame,
    target: DataFrame,
    key: str,
    columns: Sequence[str],
    leaves: int = LEAVES,
    known: DataFrame | None = None,
) -> DataFrame:
    """As ``mismatches``, but only rows of ranges whose checksums differ are dealt out and compared.

    ``known`` are the source's sums where they have been kept.
    """
    names = [key, *(c for c in columns if c != key)]
    sums = known if known is not None else range_sums(source, key, names, leaves)
    differ = differing_ranges(sums, range_sums(target, key, names, leaves))
    sides = (in_ranges(df, key, differ, leaves) for df in (source, target))
    return mismatches(*sides, key, columns)
