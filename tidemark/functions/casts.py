"""Strict casts from raw text: a value that does not fit fails, it never bends.

Each ``source_*`` function returns the typed column and raises on bad input.
Each ``bad_*`` function returns a boolean for the same rule, so a whole table
can be validated in one scan without aborting at the first row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import contract

# Fixed value: a clock time followed by a zone designator at the end.
ZONE_SUFFIX = r"[ T][0-9]{2}:[0-9]{2}.*([zZ]|[+-][0-9]{2}(:?[0-9]{2})?)$"
# A calendar date must lead; Spark alone would read '12:30' as today.
LEADING_DATE = r"^\s*[0-9]{4,}-[0-9]{1,2}-[0-9]{1,2}"
HAS_CLOCK = r"[0-9]:[0-9]"
# Usual spellings, which one look tells: they pass the rules below, whatever their digits.
# Anything else takes the long way, with the same result.
USUAL_AMOUNT = r"^-?[0-9]{1,12}([.][0-9]{1,2})?\z"
USUAL_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"
USUAL_INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}Z?\z"


def _or_fail(typed: Column, message: str, value: Column) -> Column:
    """``typed``, which is NULL for bad text; it is worked out once."""
    failed = F.raise_error(F.concat(F.lit(message + ": "), value))
    return F.coalesce(typed, F.when(value.isNotNull(), failed))


def _money(value: Column) -> Column:
    wide = value.try_cast("decimal(38,18)")
    narrow = value.try_cast("decimal(14,2)")
    return F.when(value.rlike(USUAL_AMOUNT) | (wide == narrow), narrow)


def bad_money(value: Column) -> Column:
    return value.isNotNull() & _money(value).isNull()


def source_money(value: Column) -> Column:
    """decimal(14,2); excess scale or size fails instead of rounding."""
    return _or_fail(_money(value), "not an exact amount", value)


def bad_integer(value: Column) -> Column:
    return value.isNotNull() & value.try_cast("int").isNull()


def source_integer(value: Column) -> Column:
    return _or_fail(value.try_cast("int"), "not an integer", value)


def _timestamp(value: Column) -> Column:
    dated = value.rlike(USUAL_TIME) | (value.rlike(LEADING_DATE) & ~value.rlike(ZONE_SUFFIX))
    return F.when(dated, value.try_cast("timestamp_ntz"))


def bad_timestamp(value: Column) -> Column:
    return value.isNotNull() & _timestamp(value).isNull()


def source_timestamp(value: Column) -> Column:
    """Zone-less timestamp; text that carries a zone fails."""
    return _or_fail(_timestamp(value), "not a zone-less timestamp", value)


def _instant(value: Column) -> Column:
    # Spelling the zone out keeps the result independent of the session zone.
    utc = F.when(value.rlike(HAS_CLOCK), F.concat(F.rtrim(value), F.lit("Z"))).otherwise(
        F.concat(F.rtrim(value), F.lit(" 00:00:00Z"))
    )
    zoned = F.when(value.rlike(ZONE_SUFFIX), value).otherwise(utc)
    usual = F.when(F.endswith(value, F.lit("Z")), value).otherwise(F.concat(value, F.lit("Z")))
    spelled = F.when(value.rlike(USUAL_INSTANT), usual).when(value.rlike(LEADING_DATE), zoned)
    return spelled.try_cast("timestamp")


def bad_instant(value: Column) -> Column:
    return value.isNotNull() & _instant(value).isNull()


def source_instant(value: Column) -> Column:
    """Instant in time; text without a zone means UTC."""
    return _or_fail(_instant(value), "not a timestamp", value)


def try_instant(value: Column) -> Column:
    """``source_instant`` with NULL for bad text."""
    return _instant(value)


def utc_wall_clock(value: Column) -> Column:
    """Zone-less UTC reading of an instant, whatever the session zone."""
    return F.convert_timezone(None, F.lit("UTC"), value)


def staged(column: str) -> Column:
    """The staged (typed) form of a raw text column, by contract."""
    value = F.col(column)
    if column in contract.MONEY:
        typed = source_money(value)
    elif column in contract.INTEGERS:
        typed = source_integer(value)
    elif column in contract.NAIVE_TIMESTAMPS:
        typed = source_timestamp(value)
    elif column in contract.UTC_TIMESTAMPS:
        typed = source_instant(value)
    else:
        return value
    return typed.alias(column)


def bad_value(column: str) -> Column | None:
    """True where raw text breaks its column's type; None for text columns."""
    value = F.col(column)
    if column in contract.MONEY:
        return bad_money(value)
    if column in contract.INTEGERS:
        return bad_integer(value)
    if column in contract.NAIVE_TIMESTAMPS:
        return bad_timestamp(value)
    if column in contract.UTC_TIMESTAMPS:
        return bad_instant(value)
    return None
