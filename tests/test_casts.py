from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.functions import casts, identity


def value(spark, cast, text):
    df = spark.createDataFrame([(text,)], "v string")
    return df.select(cast(F.col("v")).alias("v")).first()["v"]


def test_money_is_exact(spark):
    assert value(spark, casts.source_money, "50.00") == Decimal("50.00")
    assert value(spark, casts.source_money, "7") == Decimal("7.00")
    assert value(spark, casts.source_money, None) is None


@pytest.mark.parametrize("text", ["0.001", "1000000000000.00", "not-a-number", ""])
def test_money_never_rounds_or_overflows(spark, text):
    with pytest.raises(PySparkException, match="not an exact amount"):
        value(spark, casts.source_money, text)


@pytest.mark.parametrize("text", ["1.5", "x", ""])
def test_integers_must_be_whole(spark, text):
    assert value(spark, casts.source_integer, "12") == 12
    with pytest.raises(PySparkException, match="not an integer"):
        value(spark, casts.source_integer, text)


@pytest.mark.parametrize("text", ["2017-01-01T12:00:00+03:00", "2017-01-01 12:00:00Z", "invalid-date", "12:30"])
def test_business_times_have_no_zone(spark, text):
    assert value(spark, casts.source_timestamp, "2017-01-02") == datetime(2017, 1, 2)
    with pytest.raises(PySparkException, match="zone-less"):
        value(spark, casts.source_timestamp, text)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_naive_instants_are_utc_in_any_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        show = lambda text: value(spark, lambda c: casts.utc_wall_clock(casts.source_instant(c)), text)
        expected = datetime(2026, 1, 1, 0, 0, 0, 123456)
        assert show("2026-01-01 00:00:00.123456") == expected
        assert show("2026-01-01T03:00:00.123456+03:00") == expected
        assert show("2026-01-01T00:00:00.123456Z") == expected
        assert show("2026-01-01") == datetime(2026, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    with pytest.raises(PySparkException, match="not a timestamp"):
        value(spark, casts.source_instant, "invalid-date")


SPELLINGS = [
    None, "", " ", "1", "-1", "+1", "1.", ".5", "1.5", "1.50", "1.500", "1.505", " 1.50", "1.50\n", "1e2", "-0.00", "999999999999.99",
    "1000000000000", "000000000000.10", "0000000000001.10", "--1", "1,5", "2024-01-02", "2024-1-2", "2024-01-02 03:04:05", "2024-01-02 03:04:05\n",
    "2024-01-02 03:04:05 ", " 2024-01-02 03:04:05", "2024-01-02 03:04:05Z", "2024-01-02 03:04:05z", "2024-01-02T03:04:05", "2024-01-02T03:04:05Z",
    "2024-01-02 03:04:05.25", "2024-01-02 03:04:05+02", "2024-01-02 03:04:05+02:00", "2024-13-02 03:04:05", "2024-02-30 03:04:05Z",
    "2024-01-02 25:04:05", "2024-01-02 03:04", "03:04:05", "12024-01-02 03:04:05", "2024-01-02 03:04:05ZZ", "٢024-01-02 03:04:05",
]


def test_usual_spellings_obey_the_long_rules(spark):
    v = F.col("v")
    df = spark.createDataFrame([(text,) for text in SPELLINGS], "v string")
    narrow = v.try_cast("decimal(14,2)")
    money = F.when(v.try_cast("decimal(38,18)") == narrow, narrow)
    naive = F.when(v.rlike(casts.LEADING_DATE) & ~v.rlike(casts.ZONE_SUFFIX), v.try_cast("timestamp_ntz"))
    utc = F.concat(F.rtrim(v), F.when(v.rlike(casts.HAS_CLOCK), F.lit("Z")).otherwise(F.lit(" 00:00:00Z")))
    instant = F.when(v.rlike(casts.LEADING_DATE), F.when(v.rlike(casts.ZONE_SUFFIX), v).otherwise(utc)).try_cast("timestamp")
    for rule, bad, typed in (
        (money, casts.bad_money, casts.source_money),
        (naive, casts.bad_timestamp, casts.source_timestamp),
        (instant, casts.bad_instant, casts.source_instant),
    ):
        told = df.select("v", (bad(v) == (v.isNotNull() & rule.isNull())).alias("told"), bad(v).alias("bad"))
        assert [r["v"] for r in told.collect() if not r["told"]] == []
        rows = df.filter(~bad(v)).select("v", typed(v).eqNullSafe(rule).alias("same")).collect()
        assert len(rows) > 3 and [r["v"] for r in rows if not r["same"]] == []


def test_a_value_is_cast_once(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",)], "v string")
    for typed in (casts.source_timestamp, casts.source_instant, casts.source_integer):
        plan = df.select(typed(F.col("v")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("try_cast(") == 1


def test_bad_values_fail_only_when_their_column_is_read(spark):
    df = spark.createDataFrame([("k", "0.001")], "payment_key string, payment_value string")
    typed = df.select("payment_key", casts.staged("payment_value"))
    assert typed.select("payment_key").collect()[0][0] == "k"
    with pytest.raises(PySparkException):
        typed.collect()


def test_sequences(spark):
    good = ["1", "0012", "9" * 35]
    bad = ["", "0", "000", "-1", "text", "1" * 36, "1.0", None]
    df = spark.createDataFrame([(v,) for v in good + bad], "v string")
    assert [r[0] for r in df.select(identity.is_sequence(F.col("v"))).collect()] == [True] * 3 + [False] * 8


def test_length_prefix_separates_null_empty_and_shifted_values(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("", "a"), ("a:1", "b"), ("a", "1:b")], "x string, y string")
    assert df.select(identity.length_prefixed(["x", "y"]).alias("t")).distinct().count() == 5


def test_contract_column_order_and_types():
    assert contract.source_columns("customers")[0] == "customer_id"
    for table in contract.TABLES:
        assert contract.source_columns(table)[-1] == "updated_at"
        raw = contract.raw_schema(table)
        assert raw.names == contract.raw_columns(table)
        assert all(raw[c].dataType.simpleString() == "string" for c in contract.source_columns(table))
        assert contract.staged_schema(table)["updated_at"].dataType.simpleString() == "timestamp"
