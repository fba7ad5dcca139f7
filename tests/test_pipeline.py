import os

import pytest

from changes import CUSTOMER, ITEM, NULL, ORDER, PAYMENT, change, put, put_changes, put_snapshot, rows_of, snapshot, text_of
from tidemark import contract
from tidemark.operators import checks
from tidemark.plans import layers, lifecycle
from tidemark.sources import baseline, records, sinks
from tidemark.streaming import batches, ingest
from tidemark.streaming.batches import BatchGate


def test_batch_gate(store, capture_root):
    put_changes(capture_root, "001", [change("customers", CUSTOMER, 1)])
    gate = BatchGate(store, capture_root)
    assert gate.prepare("first")
    gate.complete("first")
    gate.complete("first")  # acknowledging again is harmless
    assert not gate.prepare("quiet")
    put_changes(capture_root, "002", [change("customers", CUSTOMER, 2)])
    assert gate.prepare("next") and gate.prepare("retry")  # not complete yet
    put_changes(capture_root, "003", [change("customers", CUSTOMER, 3)])
    gate.complete("retry")
    assert gate.prepare("later")  # the third file arrived after prepare
    gate.complete("later")
    assert not gate.prepare("quiet again")
    other = type(store)(store.spark, store.root + "-other")
    assert BatchGate(other, capture_root).prepare("elsewhere")
    with pytest.raises(FileNotFoundError, match="not prepared"):
        BatchGate(other, capture_root).complete("unknown")


def test_empty_capture_does_not_look_healthy(store, capture_root):
    os.makedirs(capture_root)
    with pytest.raises(FileNotFoundError):
        BatchGate(store, capture_root).prepare("empty")


def test_failed_build_is_retried_though_raw_has_landed(store, capture_root):
    put_changes(capture_root, "001", [change("customers", CUSTOMER, 1)])
    calls = []

    def build(warehouse):
        calls.append(warehouse.raw("customers").count())
        if len(calls) == 1:
            raise RuntimeError("build failed")

    with pytest.raises(RuntimeError):
        batches.run_batch(store, capture_root, "a", build)
    again = batches.run_batch(store, capture_root, "b", build)
    assert again["files_already_loaded"] == 1 and calls == [1, 1]
    assert batches.run_batch(store, capture_root, "c", build) is None


def test_stream_lands_each_file_once_and_survives_failure(store, capture_root, tmp_path):
    put_changes(capture_root, "a", [change("customers", CUSTOMER, 2, "U"), change("orders", ORDER, 3)])
    put_snapshot(capture_root, "customers", [snapshot("customers", CUSTOMER)])
    checkpoint = str(tmp_path / "checkpoint")
    seen = []

    def fail_once(warehouse, batch_id):
        seen.append(warehouse.raw("customers").count())
        if len(seen) == 1:
            raise RuntimeError("build failed")

    def run():
        ingest.stream_ingest(store, capture_root, checkpoint, after_batch=fail_once).awaitTermination()

    with pytest.raises(Exception, match="build failed"):
        run()
    run()  # the same micro-batch again: nothing lands twice, the build is repeated
    assert seen == [2, 2]
    put_changes(capture_root, "b", [change("customers", CUSTOMER, 2, "U")])
    run()
    run()
    assert store.raw("customers").count() == 3 and seen == [2, 2, 3]
    assert layers.stage(store.raw("customers"), "customers").count() == 2


def landed(store, capture_root):
    data = {**CUSTOMER, "city": ' é, "q"\nx ', "postal_code": NULL, "state": ""}
    put_changes(capture_root, "x", [change("customers", data, 12345678901234567890123456789012345, when="2026-01-01T03:00:00.5+03:00")])
    put_snapshot(capture_root, "customers", [snapshot("customers", CUSTOMER)])
    store.land_pending(capture_root)
    return store.raw("customers")


def test_copy_ready_files_round_trip(spark, store, capture_root, tmp_path):
    raw = landed(store, capture_root)
    root = str(tmp_path / "out")
    for _ in range(2):  # a retry reuses the same folders
        folder = sinks.write_copy_ready(raw, "customers", root)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").load(folder)
    files = [(r["path"], r["length"]) for r in listing.select("path", "length").collect()]
    assert any("cdc%2Fx" in p for p, _ in files) and any("initial-load%2Fcustomers%2FLOAD00000001" in p for p, _ in files)
    by_file = {os.path.basename(r[11]): r for r in (x["fields"] for x in records.read_records(spark, files, NULL).collect())}
    changed = by_file["x.csv"]
    assert changed[2] is None and changed[3] == ' é, "q"\nx ' and changed[4] == ""
    assert changed[8] == "12345678901234567890123456789012345"
    assert changed[9] == "2026-01-01T00:00:00.500000+00:00" and changed[10] == "false"
    assert by_file["LOAD00000001.csv"][9] == "2026-01-01T00:00:00+00:00"


def test_typed_parquet_and_formats(spark, store, capture_root, tmp_path):
    raw = landed(store, capture_root)
    path = str(tmp_path / "typed")
    sinks.write_typed_parquet(raw, "customers", path)
    back = spark.read.parquet(path)
    assert back.columns == contract.raw_columns("customers") and back.count() == 2
    rows = sinks.compare_formats(spark, raw, "customers").collect()
    assert {r["format"] for r in rows} == set(sinks.FORMATS)
    assert all(r["roundtrip_ok"] and r["bytes"] > 0 and r["row_count"] == 2 for r in rows)


ROWS = {
    "customers": ["c" * 32, "u" * 32, "07000", "tandil", "BA"],
    "orders": ["o" * 32, "c" * 32, "created", "2017-01-01 12:00:00", "", "", "", "2017-01-08 00:00:00"],
    "order_items": ["o" * 32, "01", "a" * 32, "b" * 32, "2017-01-02 12:00:00", "100.25", "5.00"],
    "order_payments": ["o" * 32, "1", "credit_card", "1", "105.25"],
}


def exports(root, **changed):
    paths = {}
    for table, titles in baseline.HEADERS.items():
        body = text_of([list(titles.values()), changed.get(table, ROWS[table])])
        paths[table] = put(root, f"{table}.csv", ("﻿" if table == "orders" else "") + body)
    return paths


def test_baseline_import(spark, tmp_path):
    tables = baseline.validated_baseline(spark, exports(tmp_path))
    assert {r["source_table"]: r["row_count"] for r in baseline.baseline_counts(tables).collect()} == dict.fromkeys(ROWS, 1)
    assert tables["customers"].first()["postal_code"] == "07000"
    assert tables["orders"].first()["approved_at"] is None
    assert tables["order_items"].first()["order_item_key"] == "o" * 32 + ":1"
    assert tables["order_payments"].first()["payment_key"] == "o" * 32 + ":1"


def test_baseline_is_refused_as_a_whole(spark, tmp_path):
    orphan = ["x" * 32, *ROWS["order_payments"][1:]]
    with pytest.raises(checks.CheckFailure, match="foreign_key"):
        baseline.validated_baseline(spark, exports(tmp_path, order_payments=orphan))
    paths = exports(tmp_path)
    del paths["order_payments"]
    with pytest.raises(ValueError, match="missing export"):
        baseline.import_baseline(spark, paths)
    paths = exports(tmp_path)
    paths["orders"] = put(tmp_path, "short.csv", "order_id,customer_id\n1,2\n")
    with pytest.raises(ValueError, match="lacks columns"):
        baseline.import_baseline(spark, paths)


def test_lifecycle_report(spark, store, capture_root):
    spare = {**CUSTOMER, "customer_id": "gone"}
    rows = [
        change("customers", CUSTOMER, 1), change("customers", spare, 2), change("orders", ORDER, 3),
        change("order_items", ITEM, 4), change("order_payments", PAYMENT, 5),
        change("orders", {**ORDER, "status": "approved"}, 6, "U"),
        change("orders", {**ORDER, "order_id": "gone"}, 7), change("orders", {**ORDER, "order_id": "gone"}, 8, "D"),
        change("customers", {**CUSTOMER, "city": "azul"}, 9, "U"), change("customers", spare, 10, "D"),
    ]
    put_changes(capture_root, "a", rows)
    store.land_pending(capture_root)
    raw = store.raw_tables()
    staged, marts = layers.stage_all(raw), layers.marts_from_raw(raw)
    orders = spark.createDataFrame([("r1",), ("gone",)], "order_id string")
    customers = spark.createDataFrame([("k1",), ("gone",)], "customer_id string")
    report = lifecycle.lifecycle_report(raw, staged, marts, orders, customers)
    assert rows_of(report, "check", "key", "value") == sorted([
        ("current_city", "r1", "azul"),
        ("customer_absent", "gone", "absent"),
        ("customer_versions", "k1", "2|0|1"),
        ("customer_versions", "gone", "2|1|0"),
        ("order_absent", "gone", "absent"),
        ("customers_operations", "D", "1|1"),
        ("customers_operations", "I", "2|2"),
        ("customers_operations", "U", "1|1"),
        ("order_items_operations", "I", "1|1"),
        ("order_payments_operations", "I", "1|1"),
        ("orders_operations", "D", "1|1"),
        ("orders_operations", "I", "2|2"),
        ("orders_operations", "U", "1|1"),
        ("order_totals", "r1", "approved|31.00|4.00|35.00|1|1"),
        ("status_steps", "gone", "1|1"),
        ("status_steps", "r1", "2|2"),
    ], key=repr)


def test_registered_queries_have_sql_twins():
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 90
    assert {q for q in set(queries) - set(sql) if not (q == "pipeline" or q.startswith("op"))} == set()


def test_flagship_query(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns[:3] == ["order_id", "customer_id", "status"] and df.count() > 0


def test_views(spark):
    from tidemark.sources import feed

    names = layers.register_views(spark, feed.raw_tables(spark, "/root/testdata/sf0.001"))
    assert "stg_orders" in names and "int_orders_current" in names and "fct_orders" in names
    count = spark.sql("select count(*) from dim_customers where customer_id is not null").first()[0]
    assert count == spark.table("int_customers_current").count() > 0
    spark.sql("select status, sum(order_total) from fct_orders group by status").collect()
