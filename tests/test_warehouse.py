import os

import pytest
from pyspark.sql import functions as F

from changes import CUSTOMER, ITEM, NULL, ORDER, change, put, put_changes, put_snapshot, snapshot
from tidemark import contract
from tidemark.sources import warehouse
from tidemark.sources.warehouse import RejectedFile, Warehouse, within_bytes
from tidemark.streaming import ingest


def test_retry_is_skipped_and_redelivery_is_kept(store, capture_root):
    rows = [change("customers", CUSTOMER, 1)]
    put_changes(capture_root, "one", rows)
    assert store.land_pending(capture_root)["files_committed"] == 1
    assert store.land_pending(capture_root) == {"files_listed": 1, "files_already_loaded": 1}
    put_changes(capture_root, "two", rows)
    metrics = store.land_pending(capture_root)
    assert metrics == {"files_listed": 2, "files_already_loaded": 1, "files_committed": 1, "input_I": 1}
    assert store.raw("customers").count() == 2
    assert {r["row_count"] for r in store.ledger().collect()} == {1}


def test_rejected_file_leaves_nothing_and_earlier_files_stay(store, capture_root):
    put_changes(capture_root, "a", [change("customers", CUSTOMER, 1)])
    bad = [change("customers", CUSTOMER, 2), change("orders", {**ORDER, "status": "x" * 257}, 3)]
    put_changes(capture_root, "b", bad)
    put_changes(capture_root, "c", [change("customers", CUSTOMER, 4)])
    with pytest.raises(RejectedFile, match="b.csv:2: source value is too wide"):
        store.land_pending(capture_root)
    assert [r["source_file"].rsplit("/", 1)[1] for r in store.ledger().collect()] == ["a.csv"]
    assert store.raw("customers").count() == 1 and store.raw("orders").count() == 0
    # The source is repaired: the waiting files land once.
    put_changes(capture_root, "b", [change("customers", CUSTOMER, 2), change("orders", ORDER, 3)])
    metrics = store.land_pending(capture_root)
    assert metrics["files_committed"] == 2 and metrics["input_I"] == 3
    assert store.raw("customers").count() == 3 and store.raw("orders").count() == 1


def test_quarantine_lands_the_good_files(store, capture_root):
    put_changes(capture_root, "a", [change("customers", CUSTOMER, 0)])
    put_changes(capture_root, "b", [change("customers", CUSTOMER, 2)])
    metrics = store.land_pending(capture_root, strict=False)
    assert metrics["files_committed"] == 1 and metrics["input_I"] == 1
    waiting = store.pending(warehouse.capture.capture_manifest(store.spark, capture_root)).collect()
    landing = store.land([(r["path"], r["size"]) for r in waiting], capture_root, strict=False)
    assert landing.load_id is None and landing.metrics == {}
    assert [(line, text) for _, line, text in landing.rejected] == [(1, "no positive change sequence")]


def test_load_without_ledger_rows_is_invisible(store, capture_root):
    """A crash after the raw write and before the ledger write, then a retry."""
    put_changes(capture_root, "a", [change("customers", CUSTOMER, 1), change("orders", ORDER, 2)])
    files = [(r["path"], r["size"]) for r in warehouse.capture.capture_manifest(store.spark, capture_root).collect()]
    store._write(warehouse.capture.read_events(store.spark, capture_root, files), "crashed")
    assert store.raw("customers").count() == 0 and store.ledger().count() == 0
    store.land_pending(capture_root)
    assert store.raw("customers").count() == 1 and store.raw("orders").count() == 1


def test_files_land_in_several_batches(store, capture_root):
    for n in range(5):
        put_changes(capture_root, f"f{n}", [change("customers", CUSTOMER, n + 1)])
    metrics = store.land_pending(capture_root, max_files=2)
    assert metrics["files_committed"] == 5 and metrics["input_I"] == 5
    assert store.loads().count() == 3 and store.raw("customers").count() == 5


def test_metrics_by_kind(store, capture_root):
    rows = [change("customers", CUSTOMER, n, op) for n, op in ((1, "I"), (2, "U"), (3, "D"))]
    put_changes(capture_root, "a", rows)
    put_snapshot(capture_root, "order_items", [snapshot("order_items", ITEM)])
    metrics = store.land_pending(capture_root)
    assert metrics == {
        "files_listed": 2, "files_already_loaded": 0, "files_committed": 2,
        "input_I": 1, "input_U": 1, "input_D": 1, "snapshot_rows": 1,
    }


def test_raw_keeps_text_and_its_schema_is_enforced(store, capture_root):
    put_changes(capture_root, "a", [change("order_items", {**ITEM, "price": "0.001", "updated_at": NULL}, 1)])
    store.land_pending(capture_root)
    raw = store.raw("order_items")
    assert raw.schema.simpleString() == contract.raw_schema("order_items").simpleString()
    assert raw.first()["price"] == "0.001" and raw.first()["updated_at"] is None
    warehouse.assert_raw_schema(raw, "order_items")
    with pytest.raises(TypeError, match="must be text"):
        warehouse.assert_raw_schema(raw.withColumn("price", F.lit(1)), "order_items")
    assert warehouse.too_wide(raw, "order_items").count() == 0
    assert warehouse.too_wide(raw.withColumn("product_id", F.repeat(F.lit("x"), 257)), "order_items").count() == 1


def test_only_committed_partitions_are_scanned(store, capture_root):
    put_changes(capture_root, "a", [change("customers", CUSTOMER, 1)])
    store.land_pending(capture_root)
    plan = store.raw("customers")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "load_id" in filters and "source_table" in filters


def test_files_without_records_are_ledgered(store, capture_root):
    put(capture_root, "cdc/blank.csv", "\n\n")
    assert store.land_pending(capture_root)["files_committed"] == 1
    assert [r["row_count"] for r in store.ledger().collect()] == [0]
    assert store.raw("customers").count() == 0
    assert store.land_pending(capture_root)["files_already_loaded"] == 1


@pytest.mark.parametrize("name", ["with space", "50%25 off", "a=b,c", "ünï+x", "a[1]{x}"])
def test_odd_file_names(store, capture_root, name):
    put_changes(capture_root, name, [change("customers", CUSTOMER, 1)])
    assert store.land_pending(capture_root)["files_committed"] == 1
    assert [r["row_count"] for r in store.ledger().collect()] == [1]
    assert store.raw("customers").first()["_source_file"] == store.ledger().first()["source_file"]
    assert store.land_pending(capture_root)["files_already_loaded"] == 1


def test_every_listed_file_is_landed_or_refused(spark, store, capture_root, tmp_path):
    put_changes(capture_root, "good", [change("customers", CUSTOMER, 1)])
    put_changes(capture_root, "_hidden", [change("customers", CUSTOMER, 2)])
    put_changes(capture_root, "wide", [change("customers", {**CUSTOMER, "city": "x" * 200_000}, 3)])
    put(capture_root, "cdc/zero.csv", "")
    old = put_changes(capture_root, "old", [change("customers", CUSTOMER, 4)])
    os.utime(old, (1, 1))
    expected = {"good": 1, "_hidden": 1, "zero": 0, "old": 1}
    metrics = store.land_pending(capture_root, strict=False)
    assert metrics["files_listed"] == 5 and metrics["files_rejected"] == 1

    def accounted(warehouse):
        name = lambda r: os.path.basename(r["source_file"]).removesuffix(".csv")
        assert {name(r): r["row_count"] for r in warehouse.ledger().collect()} == expected
        assert [(name(r), r["line"], r["reason"]) for r in warehouse.rejected().collect()] == [("wide", 1, "source value is too wide")]
        assert warehouse.raw("customers").count() == 3

    accounted(store)
    # Offered again, refused again, and recorded as another refusal.
    store.land_pending(capture_root, strict=False)
    assert store.rejected().count() == 2
    streamed = Warehouse(spark, str(tmp_path / "streamed"))
    ingest.ingest_all(streamed, capture_root, str(tmp_path / "checkpoint"), strict=False)
    accounted(streamed)


def test_an_unclosed_quote_refuses_its_file_alone(spark, store, capture_root):
    """The rest of the file, cut by many splits, becomes one record; it is never put together."""
    lines = ["I,customers,ecommerce," + ",".join(["v"] * 6) + f",{n},2026-01-01T00:00:00Z" for n in range(1, 4000)]
    put(capture_root, "cdc/open.csv", '"' + "\n".join(lines) + "\n")
    put(capture_root, "cdc/shut.csv", "\n".join(lines) + "\n")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name in names:
        spark.conf.set(name, "8192")
    try:
        store.land_pending(capture_root, strict=False)
    finally:
        for name in names:
            spark.conf.unset(name)
    assert [r["row_count"] for r in store.ledger().collect()] == [3999]
    assert [r["reason"] for r in store.rejected().collect()] == ["record is too long"]


def test_batches_are_bounded_by_bytes():
    files = [("a", 5), ("b", 5), ("c", 1)]
    assert within_bytes(files, 10) == files[:2] and within_bytes(files, 3) == files[:1] and within_bytes([], 3) == []
