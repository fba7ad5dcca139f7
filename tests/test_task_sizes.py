"""What a task holds when tables are large: nothing that has to be sorted on disk, no method too long to compile."""

import re

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from changes import CUSTOMER, ITEM, ORDER, change, put_changes
from tidemark import contract
from tidemark.catalog.context import Context
from tidemark.catalog import queries
from tidemark.catalog.queries import QUERIES
from tidemark.plans import build
from tidemark.session import SORTED_BYTES, settings
from tidemark.sources import capture, maintenance

WRITERS, SPLIT = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def seen(spark, monkeypatch):
    """Settings at the start of each Parquet write of a session that sets neither, by folder."""
    found, plain = {}, DataFrameWriter.parquet

    def parquet(self, path, *args, **options):
        found[path] = {n: spark.conf.get(n, None) for n in (WRITERS, SPLIT)} | options
        return plain(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    before = spark.conf.get(WRITERS, None)
    spark.conf.unset(WRITERS)
    yield found
    if before is not None:
        spark.conf.set(WRITERS, before)


def landed(store, root):
    put_changes(root, "a", [change("customers", CUSTOMER, 1), change("orders", ORDER, 2), change("order_items", ITEM, 3)])
    store.land_pending(root)


def of(seen, part):
    return [options for path, options in seen.items() if part in path]


def test_judgement_of_events_is_short_enough_to_compile(spark, capture_root, capsys):
    put_changes(capture_root, "a", [change("customers", CUSTOMER, 1)])
    with settings(spark, {"spark.sql.codegen.wholeStage": "true", "spark.sql.adaptive.enabled": "false"}):
        files = [(r["path"], r["size"]) for r in capture.capture_manifest(spark, capture_root).collect()]
        capture.read_events(spark, capture_root, files).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000  # the JVM leaves longer methods to its interpreter


def test_split_query_finds_captures_written_with_usual_splits(spark, monkeypatch):
    at = []

    class Asked:
        def __init__(self):
            self.spark = spark

        @property
        def captures(self):
            at.append(spark.conf.get(SPLIT))

    monkeypatch.setattr(queries, "_captured_split", lambda c, *_: (c.captures, at.append(spark.conf.get(SPLIT))))
    before = spark.conf.get(SPLIT)
    queries.captured_customers_split(Asked())
    assert at[0] == before and at[-1] == str(1 << 14)


def test_landing_writes_tables_side_by_side(spark, store, capture_root, seen):
    landed(store, capture_root)
    (raw,) = of(seen, "/raw/")
    assert int(raw[WRITERS]) > len(contract.TABLES) and raw["compression"] == "zstd"
    assert spark.conf.get(WRITERS, None) in (None, "0")


def test_compaction_deals_out_own_columns(spark, store, capture_root, seen):
    landed(store, capture_root)
    into = maintenance.compact(store)
    held = spark.read.parquet(store.folder(f"laid/load_id={into}/source_table=orders")).columns
    assert set(held) == {*contract.raw_columns("orders"), "line", "landed_by", "bucket"}
    assert all(int(o[WRITERS]) > 8 and int(o[SPLIT]) <= SORTED_BYTES for o in of(seen, "/laid/"))
    assert store.raw("orders").count() == store.raw("customers").count() == store.raw("order_items").count() == 1
    assert store.raw("order_payments").count() == 0


def test_builds_read_splits_that_sort_in_memory(spark, store, capture_root, seen):
    landed(store, capture_root)
    before = spark.conf.get(SPLIT)
    build.build(store, allow=("relationships",))
    marts = of(seen, "/marts/")
    assert len(marts) == len(contract.MARTS)
    assert all(int(o[SPLIT]) <= SORTED_BYTES and int(o[WRITERS]) > 8 and o["compression"] == "zstd" for o in marts)
    assert spark.conf.get(SPLIT) == before


def test_refused_and_accepted_rows_are_counted_apart(store, capture_root):
    put_changes(capture_root, "a", [change("customers", CUSTOMER, 1), change("customers", CUSTOMER, 2)])
    put_changes(capture_root, "b", [change("customers", CUSTOMER, 3), change("orders", {**ORDER, "status": "x" * 257}, 4), ["?"]])
    metrics = store.land_pending(capture_root, strict=False)
    assert metrics["input_I"] == 2 and metrics["files_committed"] == 1
    (refused,) = store.rejected().collect()
    assert refused["line"] == 2 and refused["reason"] == "source value is too wide"


@pytest.fixture
def tables(spark, tmp_path):
    made = {
        "customer": spark.sql("select id as c_custkey from range(4)"),
        "events": spark.sql(
            "select id as event_id, id % 4 as user_id, elt(cast(id % 4 as int) + 1, 'signup', 'view', 'click', 'error') as event_type,"
            " timestamp'2024-03-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id as int)) as ts from range(20)"
        ),
        "orders": spark.sql("select id as o_orderkey, id % 4 as o_custkey, date'2024-01-01' as o_orderdate, 50.0D as o_totalprice from range(12)"),
        "lineitem": spark.sql(
            "select id as l_orderkey, 1 as l_linenumber, id as l_partkey, id as l_suppkey, 9.5D as l_extendedprice, 2.0D as l_quantity,"
            " 'N' as l_returnflag, 'O' as l_linestatus, date'2024-02-01' as l_shipdate from range(12)"
        ),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(str(tmp_path / "tables" / f"{name}.parquet"))
    return str(tmp_path / "tables")


def test_lifecycle_events_store_no_mart_but_the_history(spark, tables, seen):
    c = Context(spark, tables)
    rows = {tuple(r) for r in QUERIES["lifecycle_events"](spark, tables).collect()}
    assert {r[0] for r in rows} == {"status", "city", "deleted"}
    history = {(r["customer_id"], r["source_order_from"], r["city"], str(r["is_deleted"]).lower()) for r in c.marts["dim_customer_history"].collect()}
    assert {r[1:] for r in rows if r[0] == "city"} == {(k, n, city) for k, n, city, _ in history}
    assert {r[1:] for r in rows if r[0] == "deleted"} == {(k, n, gone) for k, n, _, gone in history}
    stored = sorted(path.rsplit("/", 1)[-1].rsplit("-", 1)[0] for path in seen if "/raw-" in path or "/marts-" in path)
    assert stored == ["marts-dim_customer_history", "raw-customers"]


def test_stored_marts_hold_what_all_marts_hold(spark, tables):
    c = Context(spark, tables)
    assert list(c.stored_marts) == list(contract.MARTS) and len(c.stored_raw) == len(contract.TABLES)
    for mart, whole in c.marts.items():
        one = c.stored_marts[mart]
        assert one.columns == whole.columns
        assert one.exceptAll(whole).isEmpty() and whole.exceptAll(one).isEmpty() and not one.isEmpty()
    with pytest.raises(KeyError):
        c.stored_marts["orders"]
