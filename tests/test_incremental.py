"""Record of publications, checksum ranges, binned intervals and sketches on small data."""

from datetime import datetime, timedelta

import pytest

from changes import CUSTOMER, change, put_changes
from tidemark import contract
from tidemark.operators import compare, intervals, joins
from tidemark.plans import build, publish, update
from tidemark.sources import buckets, maintenance, sketches
from tidemark.sources.warehouse import Warehouse


def test_updates_know_what_is_missing(store, capture_root):
    loads = []
    for n in (1, 2, 3):
        put_changes(capture_root, f"00{n}", [change("customers", {**CUSTOMER, "customer_id": f"k{n}"}, n)])
        store.land_pending(capture_root)
        loads += sorted({r["load_id"] for r in store.loads().collect()} - set(loads))
    with pytest.raises(LookupError):
        update.update(store)  # nothing is published
    build.build(store, loads=loads[:1])
    assert update.missing_loads(store) == sorted(loads[1:])
    with pytest.raises(update.OmittedLoad):
        update.update(store, loads[2:])
    # An attempt that never got its pointer does not count.
    named = store.spark.createDataFrame([("crashed", loads[1])], publish.CONTENTS)
    named.write.mode("append").parquet(store.folder("publication_loads"))
    assert update.missing_loads(store) == sorted(loads[1:])
    update.update(store)
    assert update.missing_loads(store) == []
    assert {r["customer_id"] for r in publish.read_mart(store, "dim_customers").collect()} == {"k1", "k2", "k3"}
    assert sketches.refresh(store) == 3 and sketches.refresh(store) == 0
    found = {r["source_table"]: (r["unique_events"], r["people"]) for r in sketches.estimates(store).collect()}
    assert found == {"customers": (3, 1)}


def _rows(df):
    return sorted(map(str, df.collect()))


def _land_customers(store, capture_root, name, keys, seq, city):
    rows = [change("customers", {**CUSTOMER, "customer_id": k, "city": city}, seq + n) for n, k in enumerate(keys)]
    put_changes(capture_root, name, rows)
    store.land_pending(capture_root)


def test_compaction_moves_loads_and_a_crash_leaves_one_visible_copy(store, capture_root):
    store = Warehouse(store.spark, store.root, buckets=4)
    assert maintenance.compact(store) is None
    _land_customers(store, capture_root, "001", ["a", "b", "c"], 1, "x")
    _land_customers(store, capture_root, "002", ["a", "d"], 10, "y")
    read = lambda: {t: _rows(store.raw(t)) for t in contract.TABLES}
    before, loads = read(), sorted(r["load_id"] for r in store.loads().collect())
    by_load = {i: _rows(store.raw("customers", store.spark.createDataFrame([(i,)], "load_id string"))) for i in loads}
    # A crash after the copy and before the rows that name it.
    copy = store.events().withColumnRenamed("load_id", "landed_by").withColumn("bucket", store._bucket())
    buckets.write(copy, store.folder("laid/load_id=crashed"), "source_table", "bucket")
    assert read() == before
    into = maintenance.compact(store)
    assert into and maintenance.compact(store) is None and read() == before
    # The old places, still there, are not read; then they go, and the unnamed copy with them.
    assert maintenance.vacuum(store) == {"loads": 3, "versions": 0} and read() == before
    for i in loads:
        assert _rows(store.raw("customers", store.spark.createDataFrame([(i,)], "load_id string"))) == by_load[i]
    _land_customers(store, capture_root, "003", ["e"], 20, "z")
    after = read()
    assert len(after["customers"]) == 6
    assert maintenance.compact(store) and read() == after  # what came since
    every = sorted(r["load_id"] for r in store.loads().collect())
    last = maintenance.compact(store, every)  # several copies become one
    assert read() == after and maintenance.vacuum(store)["loads"] == 3
    assert {r["into"] for r in store.moves().collect()} == {last} and read() == after
    with pytest.raises(ValueError):
        maintenance.compact(Warehouse(store.spark, store.root, buckets=8), every)


def test_an_update_reads_and_writes_the_touched_buckets_alone(store, capture_root):
    store = Warehouse(store.spark, store.root, buckets=8)
    keys = [f"k{n}" for n in range(40)]
    _land_customers(store, capture_root, "001", keys, 1, "x")
    maintenance.compact(store)
    first = build.build(store).version
    number = {r["k"]: r["b"] for r in store.spark.createDataFrame([(k,) for k in keys], "k string").select("k", buckets.number("k", 8).alias("b")).collect()}
    _land_customers(store, capture_root, "002", ["k3"], 100, "y")
    second = update.update(store).version
    for mart in ("dim_customers", "dim_customer_history"):
        at = publish.current(store)[mart].versions
        assert at == {b: second if b == number["k3"] else first for b in set(number.values())}
    got = {r["customer_id"]: r["city"] for r in publish.read_mart(store, "dim_customers").collect()}
    assert got == {k: "y" if k == "k3" else "x" for k in keys}
    # The scan of compacted raw leaves out the folders of other buckets.
    store.spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = store.raw("customers", only=[number["k3"]])._jdf.queryExecution().executedPlan().toString()
    store.spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = [part.split("PushedFilters")[0] for part in plan.split("PartitionFilters: [")[1:]]
    assert any("bucket" in f for f in filters)
    # The last customer of a bucket goes: the bucket is empty, not the old version's.
    alone = min(number, key=lambda k: list(number.values()).count(number[k]))
    gone = [k for k in keys if number[k] == number[alone]]
    put_changes(capture_root, "003", [change("customers", {**CUSTOMER, "customer_id": k}, 200 + n, "D") for n, k in enumerate(gone)])
    store.land_pending(capture_root)
    update.update(store)
    left = {r["customer_id"] for r in publish.read_mart(store, "dim_customers").collect()}
    assert left == set(keys) - set(gone) and number[alone] not in publish.current(store)["dim_customers"].versions
    _land_customers(store, capture_root, "004", ["k1"], 300, "z")
    with pytest.raises(ValueError):
        update.update(Warehouse(store.spark, store.root, buckets=4))


def test_only_differing_ranges_are_compared(spark):
    left = spark.range(2000).selectExpr("cast(id as string) as k", "id % 7 as v", "cast(null as string) as w")
    right = left.where("k <> '11'").selectExpr("k", "case when k = '1500' then 99 else v end as v", "w")
    columns = ["k", "v", "w"]
    got = compare.mismatches_by_range(left, right, "k", columns, leaves=256)
    assert {(r["k"], r["kind"]) for r in got.collect()} == {("11", "missing_in_target"), ("1500", "changed")}
    sums = [compare.range_sums(x, "k", columns, 256) for x in (left, right)]
    differ = compare.differing_ranges(*sums)
    assert differ.count() == 2 and compare.in_ranges(left, "k", differ, 256).count() < 60
    wider = [compare.folded(x, 16) for x in sums]
    assert wider[0].count() == 16 and 1 <= compare.differing_ranges(*wider).count() <= 2
    assert compare.mismatches_by_range(left, left, "k", columns).count() == 0


def test_commits_in_overlapping_and_repeated_loads(spark):
    noon = datetime(2024, 3, 1, 12)
    at = lambda minutes: noon + timedelta(minutes=minutes)
    loads = [("a", at(0), at(150)), ("a", at(0), at(150)), ("a", at(100), at(300)), ("b", at(10), at(5)), ("b", None, at(9))]
    commits = [("a", at(m), at(m + 1)) for m in range(-5, 310)] + [("b", at(7), at(8)), ("c", at(1), at(2)), ("a", None, at(3))]
    schema = "source_table string, {0} timestamp, {1} timestamp"
    got = intervals.commits_inside_loads(
        spark.createDataFrame(commits, schema.format("before_commit", "after_commit")),
        spark.createDataFrame(loads, schema.format("load_start", "load_end")),
        bin_seconds=900,
    ).collect()
    assert len(got) == len(commits)
    for r in got:
        held = any(
            t == r["source_table"] and s is not None and r["before_commit"] is not None and s < r["before_commit"] and r["after_commit"] < e
            for t, s, e in loads
        )
        assert r["inside_load"] == held


def test_each_commit_that_lacks_an_event_gives_a_row(spark):
    commits = spark.createDataFrame([("k", "k", "k", "x")] * 2500, "inserted string, updated string, deleted string, city string")
    staged = spark.createDataFrame([("I", "k", None, False)], "_op string, customer_id string, city string, _is_snapshot boolean")
    got = joins.missing_overlap_events(commits, staged).groupBy("_op").count().collect()
    assert {(r["_op"], r["count"]) for r in got} == {("U", 2500), ("D", 2500)}
