import hashlib

import pytest
from pyspark.sql import functions as F

from changes import CUSTOMER, DAY0, NULL, change, put, put_changes, put_snapshot, snapshot
from tidemark import contract
from tidemark.sources import capture


def read(spark, root):
    files = [(r["path"], r["size"]) for r in capture.capture_manifest(spark, root).collect()]
    return capture.read_events(spark, root, files)


def test_quotes_commas_null_and_empty_survive(spark, capture_root):
    data = {**CUSTOMER, "city": 'tandil, "Central"\nAndar 2', "postal_code": NULL, "state": ""}
    put_changes(capture_root, "a", [change("customers", data, 1)])
    row = capture.table_events(read(spark, capture_root), "customers").first()
    assert row["city"] == 'tandil, "Central"\nAndar 2'
    assert row["postal_code"] is None and row["state"] == ""
    assert row["_event_id"] == "cdc:customers:1"


@pytest.mark.parametrize("legacy", [False, True])
def test_bad_envelopes_name_their_problem(spark, capture_root, legacy):
    good = change("customers", CUSTOMER, 1, legacy=legacy)
    cases = {}

    def case(name, problem, edit, row=good):
        bad = list(row)
        edit(bad)
        cases[name] = problem
        put_changes(capture_root, name, [bad])

    for n, sequence in enumerate(["", "0", "-1", "not-a-sequence", "1" * 36, NULL]):
        case(f"seq{n}", "no positive change sequence", lambda r, s=sequence: r.__setitem__(-2, s))
    case("commit", "missing commit time", lambda r: r.__setitem__(-1, NULL))
    case("empty_commit", "missing commit time", lambda r: r.__setitem__(-1, ""))
    case("bad_commit", "invalid commit time", lambda r: r.__setitem__(-1, "invalid"))
    case("schema", "unexpected schema", lambda r: r.__setitem__(2, "unrelated"))
    case("null_schema", "unexpected schema", lambda r: r.__setitem__(2, NULL))
    case("op", "unsupported table or operation", lambda r: r.__setitem__(0, "X"))
    case("table", "unsupported table or operation", lambda r: r.__setitem__(1, "refunds"))
    case("extra", "unexpected number of fields", lambda r: r.extend(["x", "y"]))
    case("short", "missing operation, table or schema", lambda r: r.__delitem__(slice(2, None)))
    case("wide", "source value is too wide", lambda r: r.__setitem__(6, "x" * 257))
    put_snapshot(capture_root, "customers", [snapshot("customers", CUSTOMER, op="U", legacy=legacy)])
    put(capture_root, "elsewhere/x.csv", [good])
    put_snapshot(capture_root, "unknown", [snapshot("customers", CUSTOMER)])

    found = {
        r["_source_file"].rsplit("/", 1)[1].removesuffix(".csv"): r["_problem"]
        for r in read(spark, capture_root).filter("_source_file not like '%unknown%'").collect()
    }
    assert found == {**cases, "LOAD00000001": "snapshots hold inserts only", "x": "unexpected capture path"}
    unknown = read(spark, capture_root).filter("_source_file like '%unknown%'").first()
    assert unknown["_problem"] == "unexpected capture path"


def test_layouts_give_identical_events(spark, capture_root, tmp_path):
    roots = {}
    for legacy in (False, True):
        root = roots[legacy] = str(tmp_path / f"legacy-{legacy}")
        for table in contract.TABLES:
            names = contract.source_columns(table)
            data = dict(zip(names, ["key", "value", NULL, 'São Paulo, "Centro"\nAndar 2', ""]))
            data = {n: data.get(n, "value") for n in names}
            rows = [change(table, data, n, op, DAY0, legacy) for n, op in ((123, "I"), (124, "U"), (125, "D"))]
            put_changes(root, table, rows)
            put_snapshot(root, table, [snapshot(table, data, legacy=legacy)])
    shown = {}
    for legacy, root in roots.items():
        events = read(spark, root).withColumn("_source_file", F.regexp_extract("_source_file", "[^/]+$", 0))
        assert events.filter("_problem is not null").count() == 0
        shown[legacy] = sorted(map(tuple, events.collect()), key=repr)
    assert shown[False] == shown[True] and len(shown[True]) == 16


def test_schema_label_does_not_make_a_snapshot(spark, capture_root):
    row = change("customers", CUSTOMER, 123, "U")
    row[2] = "initial-load"
    put_changes(capture_root, "a", [row])
    event = read(spark, capture_root).first()
    assert event["_problem"] is None and event["_is_snapshot"] is False
    assert event["_event_id"] == "cdc:customers:123"


def test_missing_keys_keep_their_own_identity(spark, capture_root):
    rows = [snapshot("customers", {**CUSTOMER, "customer_id": k}) for k in (NULL, NULL, "")]
    rows.insert(1, [])  # a blank record counts in the numbering
    put_snapshot(capture_root, "customers", rows)
    put_changes(capture_root, "a", [change("customers", {**CUSTOMER, "customer_id": k}, n) for n, k in ((1, NULL), (2, ""))])
    events = {r["_event_id"]: r for r in read(spark, capture_root).collect()}
    file = next(r["_source_file"] for r in events.values() if r["_is_snapshot"])
    digest = lambda n: hashlib.sha256(f"{file}:{n}".encode()).hexdigest()
    expected = {f"snapshot-missing-key:customers:{digest(n)}" for n in (1, 3, 4)}
    assert set(events) == expected | {"cdc:customers:1", "cdc:customers:2"}
    assert all(len(i) <= contract.EVENT_ID_WIDTH for i in events)


def test_long_composite_snapshot_key(spark, capture_root):
    key = "a" * 32 + ":2147483647"
    put_snapshot(capture_root, "order_payments", [snapshot("order_payments", {"payment_key": key}, legacy=True)])
    event = read(spark, capture_root).first()
    assert event["_event_id"] == f"snapshot:order_payments:{key}" and event["_problem"] is None


def test_sequence_keeps_its_text_in_the_id(spark, capture_root):
    digits = "0700045678901234567890123456789012"
    row = change("customers", CUSTOMER, 1, when="2026-01-01T03:00:00.123456+03:00")
    row[-2] = digits
    put_changes(capture_root, "a", [row])
    event = read(spark, capture_root).first()
    assert event["_event_id"] == f"cdc:customers:{digits}"
    assert int(event["_source_order"]) == int(digits)
    assert event["updated_at"] == "2026-01-01T03:00:00.123456+03:00"


def test_empty_capture_is_an_error(spark, capture_root):
    put(capture_root, "cdc/readme.txt", "x")
    with pytest.raises(FileNotFoundError, match="no capture files"):
        capture.require_files(capture.capture_manifest(spark, capture_root))


def test_manifest_lists_every_csv_and_reads_none(spark, capture_root):
    names = ("cdc/a.csv", "cdc/_b.csv", "cdc/.c.csv", "initial-load/orders/LOAD 1;x.csv", "else/where/d.csv")
    for name in names:
        put(capture_root, name, [change("customers", CUSTOMER, 1)])
    put(capture_root, "cdc/zero.csv", "")
    put(capture_root, "cdc/e.txt", "x")
    manifest = capture.capture_manifest(spark, capture_root)
    assert "FileScan" not in manifest._jdf.queryExecution().executedPlan().toString()
    found = {r["path"].removeprefix(f"file:{capture_root}/"): r["size"] for r in manifest.collect()}
    assert set(found) == {*names, "cdc/zero.csv"} and found["cdc/zero.csv"] == 0 < found["cdc/_b.csv"]
