import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changes import rows_of
from tidemark import contract
from tidemark.functions import casts
from tidemark.operators import changelog, checks, compare, delivery, history, joins, profiles, skew

EVENT = "customer_id string, customer_unique_id string, city string, state string, postal_code string, " \
    "_op string, _source_order decimal(35,0), _event_id string, _commit_at timestamp, _is_snapshot boolean"
START = datetime(2026, 1, 1)


def random_events(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for sequence in range(1, n + 1):
        key = rnd.choice(["hot", "hot", "hot", "b", "c", None])
        rows.append((key, "p", rnd.choice(["x", "y", "", None]), "s", rnd.choice(["1", None]),
                     rnd.choice("IUUUD"), Decimal(sequence * rnd.choice([1, 1, 1000])), None,
                     START + timedelta(minutes=rnd.randrange(300)), False))
    rows = list({r[6]: r for r in rows}.values())
    rows = [(*r[:7], f"cdc:{r[6]}", *r[8:]) for r in rows]
    for n, key in enumerate(["hot", "b", "d", None]):
        when = START + timedelta(minutes=rnd.choice([-5, 100]))
        rows.append((key, "p", "x", "s", "1", "I", Decimal(0), f"snapshot:{n}", when, True))
    return rows


def brute_force(rows):
    """Versions by walking each key's events in order."""
    out = []
    for key in {r[0] for r in rows}:
        events = sorted((r for r in rows if r[0] == key), key=lambda r: (r[6], r[7]))
        first = min((r[8] for r in events if not r[9]), default=None)
        kept = []
        for r in events:
            if r[9] and first is not None and not r[8] < first:
                continue
            state = (*r[1:5], r[5] == "D")
            if not kept or kept[-1][0] != state:
                kept.append((state, r))
        for n, (_, r) in enumerate(kept):
            after = kept[n + 1][1] if n + 1 < len(kept) else None
            gone = r[5] == "D"
            out.append((r[0], r[2], r[4], r[8], after and after[8], int(r[6]), after and int(after[6]), gone, r[9],
                        after is None and not gone))
    return sorted(out, key=repr)


def shown(df):
    columns = ("customer_id", "city", "postal_code", "observed_from", "observed_to", "source_order_from",
               "source_order_to", "is_deleted", "is_initial_snapshot", "is_current")
    rows = []
    for r in df.select(*columns).collect():
        r = list(r)
        r[5], r[6] = int(r[5]), r[6] if r[6] is None else int(r[6])
        rows.append(tuple(r))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history_equals_brute_force_on_both_routes(spark, seed):
    rows = random_events(seed)
    events = spark.createDataFrame(rows, EVENT)
    expected = brute_force(rows)
    assert shown(history.customer_history(events)) == expected
    for options in ({"heavy_rows": 50, "slice_rows": 20, "grid": 200}, {"heavy_rows": 0, "slice_rows": 7, "grid": 100}):
        slicing = history.Slicing.of(events, "customer_id", **options)
        assert shown(history.customer_history(events, slicing)) == expected


def test_planning_runs_no_job(spark):
    events = spark.createDataFrame(random_events(5), EVENT)
    orders = spark.createDataFrame([("x", "A")], "order_id string, customer_id string")
    people = spark.createDataFrame([("A", "", "", "", "")], "customer_id string, " + ", ".join(
        f"{c} string" for c in contract.SOURCE_COLUMNS["customers"][1:]))
    spark.sparkContext.setJobGroup("planning", "")
    try:
        slicing = history.Slicing.of(events, "customer_id", heavy_rows=50, slice_rows=20)
        explicit = len(spark.sparkContext.statusTracker().getJobIdsForGroup("planning"))
        assert explicit > 0 and slicing.heavy is not None
        for use in (None, slicing):
            timed = history.with_first_change(events, "customer_id", use)
            changes = history.detect_changes(timed, "customer_id", contract.CUSTOMER_ATTRIBUTES, use)
            history.with_bounds(changes, "customer_id", use)
            history.customer_history(events, use)
        joins.orders_with_customer(orders, people)
        joins.orphans(orders, "customer_id", people, "customer_id")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == explicit
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_history_steps_agree_for_heavy_keys(spark):
    events = spark.createDataFrame(random_events(4), EVENT)
    slicing = history.Slicing.of(events, "customer_id", heavy_rows=50, slice_rows=20, grid=200)
    attributes = contract.CUSTOMER_ATTRIBUTES
    plain = history.detect_changes(events, "customer_id", attributes)
    sliced = history.detect_changes(events, "customer_id", attributes, slicing)
    assert plain.columns == sliced.columns and compare.same_content(plain, sliced).first()["equal"]
    timed = history.with_first_change(events, "customer_id")
    split = history.with_first_change(events, "customer_id", slicing)
    assert compare.same_content(timed, split).first()["equal"]
    # NULL keys are a group of their own, as in a window.
    assert timed.filter("customer_id is null and first_cdc_at is null").isEmpty()
    bounds = history.with_bounds(plain, "customer_id")
    cut = history.with_bounds(plain, "customer_id", slicing)
    assert bounds.columns == cut.columns and compare.same_content(bounds, cut).first()["equal"]


def test_slices_are_small_and_keep_the_order(spark):
    events = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise(F.lit("hot")).alias("k"),
        (F.col("id") * F.col("id")).cast("decimal(35,0)").alias("o"),
        F.lit("").alias("t"),
    )
    heavy = skew.heavy_keys(events, "k", 100, *skew.order_span("o", "t"))
    assert [r[0] for r in heavy.select("_heavy_key").collect()] == ["hot"]
    sliced = skew.order_slices(events, "k", "o", "t", heavy, slice_rows=500)
    groups = sliced.groupBy("_slice").agg(F.count("*").alias("n"), F.min("o").alias("lo"), F.max("o").alias("hi"))
    rows = groups.orderBy("_slice").collect()
    assert len(rows) == 14 and sum(r["n"] for r in rows) == 6666 and max(r["n"] for r in rows) < 600
    assert all(a["hi"] < b["lo"] for a, b in zip(rows, rows[1:]))
    assert skew.without_keys(events, "k", heavy).count() == 10_000 - 6666


def test_slices_stay_small_beyond_one_grid(spark):
    events = spark.range(5_000).select(
        F.when(F.col("id") < 4_000, F.lit("hot")).otherwise(F.lit("warm")).alias("k"),
        (F.col("id") * 7919 % 5_003).cast("decimal(35,0)").alias("o"),
        F.lit("").alias("t"),
    )
    heavy = skew.heavy_keys(events, "k", 100, *skew.order_span("o", "t"))
    sliced = skew.order_slices(events, "k", "o", "t", heavy, slice_rows=100, grid=10)
    groups = sliced.groupBy("k", "_slice").agg(F.count("*").alias("n"), F.min("o").alias("lo"), F.max("o").alias("hi"))
    for key, total in (("hot", 4_000), ("warm", 1_000)):
        rows = groups.filter(F.col("k") == key).orderBy("_slice").collect()
        assert sum(r["n"] for r in rows) == total and max(r["n"] for r in rows) < 300
        assert all(a["hi"] < b["lo"] for a, b in zip(rows, rows[1:]))


def test_equal_tables_are_compared_without_dealing_out_rows(spark):
    rows = [(i % 50, None if i % 7 == 0 else str(i % 30), float(i % 3)) for i in range(300)]
    left = spark.createDataFrame(rows, "a long, b string, c double")
    same = compare.same_content(left, left.orderBy(F.desc("a")).repartition(3))
    assert tuple(same.first()) == (0, 0, True)
    plan = same._jdf.queryExecution().executedPlan()
    assert "== Final Plan" not in plan.toString() or "hashpartitioning(a#" not in plan.toString().split("== Initial Plan")[0]
    other = spark.createDataFrame([*rows[:-2], rows[0], (1, "", -0.0)], left.schema)
    assert tuple(compare.same_content(left, other).first()) == (2, 2, False)
    zero = spark.createDataFrame([(0.0, 1)], "c double, n int")
    assert compare.same_content(zero, spark.createDataFrame([(-0.0, 1)], "c double, n long")).first()["equal"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_limit_groups_before_the_shuffle(spark):
    events = spark.createDataFrame(random_events(1), EVENT).withColumn("_source_file", F.lit("f"))
    assert plan_of(changelog.deduplicate_events(events)).count("WindowGroupLimit") == 2
    latest = plan_of(changelog.current_state(events, "customer_id"))
    assert latest.count("WindowGroupLimit") == 2 and latest.count("Exchange hashpartitioning") == 1
    # Deletions are dropped after the rank, never below it.
    assert latest.index("NOT (_op") < latest.index("WindowGroupLimit")


def test_plain_history_takes_one_shuffle_and_one_sort(spark):
    events = spark.createDataFrame(random_events(1), EVENT)
    plan = plan_of(history.customer_history(events))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_row_checksums_tell_types_places_and_copies_apart_without_texts(spark):
    amounts, cents = spark.sql("select cast(1 as decimal(10,2)) as n"), spark.sql("select 100L as n")
    assert tuple(compare.same_content(amounts, cents).first()) == (1, 1, False)
    assert compare.same_content(spark.sql("select 1 as n"), spark.sql("select 1L as n")).first()["equal"]
    texts = [spark.createDataFrame([row], "a string, b string") for row in (("ab", "c"), ("a", "bc"), ("c", "ab"), ("ab", None), (None, "ab"))]
    for n, left in enumerate(texts):
        assert [compare.same_content(left, right).first()["equal"] for right in texts] == [n == m for m in range(len(texts))]
    once, twice = texts[0], texts[0].unionAll(texts[0])
    assert tuple(compare.same_content(once, twice).first()) == (0, 1, False)
    assert "md5" not in plan_of(compare.same_content(once, twice)).lower()


def test_same_content_counts_copies_and_nulls(spark):
    left = spark.createDataFrame([("a", None), ("a", None), ("b", "")], "k string, v string")
    right = spark.createDataFrame([("a", None), ("b", None)], "k string, v string")
    assert tuple(compare.same_content(left, right).first()) == (2, 1, False)
    assert tuple(compare.same_content(left, left).first()) == (0, 0, True)


@pytest.mark.parametrize("source,target,expected", [
    ([("k1", None)], [("k1", None)], (1, 1, 0, 0, 0, None, True)),
    ([("k1", "old")], [("k1", "new")], (1, 1, 0, 0, 1, "k1", False)),
    ([("k1", None)], [("k1", "")], (1, 1, 0, 0, 1, "k1", False)),
    ([("k1", "x"), ("c0", "x")], [("k1", "x")], (2, 1, 1, 0, 0, "c0", False)),
    ([], [("k1", "x")], (0, 1, 0, 1, 0, "k1", False)),
    ([], [], (0, 0, 0, 0, 0, None, True)),
])
def test_reconcile(spark, source, target, expected):
    schema = "k string, v string"
    result = compare.reconcile(spark.createDataFrame(source, schema), spark.createDataFrame(target, schema), "k", ["v"])
    row = result.first()
    assert (row["source_rows"], row["target_rows"], row["missing_in_target"], row["missing_in_source"],
            row["changed"], row["first_mismatch"], row["all_fields_match"]) == expected


def test_reconcile_compares_instants(spark):
    def side(text):
        return spark.createDataFrame([("k1", text)], "k string, t string").select("k", casts.source_instant(F.col("t")).alias("t"))

    same = compare.reconcile(side("2026-01-01T00:00:00Z"), side("2026-01-01T03:00:00+03:00"), "k", ["t"])
    assert same.first()["all_fields_match"]
    changed = compare.mismatches(side("2026-01-01T00:00:00Z"), side("2026-01-01T00:00:01Z"), "k", ["t"])
    assert [tuple(r) for r in changed.collect()] == [("k1", "changed", ["t"])]


def test_state_diff_carries_the_old_image_of_a_delete(spark):
    before = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", None)], "k string, v string")
    after = spark.createDataFrame([("a", "2"), ("c", None), ("d", None)], "k string, v string")
    assert rows_of(compare.diff_states(before, after, "k", ["v"]), "_op", "k", "v") == [
        ("D", "b", "1"), ("I", "d", None), ("U", "a", "2")]


CURRENT = ("k1", "h77", "tandil", "BA", "07000")
DIMENSION = "customer_id string, customer_unique_id string, city string, state string, postal_code string"


def violations(spark, current, active):
    dimension = spark.createDataFrame([current], DIMENSION)
    versions = spark.createDataFrame([active], DIMENSION).withColumn("is_current", F.lit(True))
    return [r[0] for r in checks.history_vs_dimension(dimension, versions).collect()]


def test_history_check_sees_every_attribute_and_null_against_empty(spark):
    for index in range(1, 5):
        for old, new in ((CURRENT[index], "different"), (None, ""), ("", None)):
            current, active = list(CURRENT), list(CURRENT)
            current[index], active[index] = old, new
            assert violations(spark, tuple(current), tuple(active)) == ["k1"]
    for row in (CURRENT, ("k1", None, None, None, None), ("k1", "", "", "", "")):
        assert violations(spark, row, row) == []
    assert violations(spark, (None, *CURRENT[1:]), (None, *CURRENT[1:])) == [None]


def test_commits_must_fit_inside_the_load(spark):
    def t(seconds):
        return START + timedelta(seconds=seconds)

    commits = spark.createDataFrame(
        [(1, "t", t(2), t(3)), (2, "t", t(0), t(3)), (3, "t", t(2), t(11)), (4, "other", t(2), t(3))],
        "n int, source_table string, before_commit timestamp, after_commit timestamp")
    loads = spark.createDataFrame([("t", t(0), t(10))], "source_table string, load_start timestamp, load_end timestamp")
    assert rows_of(joins.commits_inside_load(commits, loads), "n", "inside_load") == [
        (1, True), (2, False), (3, False), (4, False)]


def test_overlap_events_are_expected_exactly_once(spark):
    staged = spark.createDataFrame(
        [("new", "I", None), ("c", "U", "x"), ("c", "U", "y"), ("old", "D", "z"), ("old", "D", "w")],
        "customer_id string, _op string, city string").withColumn("_is_snapshot", F.lit(False))
    commits = spark.createDataFrame([("new", "c", "old", "x"), ("none", "c", "new", "q")],
                                    "inserted string, updated string, deleted string, city string")
    assert rows_of(joins.missing_overlap_events(commits, staged), "_op", "customer_id", "staged_events") == [
        ("D", "new", 0), ("D", "old", 2), ("I", "none", 0), ("U", "c", 0)]


def test_lineage_and_manifest(spark):
    schema = "_event_id string, _source_order decimal(35,0), _is_snapshot boolean"
    base = spark.createDataFrame([("a", Decimal(10), False)], schema)
    new = spark.createDataFrame([("b", Decimal(10), False), ("c", Decimal(11), False), ("s", Decimal(0), True)], schema)
    assert rows_of(delivery.lineage_violations(new, base), "_event_id") == [("b",)]
    old = spark.createDataFrame([("r/cdc/a.csv", 1), ("r/cdc/b.csv", 2), ("r/cdc/c.csv", 3)], "path string, size long")
    now = spark.createDataFrame([("r/cdc/a.csv", 1), ("r/cdc/b.csv", 9), ("r/cdc/d.csv", 4), ("r/initial-load/t/e.csv", 5)], "path string, size long")
    diff = delivery.manifest_diff(old, now)
    assert rows_of(delivery.capture_violations(diff), "path", "state") == [
        ("r/cdc/b.csv", "changed"), ("r/cdc/c.csv", "removed"), ("r/initial-load/t/e.csv", "added")]


def test_orphan_keys_count_rows_and_ignore_null(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",)], "pk string")
    assert rows_of(joins.orphan_keys(child, "fk", parent, "pk"), "fk", "child_rows") == [("b", 2)]
    assert joins.orphans(child, "fk", parent, "pk").count() == 2


def test_lookup_join_is_the_same_for_heavy_keys(spark):
    facts = spark.createDataFrame([("hot", n) for n in range(20)] + [("a", 1), ("x", 2), (None, 3)], "k string, n int")
    dimension = spark.createDataFrame([("hot", "H"), ("a", "A"), ("b", "B")], "d string, v string")
    missing = dimension.filter("d <> 'hot'")
    hot = skew.known(skew.heavy_keys(facts, "k", 5))
    for how in ("inner", "left_anti", "left"):
        for right in (dimension, missing):
            plain = skew.lookup_join(facts, right, "k", "d", how)
            heavy = skew.lookup_join(facts, right, "k", "d", how, hot)
            assert rows_of(plain, "*") == rows_of(heavy, "*")
    plan = plan_of(skew.lookup_join(facts, dimension, "k", "d", "inner", hot))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_details_do_not_multiply(spark):
    orders = spark.createDataFrame([("r1",), ("r2",)], "order_id string")
    for column in contract.SOURCE_COLUMNS["orders"][1:]:
        orders = orders.withColumn(column, F.lit(None).cast("string"))
    items = spark.createDataFrame([("r1", Decimal(50), Decimal(5))] * 2, "order_id string, price decimal(14,2), freight_value decimal(14,2)")
    payments = spark.createDataFrame([("r1", Decimal(60)), ("r1", Decimal(50))], "order_id string, payment_value decimal(14,2)")
    facts = joins.fct_orders(orders, items, payments)
    assert rows_of(facts, "order_id", "order_total", "payment_total", "item_count", "payment_count") == [
        ("r1", Decimal("110.00"), Decimal("110.00"), 2, 2), ("r2", Decimal("0.00"), Decimal("0.00"), 0, 0)]
    assert "BroadcastNestedLoop" not in plan_of(facts) and "CartesianProduct" not in plan_of(facts)


def test_intervals_and_row_keys(spark):
    versions = spark.createDataFrame(
        [("ok", 1, 2, START, START), ("seq", 2, 2, START, START), ("time", 1, 2, START, START - timedelta(1)), ("open", 1, None, START, None)],
        "customer_version_id string, source_order_from long, source_order_to long, observed_from timestamp, observed_to timestamp")
    assert rows_of(checks.check_intervals(versions), "customer_version_id") == [("seq",), ("time",)]
    keys = spark.createDataFrame([("o:1", "o", 1), ("o:2", "o", 1)], "k string, p string, n int")
    assert rows_of(checks.check_row_key(keys, "k", "p", "n"), "k") == [("o:2",)]
    assert rows_of(checks.check_pair_unique(keys, "p", "n"), "p", "n", "copies") == [("o", 1, 2)]


def test_gate_reports_only_real_violations(spark):
    df = spark.createDataFrame([("I",), ("X",), (None,)], "_op string")
    results = checks.row_checks(df, "m", {("accepted_values", "_op"): checks.not_accepted("_op", "IUD"),
                                          ("not_null", "_op"): checks.is_null("_op")})
    with pytest.raises(checks.CheckFailure) as failure:
        checks.gate(results)
    assert {r["check"] for r in failure.value.failures} == {"accepted_values", "not_null"}
    assert len(checks.gate(results, allow=("accepted_values", "not_null"))) == 2


def test_fingerprint_ignores_order_only(spark):
    a = spark.createDataFrame([("a", None), ("b", "")], "k string, v string")
    b = spark.createDataFrame([("b", ""), ("a", None)], "k string, v string")
    c = spark.createDataFrame([("b", None), ("a", "")], "k string, v string")
    prints = [tuple(compare.fingerprint(df).first()) for df in (a, b, c)]
    assert prints[0] == prints[1] != prints[2]


def test_cycles_count_an_event_once(spark):
    events = spark.createDataFrame([("t", "e1", 1), ("t", "e2", 1), ("t", "e1", 2), ("t", "e3", 2)],
                                   "source_table string, _event_id string, cycle int")
    assert rows_of(delivery.cycle_counts(events, "cycle"), "cycle", "new_events", "total_events") == [(1, 2, 2), (2, 1, 3)]


def test_people_and_records(spark):
    df = spark.createDataFrame([("p",), ("p",), (None,)], "customer_unique_id string")
    assert tuple(profiles.people_vs_records(df).first()) == (3, 1)
