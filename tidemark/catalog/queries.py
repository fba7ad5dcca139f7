"""Every operator as a query over the analytic tables, with its SQL twin.

``query(sql)`` registers a function under its own name; the SQL is completed by
``oracle.statement``.  Queries without SQL are checked by tests instead.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.catalog import oracle
from tidemark.catalog.context import EXPORT, Context, present
from tidemark.functions import casts, identity
from tidemark.operators import changelog, checks, compare, delivery, history, intervals, joins, profiles, skew
from tidemark.plans import build, layers, lifecycle, publish, update
from tidemark.session import work_folder
from tidemark.sources import baseline, capture, records, sinks, sketches, warehouse
from tidemark.streaming import batches, ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _register(name: str, sql: str | None, build: Callable[[Context], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: present(build(Context(spark, folder)))
    if sql is not None:
        ORACLE[name] = oracle.statement(sql)


def query(sql: str | None = None):
    def register(build: Callable[[Context], DataFrame]):
        _register(build.__name__, sql, build)
        return build

    return register


# Layers ------------------------------------------------------------------------

for _t in contract.TABLES:
    _register(f"stg_{_t}", f"select * from stg_{_t}", lambda c, t=_t: c.staged[t])
    _register(
        f"int_{_t}_current",
        f"select * from cur_{_t}",
        lambda c, t=_t: changelog.live_rows(c.staged[t], t),
    )
    _register(f"int_{_t}_current_short_route", f"select * from cur_{_t}", lambda c, t=_t: c.live[t])
    _register(
        f"dedup_raw_{_t}",
        f"select * from raw_{_t} qualify row_number() over (partition by _event_id order by _source_file) = 1",
        lambda c, t=_t: changelog.deduplicate_events(c.raw[t]),
    )

for _m in contract.MARTS:
    _register(_m, f"select * from {_m}", lambda c, m=_m: c.marts[m])


@query("select * from dim_customer_history")
def dim_customer_history_sliced(c: Context) -> DataFrame:
    """The route of keys too big for one task, taken by every key above 20 events."""
    slicing = history.Slicing.of(c.raw["customers"], "customer_id", heavy_rows=20, slice_rows=15)
    return history.customer_history(c.raw["customers"], slicing)


@query("select * from dim_customer_history")
def dim_customer_history_from_staging(c: Context) -> DataFrame:
    return history.customer_history(c.staged["customers"])


@query(f"select {oracle.version_columns('order_id', 'version_id', ('status',))} from order_bounded")
def order_status_history(c: Context) -> DataFrame:
    """The same history operator with another key and attribute."""
    return history.scd2_history(c.staged["orders"], "order_id", ["status"])


@query("select * from fct_orders")
def registered_views(c: Context) -> DataFrame:
    layers.register_views(c.spark, c.raw)
    return c.spark.sql("select * from fct_orders")


# Casts --------------------------------------------------------------------------


@query(
    "select order_item_key, _event_id, _source_file, cast(price as decimal(14,2)) as price, "
    "cast(freight_value as decimal(14,2)) as freight_value from raw_order_items"
)
def money_cast(c: Context) -> DataFrame:
    money = [casts.source_money(F.col(n)).alias(n) for n in ("price", "freight_value")]
    return c.raw["order_items"].select("order_item_key", "_event_id", "_source_file", *money)


@query("select payment_key, cast(payment_installments as integer) as payment_installments from raw_order_payments")
def integer_cast(c: Context) -> DataFrame:
    value = casts.source_integer(F.col("payment_installments")).alias("payment_installments")
    return c.raw["order_payments"].select("payment_key", value)


@query(
    "select _event_id, _source_file, cast(approved_at as timestamp) as approved_at, "
    "cast(carrier_delivered_at as timestamp) as carrier_delivered_at from raw_orders"
)
def naive_timestamp_cast(c: Context) -> DataFrame:
    times = [casts.source_timestamp(F.col(n)).alias(n) for n in ("approved_at", "carrier_delivered_at")]
    return c.raw["orders"].select("_event_id", "_source_file", *times)


@query("select _event_id, _source_file, updated_at from typed_orders")
def instant_cast(c: Context) -> DataFrame:
    value = casts.source_instant(F.col("updated_at")).alias("updated_at")
    return c.raw["orders"].select("_event_id", "_source_file", value)


@query(
    """select count(*) as deliveries,
         count(*) filter (where cast(order_item_id as integer) % 3 = 0) as bad_money,
         count(*) filter (where cast(order_item_id as integer) % 3 = 1) as bad_integer,
         count(*) filter (where cast(order_item_id as integer) % 2 = 0) as bad_timestamp,
         count(*) filter (where cast(order_item_id as integer) % 5 = 0) as bad_instant
       from raw_order_items"""
)
def refused_values(c: Context) -> DataFrame:
    """Text that breaks its type, planted in every third, second or fifth row."""
    part = F.col("order_item_id").cast("int")
    planted = c.raw["order_items"].select(
        F.when(part % 3 == 0, F.concat("price", F.lit("1"))).otherwise(F.col("price")).alias("money"),
        F.when(part % 3 == 1, F.concat("order_item_id", F.lit(".5"))).otherwise(F.col("order_item_id")).alias("number"),
        F.when(part % 2 == 0, F.concat("shipping_limit_at", F.lit("+03:00")))
        .otherwise(F.col("shipping_limit_at"))
        .alias("naive"),
        F.when(part % 5 == 0, F.lit("12:30")).otherwise(F.col("updated_at")).alias("instant"),
    )
    return planted.agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.count_if(casts.bad_money(F.col("money"))).alias("bad_money"),
        F.count_if(casts.bad_integer(F.col("number"))).alias("bad_integer"),
        F.count_if(casts.bad_timestamp(F.col("naive"))).alias("bad_timestamp"),
        F.count_if(casts.bad_instant(F.col("instant"))).alias("bad_instant"),
    )


# History steps --------------------------------------------------------------------


@query("select _event_id, customer_id, first_cdc_at from timed")
def first_change_per_key(c: Context) -> DataFrame:
    timed = history.with_first_change(c.staged["customers"], "customer_id")
    return timed.select("_event_id", "customer_id", "first_cdc_at")


@query("select _event_id from kept")
def unambiguous_events(c: Context) -> DataFrame:
    timed = history.with_first_change(c.staged["customers"], "customer_id")
    return history.drop_ambiguous_snapshots(timed).select("_event_id")


def _unambiguous(c: Context) -> DataFrame:
    return history.drop_ambiguous_snapshots(history.with_first_change(c.staged["customers"], "customer_id"))


@query("select _event_id, customer_id, city from changes")
def attribute_changes(c: Context) -> DataFrame:
    found = history.detect_changes(_unambiguous(c), "customer_id", contract.CUSTOMER_ATTRIBUTES)
    return found.select("_event_id", "customer_id", "city")


@query(
    "select _event_id, _commit_at as observed_from, observed_to, _source_order as source_order_from, source_order_to from bounded"
)
def version_bounds(c: Context) -> DataFrame:
    found = history.detect_changes(_unambiguous(c), "customer_id", contract.CUSTOMER_ATTRIBUTES)
    bounds = ("observed_from", "observed_to", "source_order_from", "source_order_to")
    return history.with_bounds(found, "customer_id").select("_event_id", *bounds)


@query("select _event_id, customer_id, city from changes")
def attribute_changes_sliced(c: Context) -> DataFrame:
    """Keys above 20 events compared across slice edges."""
    events = _unambiguous(c)
    slicing = history.Slicing.of(events, "customer_id", heavy_rows=20, slice_rows=15, grid=1000)
    found = history.detect_changes(events, "customer_id", contract.CUSTOMER_ATTRIBUTES, slicing)
    return found.select("_event_id", "customer_id", "city")


_TIED = """select o_custkey % 3 as k, o_orderkey, {order} as seq from orders"""


@query(
    "select kind, cast(count(*) as bigint) as versions, cast(sum(case when later is null then 1 else 0 end) as bigint) as open_ones from ("
    + " union all ".join(
        f"select '{kind}' as kind, k, lead(seq) over (partition by k order by seq, lpad(cast(o_orderkey as varchar), 12, '0')) as later from ("
        + _TIED.format(order=order)
        + ")"
        for kind, order in (("equal", "0"), ("long", "o_orderkey"))
    )
    + ") group by kind"
)
def history_of_tied_sequences(c: Context) -> DataFrame:
    """Three heavy keys whose sequences are all equal, or neighbouring numbers of 35 digits; slices stay small."""
    rows = c.table("orders").select((F.col("o_custkey") % 3).cast("string").alias("k"), "o_orderkey")
    base = F.lit("12345678901234567890123456000000000").cast(contract.SEQUENCE_TYPE)
    parts = []
    for kind, order in (("equal", F.lit(0)), ("long", base + F.col("o_orderkey"))):
        events = rows.select(
            "k",
            F.col("o_orderkey").cast("string").alias("v"),
            F.lit("U").alias("_op"),
            order.cast(contract.SEQUENCE_TYPE).alias("_source_order"),
            F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("_event_id"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("_commit_at"),
            F.lit(False).alias("_is_snapshot"),
        )
        slicing = history.Slicing.of(events, "k", heavy_rows=100, slice_rows=100, grid=1000)
        largest = slicing.cut(events, "k").groupBy("k", "_slice").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if largest > 300:
            raise AssertionError(f"{kind}: a slice of {largest} rows")
        found = history.scd2_history(events, "k", ["v"], slicing=slicing)
        parts.append(found.groupBy(F.lit(kind).alias("kind")).agg(
            F.count(F.lit(1)).alias("versions"), F.count_if(F.col("source_order_to").isNull()).alias("open_ones")))
    return profiles.union_tables(parts)


@query("select _event_id, attribute_hash from hashed")
def attribute_hash(c: Context) -> DataFrame:
    hashed = identity.attribute_hash(contract.CUSTOMER_ATTRIBUTES).alias("attribute_hash")
    return _unambiguous(c).select("_event_id", hashed)


@query("select _event_id, md5(customer_id || ':' || cast(_source_order as varchar)) as version_id from stg_customers")
def version_id(c: Context) -> DataFrame:
    return c.staged["customers"].select("_event_id", identity.version_id("customer_id").alias("version_id"))


# Scalar functions -------------------------------------------------------------------


@query(
    "select l_orderkey || ':' || l_linenumber as row_key, count(*) as n from lineitem group by l_orderkey, l_linenumber"
)
def row_key(c: Context) -> DataFrame:
    key = identity.row_key(F.col("l_orderkey").cast("string"), F.lpad(F.col("l_linenumber").cast("string"), 3, "0"))
    return c.table("lineitem").groupBy(key.alias("row_key")).agg(F.count(F.lit(1)).alias("n"))


@query("select _event_id, nullif(city, '') as city, nullif(postal_code, '') as postal_code from stg_customers")
def empty_to_null(c: Context) -> DataFrame:
    read = [identity.empty_to_null(F.col(n)).alias(n) for n in ("city", "postal_code")]
    return c.staged["customers"].select("_event_id", *read)


@query("select _event_id, case when state = 'N3' then null else state end as state from stg_customers")
def null_token(c: Context) -> DataFrame:
    return c.staged["customers"].select("_event_id", identity.decode_null(F.col("state"), "N3").alias("state"))


@query("select event_id, sha256(event_type || ':' || user_id) as digest from events")
def file_line_digest(c: Context) -> DataFrame:
    digest = identity.file_line_digest(F.col("event_type"), F.col("user_id")).alias("digest")
    return c.table("events").select("event_id", digest)


@query(
    """select event_id, user_id <> 0 and event_id % 4 <> 0 as ok from events"""
)
def sequence_test(c: Context) -> DataFrame:
    number = F.col("event_id")
    text = F.when(number % 4 == 0, F.concat(F.lit("-"), F.col("user_id"))).otherwise(F.col("user_id").cast("string"))
    return c.table("events").select("event_id", identity.is_sequence(text).alias("ok"))


@query(f"select _event_id, {oracle.prefixed('customer_id', 'city', 'postal_code')} as canonical from stg_customers")
def canonical_text(c: Context) -> DataFrame:
    text = identity.length_prefixed(["customer_id", "city", "postal_code"]).alias("canonical")
    return c.staged["customers"].select("_event_id", text)


# Aggregates ---------------------------------------------------------------------------


@query("select * from item_totals")
def item_totals(c: Context) -> DataFrame:
    return profiles.item_totals(c.live["order_items"])


@query("select * from payment_totals")
def payment_totals(c: Context) -> DataFrame:
    return profiles.payment_totals(c.live["order_payments"])


def _per_table(select: str) -> str:
    return " union all ".join(select.format(t=t) for t in contract.TABLES)


@query(
    _per_table(
        """select '{t}' as source_table, count(*) as raw_rows, count(distinct _event_id) as unique_events,
             max(_source_order) as max_order, (select count(*) from stg_{t}) as staged_rows,
             (select count(distinct _event_id) from stg_{t}) as staged_unique, true as staged_is_unique from raw_{t}"""
    )
)
def delivery_profile(c: Context) -> DataFrame:
    return profiles.delivery_profile(c.stored_raw, c.stored_staged)


@query(
    "select customer_id, _op, count(*) as events, count(distinct _event_id) as unique_events from stg_customers "
    "where not _is_snapshot group by customer_id, _op"
)
def operation_counts(c: Context) -> DataFrame:
    return profiles.operation_counts(c.staged["customers"], "customer_id")


@query(
    """select 'customers' as source_table, 'cdc:customers:' || (event_id + 1) as _event_id from events
       where (event_id + 1) % 7 = 0 and event_id % 3 = 0"""
)
def conflicting_copies(c: Context) -> DataFrame:
    """Redelivered copies of every third event get another city; raw keeps both."""
    raw = c.raw["customers"]
    replayed = F.col("_source_file") == "cdc/replay-000.csv"
    moved = replayed & ((F.col("_source_order") - 1) % 3 == 0)
    city = F.when(moved, F.lit("elsewhere")).otherwise(F.col("city"))
    return checks.conflicting_copies({**c.raw, "customers": raw.withColumn("city", city)})


@query(
    f"""select count(*) as row_count,
         cast(sum(cast('0x' || substr(d, 1, 15) as hugeint)) as decimal(38,0)) as digest_low,
         cast(sum(cast('0x' || substr(d, 16, 15) as hugeint)) as decimal(38,0)) as digest_high
       from (select md5({oracle.prefixed('customer_id', 'customer_unique_id', 'postal_code', 'city', 'state')}) as d
             from dim_customers)"""
)
def fingerprint(c: Context) -> DataFrame:
    return compare.fingerprint(c.marts["dim_customers"])


@query(
    """select count(*) as orders, count(*) filter (where not has_items) as without_items,
         count(*) filter (where not has_payments) as without_payments,
         cast(sum(item_total) as decimal(28,2)) as item_total, cast(sum(freight_total) as decimal(28,2)) as freight_total,
         cast(sum(payment_total) as decimal(28,2)) as payment_total from fct_orders"""
)
def order_gap_profile(c: Context) -> DataFrame:
    return profiles.order_gap_profile(c.marts["fct_orders"])


@query("select count(*) as customer_records, count(distinct customer_unique_id) as people from dim_customers")
def people_vs_records(c: Context) -> DataFrame:
    return profiles.people_vs_records(c.marts["dim_customers"])


@query(
    " union all ".join(f"select '{m}' as mart, count(*) as row_count from {m}" for m in contract.MARTS)
)
def mart_counts(c: Context) -> DataFrame:
    return profiles.mart_counts(c.stored_marts)


@query("select order_item_key, count(*) as copies from raw_order_items group by 1 having count(*) > 1")
def duplicate_keys(c: Context) -> DataFrame:
    return checks.check_unique(c.raw["order_items"], "order_item_key")


# Joins ---------------------------------------------------------------------------------


@query(
    """select o.*, d.customer_unique_id, d.postal_code, d.city, d.state
       from fct_orders o join dim_customers d on o.customer_id = d.customer_id"""
)
def orders_with_customer(c: Context) -> DataFrame:
    return joins.orders_with_customer(c.stored_marts["fct_orders"], c.stored_marts["dim_customers"])


@query(
    """select o.order_id, o.customer_id, d.city from fct_orders o join dim_customers d on o.customer_id = d.customer_id"""
)
def orders_with_customer_heavy(c: Context) -> DataFrame:
    """The same join with every customer above ten orders treated as heavy."""
    marts = c.stored_marts
    heavy = skew.known(skew.heavy_keys(marts["fct_orders"], "customer_id", 10))
    joined = joins.orders_with_customer(marts["fct_orders"], marts["dim_customers"], heavy)
    return joined.select("order_id", "customer_id", "city")


@query("select order_id from fct_orders where cast(order_id as bigint) % 7 = 0")
def order_totals_mismatches(c: Context) -> DataFrame:
    """Item totals of every seventh order are off by one."""
    marts = c.stored_marts
    off = F.when(F.col("order_id").cast("long") % 7 == 0, F.lit(1)).otherwise(F.lit(0))
    wrong = marts["fct_orders"].withColumn("item_total", (F.col("item_total") + off).cast(contract.TOTAL_TYPE))
    return checks.order_totals_mismatches(wrong, marts["fct_order_items"], marts["fct_order_payments"])


@query("select * from fct_orders where customer_id not in (select customer_id from dim_customers)")
def orders_without_customer(c: Context) -> DataFrame:
    return joins.orphans(c.stored_marts["fct_orders"], "customer_id", c.stored_marts["dim_customers"], "customer_id")


@query("select * from fct_order_items where order_id not in (select order_id from fct_orders)")
def items_without_order(c: Context) -> DataFrame:
    return joins.orphans(c.stored_marts["fct_order_items"], "order_id", c.stored_marts["fct_orders"], "order_id")


@query(
    """select order_id, count(*) as child_rows from fct_order_payments
       where order_id not in (select order_id from fct_orders) group by order_id"""
)
def payments_without_order(c: Context) -> DataFrame:
    return joins.orphan_keys(c.marts["fct_order_payments"], "order_id", c.marts["fct_orders"], "order_id")


@query(
    """select customer_id from dim_customers where cast(customer_id as bigint) % 9 = 0
       union select customer_id from dim_customers where cast(customer_id as bigint) % 9 = 1 and postal_code is null"""
)
def history_vs_dimension(c: Context) -> DataFrame:
    """Cities of every ninth record differ; NULL postal codes became ''."""
    number = F.col("customer_id").cast("long")
    dimension = (
        c.stored_marts["dim_customers"]
        .withColumn("city", F.when(number % 9 == 0, F.concat(F.col("city"), F.lit("!"))).otherwise(F.col("city")))
        .withColumn(
            "postal_code",
            F.when((number % 9 == 1) & F.col("postal_code").isNull(), F.lit("")).otherwise(F.col("postal_code")),
        )
    )
    return checks.history_vs_dimension(dimension, c.stored_marts["dim_customer_history"])


def _commits(c: Context) -> DataFrame:
    return c.table("events").select(
        F.col("event_id"),
        F.concat(F.lit("table-"), (F.col("user_id") % 4).cast("string")).alias("source_table"),
        F.col("ts").alias("before_commit"),
        (F.col("ts") + F.expr("interval 1 minute")).alias("after_commit"),
    )


@query(
    """select e.event_id, 'table-' || (e.user_id % 4) as source_table, e.ts as before_commit,
         e.ts + interval 1 minute as after_commit,
         coalesce(l.load_start < e.ts and e.ts + interval 1 minute < l.load_end, false) as inside_load
       from events e left join (
         select 'table-' || (user_id % 4) as source_table, min(ts) as load_start, min(ts) + interval 10 day as load_end
         from events where user_id % 4 < 3 group by 1) l on l.source_table = 'table-' || (e.user_id % 4)"""
)
def commits_inside_load(c: Context) -> DataFrame:
    commits = _commits(c)
    loads = (
        commits.filter("source_table <> 'table-3'")
        .groupBy("source_table")
        .agg(F.min("before_commit").alias("load_start"))
        .withColumn("load_end", F.col("load_start") + F.expr("interval 10 days"))
    )
    return joins.commits_inside_load(commits, loads)


@query(
    """select x._op, x.customer_id, x.city, count(s._event_id) as staged_events
       from (select 'I' as _op, cast(user_id as varchar) as customer_id, cast(null as varchar) as city, event_id from events
             union all select 'U', cast(user_id as varchar), 'base-' || (user_id % 7), event_id from events
             union all select 'D', cast(user_id + 1 as varchar), null, event_id from events) x
       left join stg_customers s on not s._is_snapshot and s._op = x._op and s.customer_id = x.customer_id
         and (x._op <> 'U' or s.city = x.city)
       group by x.event_id, x._op, x.customer_id, x.city having count(s._event_id) <> 1"""
)
def missing_overlap_events(c: Context) -> DataFrame:
    commits = c.table("events").select(
        F.col("user_id").cast("string").alias("inserted"),
        F.col("user_id").cast("string").alias("updated"),
        (F.col("user_id") + 1).cast("string").alias("deleted"),
        F.concat(F.lit("base-"), (F.col("user_id") % 7).cast("string")).alias("city"),
    )
    return joins.missing_overlap_events(commits, c.staged["customers"])


def _touched_orders(c: Context) -> DataFrame:
    """Current orders with every 6th missing, every 10th changed, and a few new ones."""
    live, number = c.stored_live["orders"], F.col("order_id").cast("long")
    status = F.when(number % 10 == 1, F.lit("lost")).otherwise(F.col("status"))
    approved = F.when(number % 10 == 3, F.lit(None)).otherwise(F.col("approved_at"))
    kept = live.filter(number % 6 != 0).withColumn("status", status).withColumn("approved_at", approved)
    extra = live.filter(number % 100 == 0).withColumn("order_id", F.concat(F.lit("new-"), F.col("order_id")))
    return kept.unionByName(extra)


_TOUCHED = """(
  select * replace (case when cast(order_id as bigint) % 10 = 1 then 'lost' else status end as status,
                    case when cast(order_id as bigint) % 10 = 3 then null else approved_at end as approved_at)
  from cur_orders where cast(order_id as bigint) % 6 <> 0
  union all select * replace ('new-' || order_id as order_id) from cur_orders where cast(order_id as bigint) % 100 = 0)"""


@query(
    f"""select count(s.order_id) as source_rows, count(t.order_id) as target_rows,
         count(*) filter (where t.order_id is null) as missing_in_target,
         count(*) filter (where s.order_id is null) as missing_in_source,
         count(*) filter (where s.order_id = t.order_id and s.differs) as changed,
         min(case when t.order_id is null or s.order_id is null or s.differs then coalesce(s.order_id, t.order_id) end) as first_mismatch,
         false as all_fields_match
       from (select *, cast(order_id as bigint) % 10 = 1 or (cast(order_id as bigint) % 10 = 3 and approved_at is not null) as differs
             from cur_orders) s full join {_TOUCHED} t on s.order_id = t.order_id"""
)
def reconcile(c: Context) -> DataFrame:
    columns = contract.source_columns("orders")
    return compare.reconcile(c.stored_live["orders"], _touched_orders(c), "order_id", columns)


@query(
    f"""select coalesce(s.order_id, t.order_id) as order_id,
         case when t.order_id is null then 'missing_in_target' when s.order_id is null then 'missing_in_source'
              else 'changed' end as kind
       from cur_orders s full join {_TOUCHED} t on s.order_id = t.order_id
       where s.order_id is null or t.order_id is null or s.status <> t.status or s.approved_at is distinct from t.approved_at"""
)
def mismatched_keys(c: Context) -> DataFrame:
    found = compare.mismatches(c.stored_live["orders"], _touched_orders(c), "order_id", contract.source_columns("orders"))
    return found.select("order_id", "kind")


@query(
    f"""select case when s.order_id is null then 'I' when t.order_id is null then 'D' else 'U' end as _op,
         coalesce(t.order_id, s.order_id) as order_id, case when t.order_id is null then s.status else t.status end as status,
         case when t.order_id is null then s.approved_at else t.approved_at end as approved_at
       from cur_orders s full join {_TOUCHED} t on s.order_id = t.order_id
       where s.order_id is null or t.order_id is null or s.status <> t.status or s.approved_at is distinct from t.approved_at"""
)
def state_diff(c: Context) -> DataFrame:
    return compare.diff_states(c.stored_live["orders"], _touched_orders(c), "order_id", ["status", "approved_at"])


@query(
    "select _event_id, (event_id + 1) % 7 = 0 as known from (select event_id, 'cdc:customers:' || (event_id + 1) as _event_id from events)"
)
def known_events(c: Context) -> DataFrame:
    """Which events of the ordinary files the replay file holds too."""
    raw = c.raw["customers"].filter("not _is_snapshot")
    replay = F.col("_source_file") == "cdc/replay-000.csv"
    return joins.known_events(raw.filter(~replay), raw.filter(replay))


# Sets and order ---------------------------------------------------------------------------


@query(
    "select order_id, _source_order, _event_id, status, _op from stg_orders where not _is_snapshot"
)
def status_timeline(c: Context) -> DataFrame:
    return changelog.timeline(c.staged["orders"], "order_id", "status", "_op")


@query(_per_table("select '{t}' as source_table, _event_id, _op, _source_order from raw_{t}"))
def all_deliveries(c: Context) -> DataFrame:
    return profiles.union_tables(
        [df.select(F.lit(t).alias("source_table"), "_event_id", "_op", "_source_order") for t, df in c.raw.items()]
    )


@query("select distinct * exclude (_source_file) from raw_customers")
def distinct_events(c: Context) -> DataFrame:
    return c.raw["customers"].drop("_source_file").distinct()


@query(_per_table("select '{t}' as source_table, cast(0 as bigint) as only_left, cast(0 as bigint) as only_right, true as equal from raw_{t} group by 1"))
def staging_equals_distinct_raw(c: Context) -> DataFrame:
    parts = []
    for table, raw in c.stored_raw.items():
        columns = [n for n in contract.raw_columns(table) if n != "_source_file"]
        typed = layers.typed(raw, table).select(*columns).distinct()
        same = compare.same_content(c.stored_staged[table].select(*columns), typed)
        parts.append(same.select(F.lit(table).alias("source_table"), "only_left", "only_right", "equal"))
    return profiles.union_tables(parts)


@query(
    " union all ".join(
        f"select '{m}' as mart, cast(0 as bigint) as only_left, cast(0 as bigint) as only_right, true as equal from {m} group by 1"
        for m in contract.MARTS
    )
)
def marts_survive_redelivery(c: Context) -> DataFrame:
    """The whole change log delivered again under other names changes no mart."""
    again = {
        t: df.unionByName(df.withColumn("_source_file", F.concat(F.lit("again/"), F.col("_source_file"))))
        for t, df in c.stored_raw.items()
    }
    rebuilt = layers.marts_from_raw(again)
    parts = []
    for mart in contract.MARTS:
        same = compare.same_content(rebuilt[mart], c.stored_marts[mart])
        parts.append(same.select(F.lit(mart).alias("mart"), "only_left", "only_right", "equal"))
    return profiles.union_tables(parts)


# Delivery -----------------------------------------------------------------------------------


def _early(c: Context) -> dict[str, DataFrame]:
    return {t: df.filter(F.col("_source_file") != "cdc/replay-000.csv") for t, df in c.stored_raw.items()}


@query(
    _per_table(
        """select '{t}' as source_table, count(*) filter (where _source_file = 'cdc/replay-000.csv') as delivered_rows,
             count(*) filter (where _source_file = 'cdc/replay-000.csv') as raw_added, cast(0 as bigint) as unique_added,
             cast(0 as bigint) as staged_added, true as replay_is_neutral from raw_{t}"""
    )
)
def replay_delta(c: Context) -> DataFrame:
    early = _early(c)
    before = profiles.delivery_profile(early, layers.stage_all(early))
    after = profiles.delivery_profile(c.stored_raw, c.stored_staged)
    replayed = [
        df.filter(F.col("_source_file") == "cdc/replay-000.csv").select(F.lit(t).alias("source_table"))
        for t, df in c.stored_raw.items()
    ]
    delivered = (
        profiles.union_tables(replayed).groupBy("source_table").agg(F.count(F.lit(1)).alias("delivered_rows"))
    )
    return delivery.replay_delta(before, after, delivered)


@query(
    """select count(*) as new_rows, count(distinct _event_id) as distinct_ids,
         count(distinct case when not exists (select 1 from raw_customers o where o._event_id = r._event_id
           and o._source_file < 'cdc/032.csv') then _event_id end) as new_unique_events
       from raw_customers r where _source_file >= 'cdc/032.csv'"""
)
def retry_delta(c: Context) -> DataFrame:
    raw = c.raw["customers"]
    later = F.col("_source_file") >= "cdc/032.csv"
    return delivery.retry_delta(raw.filter(later), raw.filter(~later))


@query(
    """select _event_id, _source_order from cdc_orders
       where _source_order <= (select max(_source_order) from cdc_orders where _source_file < 'cdc/032.csv')
         and _source_file >= 'cdc/032.csv'"""
)
def lineage_violations(c: Context) -> DataFrame:
    orders = c.raw["orders"].filter((F.col("_source_file") != "cdc/replay-000.csv") & ~F.col("_is_snapshot"))
    later = F.col("_source_file") >= "cdc/032.csv"
    return delivery.lineage_violations(orders.filter(later), orders.filter(~later))


def _listing(c: Context) -> DataFrame:
    files = profiles.union_tables([df.select("_source_file") for df in c.raw.values()])
    return files.groupBy(F.col("_source_file").alias("path")).agg(F.count(F.lit(1)).alias("size"))


_LISTING = (
    "(select _source_file as path, count(*) as size from ("
    + " union all ".join(f"select _source_file from raw_{t}" for t in contract.TABLES)
    + ") group by 1)"
)


@query(f"select path, size from {_LISTING} where not (size % 2 = 0)")
def pending_files(c: Context) -> DataFrame:
    listing = _listing(c)
    ledger = listing.filter("size % 2 = 0").select(F.col("path").alias("source_file"))
    return joins.pending_files(listing, ledger)


@query(
    f"""select coalesce(n.path, o.path) as path,
          case when o.path is null then 'added' when n.path is null then 'removed'
               when n.size <> o.size then 'changed' else 'kept' end as state, o.size as old_size, n.size as new_size
        from (select path, size from {_LISTING} where path not like '%5.csv') o
        full join (select path, case when path like '%3.csv' then size + 1 else size end as size
                   from {_LISTING} where path not like '%7.csv') n on o.path = n.path"""
)
def manifest_diff(c: Context) -> DataFrame:
    listing = _listing(c)
    old = listing.filter("path not like '%5.csv'")
    grown = F.when(F.col("path").like("%3.csv"), F.col("size") + 1).otherwise(F.col("size"))
    return delivery.manifest_diff(old, listing.filter("path not like '%7.csv'").withColumn("size", grown))


@query(
    """select source_table, cycle, new_events, cast(sum(new_events) over (partition by source_table order by cycle) as bigint) as total_events
       from (select source_table, cycle, count(*) as new_events from (
         select source_table, _event_id, min(cycle) as cycle from ("""
    + _per_table("select '{t}' as source_table, _event_id, _source_file as cycle from raw_{t}")
    + ") group by 1, 2) group by 1, 2)"
)
def cycle_counts(c: Context) -> DataFrame:
    events = [
        df.select(F.lit(t).alias("source_table"), "_event_id", F.col("_source_file").alias("cycle"))
        for t, df in c.raw.items()
    ]
    return delivery.cycle_counts(profiles.union_tables(events), "cycle")


@query(
    """select 'order_totals' as "check", order_id as key, status || '|' || item_total || '|' || freight_total || '|' || payment_total
         || '|' || item_count || '|' || payment_count as value from fct_orders
       union all select 'status_steps', order_id, count(distinct status) || '|' || count(*) from stg_orders
         where not _is_snapshot and _op in ('I', 'U') group by order_id
       union all select 'customer_versions', customer_id, count(*) || '|' || count(*) filter (where is_deleted) || '|'
         || count(*) filter (where is_current) from dim_customer_history group by customer_id
       union all select 'order_absent', cast(o_orderkey as varchar), 'absent' from orders
         where cast(o_orderkey as varchar) not in (select order_id from fct_orders)
       union all select 'customer_absent', cast(c_custkey as varchar), 'absent' from customer
         where cast(c_custkey as varchar) not in (select customer_id from dim_customers)
       union all select 'current_city', o.order_id, d.city from fct_orders o join dim_customers d on o.customer_id = d.customer_id
       """
    + " ".join(
        f"union all select '{t}_operations', _op, count(*) || '|' || count(distinct _event_id) from stg_{t} "
        "where not _is_snapshot group by _op"
        for t in contract.TABLES
    )
)
def lifecycle_report(c: Context) -> DataFrame:
    orders = c.table("orders").select(F.col("o_orderkey").cast("string").alias("order_id"))
    customers = c.table("customer").select(F.col("c_custkey").cast("string").alias("customer_id"))
    return lifecycle.lifecycle_report(c.stored_raw, c.stored_staged, c.stored_marts, orders, customers)


@query(
    """select 'status' as "check", order_id as key, _source_order as position, _op || '|' || status as value from stg_orders
         where not _is_snapshot
       union all select 'city', customer_id, _source_order, city from bounded
       union all select 'deleted', customer_id, _source_order, cast(_op = 'D' as varchar) from bounded"""
)
def lifecycle_events(c: Context) -> DataFrame:
    orders = c.table("orders").select(F.col("o_orderkey").cast("string").alias("order_id"))
    # Everyone the log speaks of: nothing is left out of the comparison.
    customers = c.staged["customers"].select("customer_id")
    return lifecycle.lifecycle_events(c.staged, c.stored_marts, orders, customers)


# Checks -----------------------------------------------------------------------------------------


@query("select * from stg_customers where postal_code is null")
def check_not_null(c: Context) -> DataFrame:
    return checks.check_not_null(c.staged["customers"], "postal_code")


@query("select * from stg_orders where _op not in ('I', 'U')")
def check_accepted_values(c: Context) -> DataFrame:
    return checks.check_accepted(c.staged["orders"], "_op", ("I", "U"))


@query("select * from stg_customers where city is null or city = ''")
def check_source_key(c: Context) -> DataFrame:
    return checks.check_source_key(c.staged["customers"], "city")


@query("select customer_version_id from dim_customer_history where source_order_to > source_order_from + 50")
def check_intervals(c: Context) -> DataFrame:
    """Versions whose end was planted before their start."""
    planted = F.when(F.col("source_order_to") > F.col("source_order_from") + 50, F.col("source_order_from") - 1)
    moved = c.stored_marts["dim_customer_history"].withColumn(
        "source_order_to", F.coalesce(planted, F.col("source_order_to"))
    )
    return checks.check_intervals(moved)


_STAGING_CHECKS = " union all ".join(
    f"""select 'unique' as "check", 'stg_{t}' as model, '_event_id' as "column", count(*) - count(distinct _event_id) as violations from stg_{t}
        union all select 'not_null', 'stg_{t}', '_event_id', count(*) filter (where _event_id is null) from stg_{t}
        union all select 'not_null', 'stg_{t}', '_source_order', count(*) filter (where _source_order is null) from stg_{t}
        union all select 'accepted_values', 'stg_{t}', '_op', count(*) filter (where _op not in ('I','U','D')) from stg_{t}
        union all select 'required_source_key', 'stg_{t}', '{k}', count(*) filter (where {k} is null or {k} = '') from stg_{t}"""
    for t, k in oracle.KEYS.items()
)


@query(
    _STAGING_CHECKS
    + """ union all select 'conflicting_event_copies', 'raw', '_event_id', count(*) from (
         select _event_id from (select distinct * exclude (_source_file) from raw_customers) group by 1 having count(*) > 1)"""
)
def staging_checks(c: Context) -> DataFrame:
    return checks.staging_checks(c.stored_raw, c.stored_staged)


@query(
    """select 'unique' as "check", 'dim_customers' as model, 'customer_id' as "column", count(*) - count(distinct customer_id) as violations from dim_customers
       union all select 'unique', 'dim_customer_history', 'customer_version_id', count(*) - count(distinct customer_version_id) from dim_customer_history
       union all select 'unique', 'fct_orders', 'order_id', count(*) - count(distinct order_id) from fct_orders
       union all select 'unique', 'fct_order_items', 'order_item_key', count(*) - count(distinct order_item_key) from fct_order_items
       union all select 'unique', 'fct_order_payments', 'payment_key', count(*) - count(distinct payment_key) from fct_order_payments
       union all select 'not_null', 'dim_customers', 'customer_id', count(*) - count(customer_id) from dim_customers
       union all select 'not_null', 'dim_customer_history', 'customer_version_id', count(*) - count(customer_version_id) from dim_customer_history
       union all select 'not_null', 'fct_orders', 'order_id', count(*) - count(order_id) from fct_orders
       union all select 'not_null', 'fct_orders', 'customer_id', count(*) - count(customer_id) from fct_orders
       union all select 'not_null', 'fct_order_items', 'order_item_key', count(*) - count(order_item_key) from fct_order_items
       union all select 'not_null', 'fct_order_items', 'order_id', count(*) - count(order_id) from fct_order_items
       union all select 'not_null', 'fct_order_payments', 'payment_key', count(*) - count(payment_key) from fct_order_payments
       union all select 'not_null', 'fct_order_payments', 'order_id', count(*) - count(order_id) from fct_order_payments
       union all select 'relationships', 'fct_orders', 'customer_id', count(*) from fct_orders where customer_id not in (select customer_id from dim_customers)
       union all select 'relationships', 'fct_order_items', 'order_id', count(*) from fct_order_items where order_id not in (select order_id from fct_orders)
       union all select 'relationships', 'fct_order_payments', 'order_id', count(*) from fct_order_payments where order_id not in (select order_id from fct_orders)
       union all select 'history_matches_dimension', 'dim_customer_history', 'customer_id', count(*) from dim_customers d
         full join (select * from dim_customer_history where is_current) h on d.customer_id = h.customer_id
         where d.customer_id is null or h.customer_id is null or d.customer_unique_id is distinct from h.customer_unique_id
           or d.city is distinct from h.city or d.state is distinct from h.state or d.postal_code is distinct from h.postal_code
       union all select 'history_intervals', 'dim_customer_history', 'customer_version_id', count(*) from dim_customer_history
         where source_order_to <= source_order_from or observed_to < observed_from
       union all select 'order_totals', 'fct_orders', 'order_id', count(*) from fct_orders where order_total <> item_total + freight_total"""
)
def mart_checks(c: Context) -> DataFrame:
    return checks.mart_checks(c.stored_marts)


_CONSTRAINTS = []
for _t, _k in oracle.KEYS.items():
    _CONSTRAINTS.append(
        f"""select 'primary_key' as "check", '{_t}' as model, '{_k}' as "column", count(*) as violations
            from (select {_k} from typed_{_t} where {_k} is not null group by 1 having count(*) > 1)"""
    )
    _CONSTRAINTS += [
        f"select 'not_null', '{_t}', '{n}', count(*) - count({n}) from typed_{_t}" for n in checks.SOURCE_NOT_NULL[_t]
    ]
for _t, (_k, _p, _n) in checks.SOURCE_PAIRS.items():
    _CONSTRAINTS.append(
        f"select 'unique_pair', '{_t}', '{_p},{_n}', count(*) from (select 1 from typed_{_t} group by {_p}, {_n} having count(*) > 1)"
    )
    _CONSTRAINTS.append(
        f"select 'derived_key', '{_t}', '{_k}', count(*) from typed_{_t} where {_k} <> {_p} || ':' || {_n}"
    )
for _t, _f, _p, _k in checks.SOURCE_REFERENCES:
    _CONSTRAINTS.append(
        f"select 'foreign_key', '{_t}', '{_f}', count(*) from typed_{_t} where {_f} not in (select {_k} from typed_{_p})"
    )


@query(" union all ".join(_CONSTRAINTS))
def source_constraints(c: Context) -> DataFrame:
    """Declared source constraints held against every delivered row."""
    tables = {t: layers.typed(df, t) for t, df in c.stored_raw.items()}
    return checks.constraint_checks(tables)


# Ingest --------------------------------------------------------------------------------------------


@query(
    """select 'changes' as kind, cast(null as varchar) as snapshot_of, count(*) > 0 as has_bytes from events
       union all select 'snapshot', 'customers', count(*) > 0 from customer
       union all select 'snapshot', 'order_payments', count(*) > 0 from orders
       union all select 'snapshot', 'orders', count(*) > 0 from orders"""
)
def classified_captures(c: Context) -> DataFrame:
    manifest = capture.classify_paths(capture.capture_manifest(c.spark, c.captures), c.captures, EXPORT)
    filled = manifest.groupBy("kind", "snapshot_of").agg((F.sum("size") > 0).alias("has_bytes"))
    return filled.filter("has_bytes")


for _t in contract.TABLES:
    _register(
        f"captured_{_t}",
        f"select * exclude (_source_file) from raw_{_t}",
        lambda c, t=_t: capture.table_events(c.captured, t).drop("_source_file"),
    )
    _register(
        f"landed_{_t}",
        f"select * exclude (_source_file) from raw_{_t}",
        lambda c, t=_t: c.landed.raw(t).drop("_source_file"),
    )


@query("select * exclude (_source_file) from raw_customers")
def captured_customers_split(c: Context) -> DataFrame:
    """The reader for files above one split, with splits so small that records are cut."""
    root = c.captures  # written with splits of the usual size; only the reader meets tiny ones
    with _small_splits(c.spark):
        return _captured_split(c, root)


@contextmanager
def _small_splits(spark: SparkSession):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, str(1 << 14))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _captured_split(c: Context, root: str) -> DataFrame:
    files = [(r["path"], r["size"]) for r in capture.capture_manifest(c.spark, root).collect()]
    size = sum(size for _, size in files)
    rows = records.read_split_records(c.spark, [path for path, _ in files], EXPORT.null_token, size)
    events = capture.to_events(rows, capture.batch_kinds(c.spark, root, files, EXPORT), EXPORT)
    folder = work_folder(c.spark, "events")
    events.write.parquet(folder)
    return capture.table_events(c.spark.read.schema(events.schema).parquet(folder), "customers").drop("_source_file")


def _judged(c: Context, rows: DataFrame) -> DataFrame:
    names = ("cdc/a.csv", "other/a.csv", "initial-load/orders/part-1.csv", "initial-load/customers/part-1.csv")
    files = [(f"/capture/{name}", 0) for name in names]
    return capture.to_events(rows, capture.batch_kinds(c.spark, "/capture", files, EXPORT), EXPORT)


# Planted envelope defects, by order number modulo 20.
_DEFECTS = {
    1: "missing operation, table or schema",
    2: "unexpected schema",
    3: "unsupported table or operation",
    4: "unexpected number of fields",
    5: "no positive change sequence",
    6: "no positive change sequence",
    7: "missing commit time",
    8: "invalid commit time",
    9: "source value is too wide",
    10: "unexpected capture path",
    11: "unsupported table or operation",
    12: "snapshots hold inserts only",
}


@query(
    "select problem, count(*) as bad_rows from (select case o_orderkey % 20 "
    + " ".join(f"when {n} then '{text}'" for n, text in _DEFECTS.items())
    + " end as problem from orders) group by problem"
)
def envelope_problems(c: Context) -> DataFrame:
    number = F.col("o_orderkey") % 20

    def unless(value, **planted):
        chosen = F.lit(value) if isinstance(value, str) else value
        for case, other in planted.items():
            chosen = F.when(number == int(case[1:]), other).otherwise(chosen)
        return chosen

    at = "2024-03-01 12:00:00"
    key = F.col("o_orderkey").cast("string")
    wide = F.repeat(F.lit("x"), 257)
    values = [key, F.col("o_custkey").cast("string"), unless("created", _9=wide), *[F.lit(at)] * 6]
    tail = [
        unless(F.concat(key, F.lit("1")), _5=F.lit("0"), _6=F.repeat(F.lit("1"), 36)),
        unless(at, _7=F.lit(None), _8=F.lit("yesterday")),
    ]
    lead = [
        unless("U", _11=F.lit("X")),
        unless("orders", _3=F.lit("refunds")),
        unless("ecommerce", _2=F.lit("sandbox")),
    ]
    change = F.array(*lead, *values, *tail)
    fields = (
        F.when(number == 1, F.slice(change, 1, 2))
        .when(number == 4, F.array_append(F.array_append(change, F.lit("x")), F.lit("y")))
        .when(number == 12, F.array(F.lit("U"), *values, *tail))
        .otherwise(change)
    )
    path = unless("/capture/cdc/a.csv", _10=F.lit("/capture/other/a.csv"), _12=F.lit("/capture/initial-load/orders/part-1.csv"))
    rows = c.table("orders").select(
        path.alias("source_file"), F.col("o_orderkey").alias("line"), fields.alias("fields"), F.lit(False).alias("bad_text")
    )
    judged = _judged(c, rows)
    return judged.groupBy(F.col("_problem").alias("problem")).agg(F.count(F.lit(1)).alias("bad_rows"))


@query(
    """select case c_custkey % 4
          when 0 then 'snapshot-missing-key:customers:' || sha256('/capture/initial-load/customers/part-1.csv:' || c_custkey)
          when 1 then 'snapshot-missing-key:customers:' || sha256('/capture/initial-load/customers/part-1.csv:' || c_custkey)
          when 2 then 'snapshot:customers:' || c_custkey
          else 'cdc:customers:00' || (c_custkey + 1) end as _event_id,
        case when c_custkey % 4 = 3 then cast(c_custkey + 1 as decimal(35,0)) else cast(0 as decimal(35,0)) end as _source_order
      from customer"""
)
def event_identity(c: Context) -> DataFrame:
    number = F.col("c_custkey")
    snapshot = number % 4 != 3
    key = F.when(number % 4 == 0, F.lit(None)).when(number % 4 == 1, F.lit("")).otherwise(number.cast("string"))
    at = F.lit("2024-03-01 12:00:00")
    values = [key, F.lit("P1"), F.lit("00123"), F.lit("x"), F.lit("SP"), at]
    fields = F.when(snapshot, F.array(F.lit("I"), *values, F.lit(""), at)).otherwise(
        F.array(F.lit("U"), F.lit("customers"), F.lit("ecommerce"), *values, F.concat(F.lit("00"), (number + 1).cast("string")), at)
    )
    path = F.when(snapshot, F.lit("/capture/initial-load/customers/part-1.csv")).otherwise(F.lit("/capture/cdc/a.csv"))
    rows = c.table("customer").select(
        path.alias("source_file"), number.alias("line"), fields.alias("fields"), F.lit(False).alias("bad_text")
    )
    return _judged(c, rows).select("_event_id", "_source_order")


_COPY_READY = """select customer_id, customer_unique_id, postal_code, city, state, updated_at, _event_id, _op,
         cast(_source_order as varchar) as _source_order,
         strftime(_commit_at, '%Y-%m-%dT%H:%M:%S') || case when microsecond(_commit_at) % 1000000 = 0 then ''
           else '.' || lpad(cast(microsecond(_commit_at) % 1000000 as varchar), 6, '0') end || '+00:00' as _commit_at,
         cast(_is_snapshot as varchar) as _is_snapshot, _source_file from raw_customers"""


@query(_COPY_READY)
def copy_ready_rows(c: Context) -> DataFrame:
    return sinks.copy_ready(c.raw["customers"], "customers")


@query(_COPY_READY)
def copy_ready_files(c: Context) -> DataFrame:
    """Written copy-ready files, read back by the capture reader."""
    folder = sinks.write_copy_ready(c.raw["customers"], "customers", work_folder(c.spark, "sink"), EXPORT)
    manifest = c.spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").load(folder)
    files = [(r["path"], r["length"]) for r in manifest.select("path", "length").collect()]
    rows = records.read_records(c.spark, files)
    names = contract.raw_columns("customers")
    columns = [
        identity.decode_null(F.get("fields", F.lit(names.index(n))), EXPORT.null_token).alias(n)
        for n in names
    ]
    return rows.select(*columns)


@query("select * from typed_order_items")
def typed_parquet(c: Context) -> DataFrame:
    folder = work_folder(c.spark, "typed")
    sinks.write_typed_parquet(c.raw["order_items"], "order_items", folder)
    return c.spark.read.schema(contract.staged_schema("order_items")).parquet(folder)


@query(
    """select 'order_items' as source_table, f.format, count(*) as row_count, true as roundtrip_ok
       from raw_order_items cross join (values ('csv_gzip'), ('parquet_snappy'), ('parquet_zstd')) f(format) group by f.format"""
)
def compare_formats(c: Context) -> DataFrame:
    sizes = sinks.compare_formats(c.spark, c.stored_raw["order_items"], "order_items", EXPORT)
    return sizes.filter("bytes > 0").drop("bytes")


@query(
    "select metric, count(*) as value from (select case when _is_snapshot then 'snapshot_rows' else 'input_' || _op end as metric from ("
    + " union all ".join(f"select _is_snapshot, _op from raw_{t}" for t in contract.TABLES)
    + ")) group by metric"
)
def load_metrics(c: Context) -> DataFrame:
    store = c.landed
    return warehouse.event_metrics(
        profiles.union_tables([warehouse.committed_events(store, r["load_id"]) for r in store.loads().collect()])
    )


@query("select cast(count(*) as bigint) as pending from events where event_id < 0")
def nothing_pending_after_landing(c: Context) -> DataFrame:
    manifest = capture.capture_manifest(c.spark, c.captures)
    return c.landed.pending(manifest).agg(F.count(F.lit(1)).alias("pending"))


_WIDENED = {"customers": "city", "orders": "status", "order_items": "product_id", "order_payments": "payment_type"}


@query(
    " union all ".join(
        f"select '{t}' as source_table, count(*) as violations, count(distinct {contract.primary_key(t)}) as keys"
        f" from raw_{t} where _source_order % 3 = 1"
        for t in contract.TABLES
    )
)
def raw_width_violations(c: Context) -> DataFrame:
    """Values widened in a third of every table's rows are found, and nothing else."""
    parts = []
    for table, column in _WIDENED.items():
        warehouse.assert_raw_schema(c.landed.raw(table), table)
        raw = c.landed.raw(table)
        wide = F.when(F.col("_source_order") % 3 == 1, F.repeat(F.lit("é"), contract.SOURCE_WIDTH + 1))
        planted = raw.withColumn(column, F.coalesce(wide, F.repeat(F.lit("é"), contract.SOURCE_WIDTH)))
        found = warehouse.too_wide(planted, table)
        keys = F.countDistinct(contract.primary_key(table)).alias("keys")
        parts.append(found.agg(F.lit(table).alias("source_table"), F.count(F.lit(1)).alias("violations"), keys))
    return profiles.union_tables(parts)


_PLANTED = ("_hidden", "old", "plain", "wide", "unclosed")


def _planted_captures(c: Context) -> str:
    """Customer changes in five files by customer number, two of them broken, and an empty file."""
    root = work_folder(c.spark, "planted")
    jvm, conf = c.spark._jvm, c.spark._jsparkSession.sessionState().newHadoopConf()

    def path(*parts):
        return jvm.org.apache.hadoop.fs.Path("/".join((root, *parts)))

    fs = path("cdc").getFileSystem(conf)
    columns = contract.source_columns("customers")
    changes = c.stored_raw["customers"].filter("not _is_snapshot and _source_file not like '%replay%'")
    for part, name in enumerate(_PLANTED):
        own = changes.filter(F.col("customer_id").cast("int") % 5 == part)
        first = F.col("_source_order") == own.agg(F.min("_source_order")).first()[0]
        city = F.when(first & F.lit(name == "wide"), F.repeat(F.lit("x"), 200_000)).otherwise(F.col("city"))
        if name == "unclosed":  # no further quote, so that the first one stays open
            city = F.lit("plain")
        values = [city if n == "city" else F.col(n) for n in columns]
        tail = [F.col("_source_order").cast("string"), F.col("updated_at")]
        fields = [F.col("_op"), F.lit("customers"), F.lit("ecommerce"), *values, *tail]
        quoted = [F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"')) for v in fields]
        line = F.concat_ws(",", *[F.coalesce(v, F.lit(EXPORT.null_token)) for v in (fields if name == "unclosed" else quoted)])
        line = F.concat(F.when(first & F.lit(name == "unclosed"), F.lit('"x')).otherwise(F.lit("")), line)
        own.repartition(1).sortWithinPartitions("_source_order").select(line).write.text(f"{root}/made/{name}")
        written = fs.globStatus(path("made", name, "part-*"))[0].getPath()
        fs.mkdirs(path("cdc"))
        fs.rename(written, path("cdc", f"{name}.csv"))
    fs.create(path("cdc", "empty.csv")).close()
    fs.setTimes(path("cdc", "old.csv"), 1_000_000_000_000, -1)
    return root


@query(
    """select way, file, case when file in ('wide', 'unclosed') then null else coalesce(n, 0) end as row_count,
         case file when 'wide' then 'source value is too wide' when 'unclosed' then 'record is too long' end as reason
       from (values (0, '_hidden'), (1, 'old'), (2, 'plain'), (3, 'wide'), (4, 'unclosed'), (5, 'empty')) f(part, file)
         cross join (values ('batch'), ('stream')) w(way)
         left join (select cast(customer_id as int) % 5 as part, count(*) as n from cdc_customers group by 1) using (part)"""
)
def accounted_captures(c: Context) -> DataFrame:
    """Hidden, old, empty and broken files: each is in the ledger or refused with a reason, by batch and by stream."""
    root = _planted_captures(c)
    parts = []
    with _small_splits(c.spark):
        for way in ("batch", "stream"):
            store = c.new_warehouse()
            if way == "batch":
                store.land_pending(f"{root}", EXPORT, strict=False)
            else:
                ingest.ingest_all(store, root, work_folder(c.spark, "stream"), EXPORT, strict=False)
            name = F.regexp_extract("source_file", "([^/]*)[.]csv$", 1).alias("file")
            none = F.lit(None).cast("string")
            parts.append(store.ledger().select(F.lit(way).alias("way"), name, "row_count", none.alias("reason")))
            parts.append(store.rejected().select(F.lit(way).alias("way"), name, F.lit(None).cast("long").alias("row_count"), "reason"))
    return profiles.union_tables(parts)


@query("select * exclude (updated_at) from cur_orders")
def imported_baseline(c: Context) -> DataFrame:
    """Current orders exported with headers and imported again."""
    folder = work_folder(c.spark, "export")
    titles = baseline.HEADERS["orders"]
    text = layers.current_from_raw(c.stored_raw)["orders"]
    named = [F.col(n).cast("string").alias(titles[n]) for n in contract.SOURCE_COLUMNS["orders"]]
    text.select(*named).write.options(header="true", emptyValue="").csv(folder)
    imported = baseline.import_table(c.spark, folder, "orders")
    return imported.select(*[casts.staged(n) for n in contract.SOURCE_COLUMNS["orders"]])


@query("select * from fct_orders")
def published_marts(c: Context) -> DataFrame:
    store = c.new_warehouse()
    publish.publish(store, c.stored_marts)
    return publish.read_mart(store, "fct_orders")


@query(
    "select 'fct_orders' as mart, true as equal union all select 'dim_customer_history', true "
    "union all select 'dim_customers', true union all select 'fct_order_items', true union all select 'fct_order_payments', true "
    "union all select 'rows', (select count(*) from fct_orders) > 0"
)
def updated_marts_equal_rebuilt(c: Context) -> DataFrame:
    """Marts built from the first files, then updated for the rest, against a full rebuild from everything."""
    store = c.new_warehouse()
    files = [(r["path"], r["size"]) for r in capture.capture_manifest(c.spark, c.captures).collect()]
    # Late and early change files are mixed: order comes from the sequence.
    parts = [files[::2], files[1::2]]
    loads = [store.land(part, c.captures, EXPORT).load_id for part in parts]
    allow = ("relationships",)
    first = {t: warehouse.committed_events(store, loads[0]).filter(f"source_table = '{t}'") for t in contract.TABLES}
    build.build(store, {t: df.select(*contract.raw_columns(t)) for t, df in first.items()}, allow=allow)
    update.update(store, loads[1:], allow=allow)
    full = layers.marts_from_raw(store.raw_tables())
    parts = [
        compare.same_content(publish.read_mart(store, m), full[m]).select(F.lit(m).alias("mart"), F.col("equal"))
        for m in contract.MARTS
    ]
    some = full["fct_orders"].agg(F.lit("rows").alias("mart"), (F.count(F.lit(1)) > 0).alias("equal"))
    return profiles.union_tables([*parts, some])


# Batches and streams ---------------------------------------------------------------------------------


@query("select step, count(*) > 0 and step <> 2 as run from events cross join (values (1), (2), (3)) s(step) group by step")
def batch_gate(c: Context) -> DataFrame:
    """A first batch runs, an unchanged capture is skipped, a lost marker runs again."""
    store = c.new_warehouse()
    gate = batches.BatchGate(store, c.captures)
    first = gate.prepare("first")
    gate.complete("first")
    second = gate.prepare("second")
    third = batches.BatchGate(c.new_warehouse(), c.captures).prepare("third")
    return c.spark.createDataFrame([(1, first), (2, second), (3, third)], "step int, run boolean")


@query("select * exclude (_source_file) from raw_orders")
def streamed_orders(c: Context) -> DataFrame:
    """All captures landed by the stream, in several micro-batches."""
    store = c.new_warehouse()
    stream = ingest.stream_ingest(store, c.captures, work_folder(c.spark, "stream"), EXPORT, max_files=8)
    stream.awaitTermination()
    return store.raw("orders").drop("_source_file")


@query("select * from dim_customer_history")
def history_of_landed_captures(c: Context) -> DataFrame:
    """Captures to history end to end; copies now sit in other files."""
    return layers.marts_from_raw(c.landed.raw_tables())["dim_customer_history"]


# Compacted raw and updates by bucket, against the SQL of raw and marts
for _t in contract.TABLES:
    _register(
        f"compacted_raw_{_t}", f"select * exclude (_source_file) from raw_{_t}", lambda c, t=_t: c.updated.raw(t).drop("_source_file")
    )
for _m in contract.MARTS:
    _register(f"updated_{_m}", f"select * from {_m}", lambda c, m=_m: publish.read_mart(c.updated, m))


# Records of publications, batches that fail, sketches, ranges and intervals --------------------------


@query("select * from fct_orders")
def update_finds_omitted_load(c: Context) -> DataFrame:
    """Marts of the first of three loads; an update that leaves one out is refused, then folds in all that is missing."""
    store = c.new_warehouse()
    files = [(r["path"], r["size"]) for r in capture.capture_manifest(c.spark, c.captures).collect()]
    loads = [store.land(files[n::3], c.captures, EXPORT).load_id for n in range(3)]
    allow = ("relationships",)
    build.build(store, allow=allow, loads=loads[:1])
    try:
        update.update(store, loads[2:], allow=allow)
        raise AssertionError("a load was left out without a word")
    except update.OmittedLoad:
        update.update(store, allow=allow)
    if update.missing_loads(store):
        raise AssertionError("loads are still missing")
    return publish.read_mart(store, "fct_orders")


def _put_changes(c: Context, root: str, part: int) -> None:
    """Customer changes of every third customer number, as one more capture file."""
    own = c.stored_raw["customers"].filter("not _is_snapshot and _source_file not like '%replay%'")
    own = own.filter(F.col("customer_id").cast("int") % 3 == part)
    tail = [F.col("_source_order").cast("string").alias("_seq"), F.col("updated_at").alias("_at")]
    lead = [F.col("_op").alias("_lead"), F.lit("customers").alias("_table"), F.lit("ecommerce").alias("_schema")]
    rows = own.select(*lead, *contract.source_columns("customers"), *tail).coalesce(1)
    rows.write.mode("append").options(**sinks._csv_options(EXPORT.null_token)).csv(f"{root}/{EXPORT.change_dir}")


@query(
    """select * from (with part as (select *, cast(customer_id as int) % 3 as p from cdc_customers where cast(customer_id as int) % 3 < 2),
       live as (select p, count(*) as n from (select p, customer_id, arg_max(_op, _source_order) as op from part group by p, customer_id)
                where op <> 'D' group by p),
       sums as (select count(*) filter (where p = 0) as first, count(*) as every,
                  count(*) filter (where p = 0 and _source_order % 5 = 2) as broken from part)
       select 1 as step, true as ran, first as raw_rows, broken as violations, cast(0 as bigint) as customers from sums
       union all select 2, true, first, 0, (select coalesce(sum(n), 0) from live where p = 0) from sums
       union all select 3, false, first, 0, (select coalesce(sum(n), 0) from live where p = 0) from sums
       union all select 4, true, every, 0, (select coalesce(sum(n), 0) from live) from sums)"""
)
def gated_batches(c: Context) -> DataFrame:
    """A violation chosen by the table stops a build and publishes nothing; the retry lands nothing twice;
    an unchanged listing is skipped; a new file runs again."""
    store, root = c.new_warehouse(), work_folder(c.spark, "gated")
    parts = []

    def run(step: int, broken: bool) -> None:
        violations = 0

        def make(store: warehouse.Warehouse) -> None:
            raw = store.raw_tables()
            if broken:
                key = F.when(F.col("_source_order") % 5 != 2, F.col("customer_id"))
                build.build(store, {**raw, "customers": raw["customers"].withColumn("customer_id", key)}, allow=("relationships",))
            else:
                build.build(store, allow=("relationships",))

        try:
            ran = batches.run_batch(store, root, f"run {step}", make, EXPORT) is not None
        except checks.CheckFailure as failure:
            ran = True
            violations = sum(r["violations"] for r in failure.failures if r["check"] == "required_source_key")
        customers = F.lit(0).cast("long")
        if publish.current_versions(store):
            customers = F.lit(publish.read_mart(store, "dim_customers").count())
        counted = store.raw("customers").agg(F.count(F.lit(1)).alias("raw_rows")).first()["raw_rows"]
        row = [F.lit(step).alias("step"), F.lit(ran).alias("ran"), F.lit(counted).alias("raw_rows")]
        parts.append(c.spark.range(1).select(*row, F.lit(violations).cast("long").alias("violations"), customers.alias("customers")))

    _put_changes(c, root, 0)
    for step, broken in ((1, True), (2, False), (3, False)):
        run(step, broken)
    _put_changes(c, root, 1)
    run(4, False)
    return profiles.union_tables(parts)


@query(
    _per_table(
        """select '{t}' as source_table, count(distinct _event_id) as unique_events, true as events_within,
             true as people_within from raw_{t}"""
    )
)
def distinct_estimates(c: Context) -> DataFrame:
    """Sketches kept by load, merged, within four standard errors of the exact counts of events and people."""
    sketches.refresh(c.landed)
    if sketches.refresh(c.landed):
        raise AssertionError("a load was sketched twice")
    guessed = sketches.estimates(c.landed).withColumnsRenamed({"unique_events": "_events", "people": "_people", "source_table": "_of"})
    parts = []
    for table in contract.TABLES:
        raw = c.landed.raw(table)
        people = F.countDistinct("customer_unique_id") if table == "customers" else F.lit(0).cast("long")
        parts.append(raw.agg(F.lit(table).alias("source_table"), F.countDistinct("_event_id").alias("unique_events"), people.alias("people")))
    exact = profiles.union_tables(parts)

    def within(estimate: str, count: str):
        return F.abs(F.col(estimate) - F.col(count)) <= 4 * sketches.STANDARD_ERROR * F.col(count)

    joined = exact.join(guessed, F.col("source_table") == F.col("_of"))
    return joined.select(
        "source_table", "unique_events", within("_events", "unique_events").alias("events_within"), within("_people", "people").alias("people_within")
    )


@query(
    """select order_id, case when cast(order_id as bigint) % 500 = 3 then 'changed' else 'missing_in_target' end as kind
       from cur_orders where cast(order_id as bigint) % 500 in (3, 7)"""
)
def mismatched_keys_by_range(c: Context) -> DataFrame:
    """A few changed and lost orders, found through checksums of ranges kept beside the source."""
    orders, number = c.stored_live["orders"], F.col("order_id").cast("long") % 500
    other = F.when(number == 3, F.lit("else")).otherwise(F.col("status"))
    target = orders.filter(number != 7).withColumn("status", other)
    columns = contract.source_columns("orders")
    folder = work_folder(c.spark, "range-sums")
    compare.range_sums(orders, "order_id", columns).write.parquet(folder)
    found = compare.mismatches_by_range(orders, target, "order_id", columns, known=c.spark.read.parquet(folder))
    return found.select("order_id", "kind")


@query(
    """with loads as (
         select 'table-' || (user_id % 4) as source_table, min(ts) + to_days(cast(k as integer)) as load_start,
           min(ts) + to_days(cast(k as integer)) + interval 30 hour as load_end
         from events cross join (values (0), (1), (1), (9)) r(k) where user_id % 4 < 3 group by user_id % 4, k)
       select e.event_id, 'table-' || (e.user_id % 4) as source_table,
         exists (select 1 from loads l where l.source_table = 'table-' || (e.user_id % 4)
                 and l.load_start < e.ts and e.ts + interval 1 minute < l.load_end) as inside_load
       from events e"""
)
def commits_inside_several_loads(c: Context) -> DataFrame:
    """Loads that overlap, repeat and leave gaps, several of each table but one."""
    commits = _commits(c)
    first = commits.filter("source_table <> 'table-3'").groupBy("source_table").agg(F.min("before_commit").alias("_first"))
    days = first.withColumn("_day", F.explode(F.array(*[F.lit(k) for k in (0, 1, 1, 9)])))
    start = F.col("_first") + F.make_dt_interval("_day")
    loads = days.select("source_table", start.alias("load_start"), (start + F.expr("interval 30 hours")).alias("load_end"))
    return intervals.commits_inside_loads(commits, loads).select("event_id", "source_table", "inside_load")
