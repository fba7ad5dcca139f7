"""Reference results in plain SQL over the analytic tables, for DuckDB.

``RELATIONS`` states the derived change log and every layer above it once;
``statement`` puts the relations a query mentions in front of it.
"""

from __future__ import annotations

import re

from tidemark import contract

COPIES = "select * from {name} union all select * exclude (_source_file), 'cdc/replay-000.csv' as _source_file from {name} where _source_order % {every} = 0"

ENVELOPE = "_event_id, _op, _source_order, _commit_at, _is_snapshot, _source_file"


def _instant(column: str) -> str:
    return (
        f"case when {column} like '%+02:00' then cast(substr({column}, 1, 19) as timestamp) - interval 2 hour "
        f"else cast(replace({column}, 'Z', '') as timestamp) end"
    )


def _order_columns(step: str) -> str:
    day = "cast(o_orderdate as date)"

    def stamp(days: int, clock: str) -> str:
        return f"cast(cast({day} + {days} as date) as varchar) || '{clock}'"

    return f"""cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as customer_id,
      case {step} when 0 then 'created' when 1 then 'approved' when 2 then 'shipped' else 'delivered' end as status,
      {stamp(0, ' 08:15:00')} as purchased_at,
      case when {step} >= 1 then {stamp(1, ' 10:00:00.250000')} end as approved_at,
      case when {step} >= 2 then {stamp(3, 'T06:30:00')} end as carrier_delivered_at,
      case when {step} >= 3 then {stamp(8, ' 17:45:10')} end as customer_delivered_at,
      {stamp(20, '')} as estimated_delivery_at"""


RELATIONS: dict[str, str] = {
    "snap_customers": """
      select cast(c_custkey as varchar) as customer_id, 'P' || (c_custkey % 1000) as customer_unique_id,
        lpad(cast(c_custkey as varchar), 8, '0') as postal_code, 'base-' || (c_custkey % 7) as city,
        'N' || (c_custkey % 25) as state,
        case when c_custkey % 10 = 3 then '2024-02-01 00:00:00' else '2023-12-31 00:00:00' end as updated_at,
        'snapshot:customers:' || c_custkey as _event_id, 'I' as _op, cast(0 as decimal(35,0)) as _source_order,
        case when c_custkey % 10 = 3 then timestamp '2024-02-01 00:00:00' else timestamp '2023-12-31 00:00:00' end as _commit_at,
        true as _is_snapshot, 'initial-load/customers/LOAD00000001.csv' as _source_file
      from customer""",
    "cdc_customers": """
      select cast(user_id as varchar) as customer_id, 'P' || (user_id % 1000) as customer_unique_id,
        case when event_id % 11 <> 0 then lpad(cast(user_id as varchar), 8, '0') end as postal_code,
        case when event_type in ('purchase', 'signup') then 'segment, "' || (event_id % 3) || '"'
             when event_type = 'click' and event_id % 13 = 0 then ''
             when event_type = 'view' and event_id % 17 = 0 then 'line one' || chr(10) || 'line ' || (event_id % 2)
             else 'base-' || (user_id % 7) end as city,
        'N' || (user_id % 25) as state, cast(ts as varchar) as updated_at,
        'cdc:customers:' || (event_id + 1) as _event_id,
        case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as _op,
        cast(event_id + 1 as decimal(35,0)) as _source_order, cast(ts as timestamp) as _commit_at,
        false as _is_snapshot,
        'cdc/' || lpad(cast((event_id * 7919) % 64 as varchar), 3, '0') || '.csv' as _source_file
      from events""",
    "raw_customers": "select * from snap_customers union all " + COPIES.format(name="cdc_customers", every=7),
    "snap_orders": f"""
      select {_order_columns('0')}, '2023-12-31 00:00:00' as updated_at,
        'snapshot:orders:' || o_orderkey as _event_id, 'I' as _op, cast(0 as decimal(35,0)) as _source_order,
        timestamp '2023-12-31 00:00:00' as _commit_at, true as _is_snapshot,
        'initial-load/orders/LOAD00000001.csv' as _source_file
      from orders""",
    "order_steps": "select o.*, s.step from orders o join (values (1), (2), (3)) s(step) on o.o_orderkey % 5 = 0",
    "cdc_orders": f"""
      select {_order_columns('step')}, '2024-03-0' || step || ' 12:00:00+02:00' as updated_at,
        'cdc:orders:' || (o_orderkey * 10 + step) as _event_id,
        case when o_orderkey % 20 = 5 and step = 2 then 'D' when o_orderkey % 20 = 5 and step = 3 then 'I'
             when o_orderkey % 20 = 10 and step = 3 then 'D' else 'U' end as _op,
        cast(o_orderkey * 10 + step as decimal(35,0)) as _source_order,
        cast('2024-03-0' || step || ' 10:00:00' as timestamp) as _commit_at, false as _is_snapshot,
        'cdc/' || lpad(cast((o_orderkey * 31) % 64 as varchar), 3, '0') || '.csv' as _source_file
      from order_steps""",
    "raw_orders": "select * from snap_orders union all " + COPIES.format(name="cdc_orders", every=9),
    "line_text": """
      select l_orderkey || ':' || l_linenumber as order_item_key, cast(l_orderkey as varchar) as order_id,
        cast(l_linenumber as varchar) as order_item_id, 'p' || l_partkey as product_id, 's' || l_suppkey as seller_id,
        cast(cast(l_shipdate as date) as varchar) || ' 00:00:00' as shipping_limit_at,
        cast(cast(l_extendedprice as decimal(14,2)) as varchar) as price,
        cast(cast(l_quantity as decimal(14,2)) as varchar) as freight_value,
        cast(cast(l_shipdate as date) as varchar) || ' 09:00:00Z' as updated_at,
        case when l_returnflag = 'R' then 'D' when l_linestatus = 'F' then 'U' else 'I' end as _op,
        l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|'
          || cast(l_extendedprice as decimal(14,2)) || '|' || cast(l_quantity as decimal(14,2)) || '|'
          || l_returnflag || '|' || l_linestatus as contents,
        cast(cast(l_shipdate as date) as timestamp) + interval 9 hour as _commit_at,
        'cdc/' || lpad(cast(l_partkey % 64 as varchar), 3, '0') || '.csv' as _source_file
      from lineitem""",
    "cdc_order_items": """
      select order_item_key, order_id, order_item_id, product_id, seller_id, shipping_limit_at, price, freight_value,
        updated_at, 'cdc:order_items:' || (cast('0x' || substr(md5(contents), 1, 15) as hugeint) + 1) as _event_id, _op,
        cast(cast('0x' || substr(md5(contents), 1, 15) as hugeint) + 1 as decimal(35,0)) as _source_order,
        _commit_at, false as _is_snapshot, _source_file
      from line_text""",
    "raw_order_items": COPIES.format(name="cdc_order_items", every=11),
    "raw_order_payments": """
      select o_orderkey || ':' || part as payment_key, cast(o_orderkey as varchar) as order_id,
        cast(part as varchar) as payment_sequential,
        case when part = 1 then 'credit_card' else 'voucher' end as payment_type,
        cast(o_orderkey % 10 + 1 as varchar) as payment_installments,
        case when part = 1 then cast(cast(cast(o_totalprice as decimal(14,2)) - 10 as decimal(14,2)) as varchar)
             else '10.00' end as payment_value,
        '2023-12-31 00:00:00' as updated_at,
        'snapshot:order_payments:' || o_orderkey || ':' || part as _event_id, 'I' as _op,
        cast(0 as decimal(35,0)) as _source_order, timestamp '2023-12-31 00:00:00' as _commit_at,
        true as _is_snapshot, 'initial-load/order_payments/LOAD00000001.csv' as _source_file
      from orders join (values (1), (2)) p(part) on part <= o_orderkey % 3""",
    # staging -----------------------------------------------------------------
    "typed_customers": f"""
      select customer_id, customer_unique_id, postal_code, city, state, {_instant('updated_at')} as updated_at, {ENVELOPE}
      from raw_customers""",
    "typed_orders": f"""
      select order_id, customer_id, status, cast(purchased_at as timestamp) as purchased_at,
        cast(approved_at as timestamp) as approved_at, cast(carrier_delivered_at as timestamp) as carrier_delivered_at,
        cast(customer_delivered_at as timestamp) as customer_delivered_at,
        cast(estimated_delivery_at as timestamp) as estimated_delivery_at, {_instant('updated_at')} as updated_at, {ENVELOPE}
      from raw_orders""",
    "typed_order_items": f"""
      select order_item_key, order_id, cast(order_item_id as integer) as order_item_id, product_id, seller_id,
        cast(shipping_limit_at as timestamp) as shipping_limit_at, cast(price as decimal(14,2)) as price,
        cast(freight_value as decimal(14,2)) as freight_value, {_instant('updated_at')} as updated_at, {ENVELOPE}
      from raw_order_items""",
    "typed_order_payments": f"""
      select payment_key, order_id, cast(payment_sequential as integer) as payment_sequential, payment_type,
        cast(payment_installments as integer) as payment_installments, cast(payment_value as decimal(14,2)) as payment_value,
        {_instant('updated_at')} as updated_at, {ENVELOPE}
      from raw_order_payments""",
}

KEYS = {
    "customers": "customer_id",
    "orders": "order_id",
    "order_items": "order_item_key",
    "order_payments": "payment_key",
}
for _table, _key in KEYS.items():
    _fields = ", ".join(f"{c} := {c}" for c in contract.source_columns(_table))
    RELATIONS[f"stg_{_table}"] = (
        f"select * from typed_{_table} qualify row_number() over (partition by _event_id order by _source_file) = 1"
    )
    # The greatest (sequence, id) of a key names its last event; a deletion there leaves no row.
    RELATIONS[f"cur_{_table}"] = f"""
      select unnest(state) from (
        select arg_max_null(case when _op = 'D' then null else struct_pack({_fields}) end,
                       row(_source_order, _event_id)) as state
        from (select * from stg_{_table}) group by {_key}) where state is not null"""

ATTRIBUTES = contract.CUSTOMER_ATTRIBUTES


def prefixed(*columns: str) -> str:
    return " || ".join(f"coalesce(length({c}) || ':' || {c}, '-1:')" for c in columns)



def history(key: str, staged: str, columns: tuple[str, ...], prefix: str = "") -> dict[str, str]:
    """Relations of the version history: rows are numbered and met with their neighbours by number.

    A snapshot row counts only if it is older than every change of its key.
    """
    differs = " or ".join(f"a.{c} is distinct from b.{c}" for c in columns)
    return {
        f"{prefix}first_change": f"select {key}, min(_commit_at) as first_cdc_at from {staged} where not _is_snapshot group by {key}",
        f"{prefix}kept": f"""
          select e.* from {staged} e where not e._is_snapshot or not exists (
            select 1 from {prefix}first_change f where f.{key} is not distinct from e.{key} and f.first_cdc_at <= e._commit_at)""",
        f"{prefix}numbered": f"""
          select e.*, (select count(*) from {prefix}kept o where o.{key} is not distinct from e.{key}
            and (o._source_order, o._event_id) <= (e._source_order, e._event_id)) as n from {prefix}kept e""",
        f"{prefix}changes": f"""
          select b.* from {prefix}numbered b left join {prefix}numbered a
            on a.{key} is not distinct from b.{key} and a.n = b.n - 1
          where a.n is null or {differs} or (a._op = 'D') <> (b._op = 'D')""",
        f"{prefix}versions": f"""
          select v.*, (select min(w.n) from {prefix}changes w where w.{key} is not distinct from v.{key} and w.n > v.n) as next_n
          from {prefix}changes v""",
        f"{prefix}bounded": f"""
          select v.*, w._commit_at as observed_to, w._source_order as source_order_to
          from {prefix}versions v left join {prefix}changes w on w.{key} is not distinct from v.{key} and w.n = v.next_n""",
    }


def version_columns(key: str, version: str, columns: tuple[str, ...]) -> str:
    return (
        f"md5({key} || ':' || cast(_source_order as varchar)) as {version}, {key}, {', '.join(columns)}, "
        "_commit_at as observed_from, observed_to, _source_order as source_order_from, source_order_to, "
        "_op = 'D' as is_deleted, _is_snapshot as is_initial_snapshot, next_n is null and _op <> 'D' as is_current"
    )


RELATIONS |= history("customer_id", "stg_customers", ATTRIBUTES)
RELATIONS |= history("order_id", "stg_orders", ("status",), "order_")
RELATIONS |= {
    "timed": "select * from stg_customers left join first_change using (customer_id)",
    "hashed": f"""
      select _event_id, md5({prefixed(*ATTRIBUTES)} || case _op when 'D' then 'deleted' else 'present' end) as attribute_hash
      from kept""",
    "dim_customer_history": f"select {version_columns('customer_id', 'customer_version_id', ATTRIBUTES)} from bounded",
    "dim_customers": "select customer_id, customer_unique_id, postal_code, city, state from cur_customers",
    "fct_order_items": "select * exclude (updated_at) from cur_order_items",
    "fct_order_payments": "select * exclude (updated_at) from cur_order_payments",
    # One row per detail, each filling its own side; sums over both sides at once.
    "details": """
      select order_id, price as item, freight_value as freight, 1 as items, null as payment, 0 as payments from cur_order_items
      union all select order_id, null, null, 0, payment_value, 1 from cur_order_payments""",
    "sums": """
      select order_id, cast(sum(item) as decimal(18,2)) as item_total, cast(sum(freight) as decimal(18,2)) as freight_total,
        cast(sum(items) as bigint) as item_count, cast(sum(payment) as decimal(18,2)) as payment_total,
        cast(sum(payments) as bigint) as payment_count
      from details group by order_id""",
    "item_totals": "select order_id, item_total, freight_total, item_count from sums where item_count > 0",
    "payment_totals": "select order_id, payment_total, payment_count from sums where payment_count > 0",
    "fct_orders": """
      select cur_orders.* exclude (updated_at), ifnull(item_total, 0.00) as item_total,
        ifnull(freight_total, 0.00) as freight_total,
        cast(ifnull(item_total + freight_total, 0.00) as decimal(18,2)) as order_total,
        ifnull(item_count, 0) as item_count, ifnull(payment_total, 0.00) as payment_total,
        ifnull(payment_count, 0) as payment_count, ifnull(item_count, 0) > 0 as has_items,
        ifnull(payment_count, 0) > 0 as has_payments
      from cur_orders left join sums using (order_id)""",
}


def _mentioned(sql: str) -> set[str]:
    return {name for name in RELATIONS if re.search(rf"\b{name}\b", sql)}


def statement(body: str) -> str:
    """``body`` with every relation it needs as a common table expression.

    A trailing mention inside another relation counts, and relations keep the
    order in which they are defined.
    """
    needed: set[str] = set()
    todo = _mentioned(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= _mentioned(RELATIONS[name]) - needed
    ctes = [f"{name} as ({RELATIONS[name]})" for name in _ordered(needed)]
    return ("with " + ",\n".join(ctes) + "\n" if ctes else "") + body


def _ordered(names: set[str]) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for other in sorted(_mentioned(RELATIONS[name]) - {name}):
            visit(other)
        done.append(name)

    for name in RELATIONS:
        if name in names:
            visit(name)
    return done
