"""The same queries in SQL, written against the driver tables alone.

Nothing here is generated from the Spark plans: the feeds, the cleaning rules, the history rules
and the stars are stated again, so that a mistake on either side shows as a difference.
"""

from __future__ import annotations

D1, D2 = "date '2024-01-31'", "date '2024-02-01'"
DAY = {1: D1, 2: D2}
OPEN_END = "date '9999-12-31'"
ACTOR = "lakestar_elt"
CAL_START, CAL_END = "date '1995-01-01'", "date '2002-12-31'"

SPEC = "%d-%m-%Y %I:%M:%S %p"


def stamp(ts: str) -> str:
    return f"strftime({ts}, '{SPEC}')"


def parse(c: str) -> str:
    return f"try_strptime({c}, '{SPEC}')"


def title(c: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({c}), ' '), "
        f"lambda x: upper(x[1]) || x[2:]), ' ')"
    )


def amount(x: str) -> str:
    return f"cast(cast({x} as decimal(18,2)) as varchar)"


def load_date(day: int) -> str:
    return D1 if day == 1 else f"case when k % 37 = 0 then {D1} else {D2} end"


def ident(prefix: str, retired: str, number: str, day: int) -> str:
    if day == 1:
        return f"(case when k % 10 = 0 then '{retired}' else '{prefix}' end || {number})"
    return f"('{prefix}' || {number})"


def spelled(id_: str) -> str:
    return f"(case when k % 17 = 0 or v = 2 then '  ' || {id_} || ' ' else {id_} end)"


def unless(n: int, x: str) -> str:
    return f"(case when k % {n} <> 0 then {x} end)"


def copies(source: str, *extra: tuple[int, int]) -> str:
    parts = [f"select *, 0 as v from ({source})"]
    parts += [f"select *, {v} as v from ({source}) where k % {n} = 0" for v, n in extra]
    return " union all ".join(parts)


def state(day: int) -> str:
    spaced = f"case when k % 17 = 0 then ' ' || lower(n_name) || ' ' else {title('n_name')} end"
    return f"case when k % 7 = 0 then 'new ' else '' end || ({spaced})" if day == 2 else spaced


# ------------------------------------------------------------------ raw feeds


def customers_feed(day: int) -> str:
    src = "select *, c_custkey as k from customer join nation on c_nationkey = n_nationkey"
    email = "case when v = 2 then 'alt.' else '' end || c_name || '@Example.com'"
    return f"""
        select {unless(23, spelled(ident('c', 'r', 'c_custkey', day)))} as customer_id,
               {unless(19 if day == 1 else 13, email)} as customer_email_id,
               {state(day)} as customer_state,
               n_name[1:2] as customer_state_code,
               {load_date(day)} as load_date
        from ({copies(src, (1, 29), (2, 31))})"""


def orders_feed(day: int) -> str:
    src = "select *, o_orderkey as k, o_orderdate + to_seconds(o_orderkey % 86400) as bought from orders"
    changed = "when k % 7 = 0 then 'delivered'" if day == 2 else ""
    approved = stamp("bought + interval 2 hour")
    delivered = stamp("bought + interval 7 day")
    return f"""
        select {unless(23, spelled(ident('o', 'x', 'o_orderkey', day)))} as order_id,
               {unless(41, "'c' || o_custkey")} as customer_id,
               case when v = 2 then 'shipped' {changed} when o_orderstatus = 'F' then 'delivered'
                    when o_orderstatus = 'P' then 'shipped' else 'created' end as order_status,
               case when k % 43 = 0 then 'no date' else {stamp('bought')} end as order_purchase_timestamp,
               {unless(13, approved) if day == 1 else approved} as order_approved_at,
               {stamp('bought + interval 2 day')} as order_delivered_carrier_date,
               {unless(11, delivered) if day == 2 else delivered} as order_delivered_customer_date,
               {stamp('bought + interval 10 day')} as order_estimated_delivery_date,
               {load_date(day)} as load_date
        from ({copies(src, (1, 29), (2, 31))})"""


def products_feed(day: int) -> str:
    src = """select *, l_partkey + l_suppkey as k
             from (select distinct l_partkey, l_suppkey from lineitem) join part on l_partkey = p_partkey"""
    raised = "case when k % 7 = 0 then 1 else 0 end" if day == 2 else "0"
    freight = amount("p_size * 1.5::double")
    return f"""
        select {unless(23, spelled(ident('p', 'q', 'l_partkey', day)))} as product_id,
               's' || l_suppkey as seller_id,
               p_type as product_category_name,
               case when k % 17 = 0 then ' ' || lower(p_type) else p_type end as product_category_name_english,
               {amount(f'p_retailprice + {raised}')} as price,
               {unless(13, freight) if day == 1 else freight} as freight_value,
               cast(length(p_name) as varchar) as product_name_length,
               p_size || case when k % 5 = 0 then '.0' else '' end as product_description_length,
               case when k % 11 = 0 then 'x' else cast(p_size % 6 as varchar) end as product_photos_qty,
               {amount('p_size * 100.5::double')} as product_weight_g,
               cast(p_size as varchar) as product_length_cm,
               cast(p_size + 1 as varchar) as product_height_cm,
               cast(p_size + 2 as varchar) as product_width_cm,
               {load_date(day)} as load_date
        from ({copies(src, (1, 29), (2, 31))})"""


def sellers_feed(day: int) -> str:
    src = "select *, s_suppkey as k from supplier join nation on s_nationkey = n_nationkey"
    return f"""
        select {unless(23, spelled(ident('s', 't', 's_suppkey', day)))} as seller_id,
               {state(day)} as seller_state,
               n_name[1:2] as seller_state_code,
               {load_date(day)} as load_date
        from ({copies(src, (1, 29), (2, 31))})"""


def items_feed(day: int) -> str:
    src = "select *, l_orderkey + l_partkey + l_suppkey as k from lineitem"
    raised = "case when k % 7 = 0 then 1 else 0 end" if day == 2 else "0"
    oid = ident("o", "x", "l_orderkey", day)
    return f"""
        select case when k % 17 = 0 then '  ' || {oid} || ' ' else {oid} end as order_id,
               {unless(19, "cast(l_linenumber + case when v >= 2 then v * 100 else 0 end as varchar)")}
                   as order_item_id,
               {unless(23, "'p' || l_partkey")} as product_id,
               's' || l_suppkey as seller_id,
               {stamp('l_shipdate + to_days(case when v = 3 then 1 else 0 end)')} as shipping_limit_date,
               {amount(f'l_extendedprice + {raised}')} as price,
               {amount('l_tax * 100')} as freight_value,
               {load_date(day)} as load_date
        from ({copies(src, (1, 29), (2, 31), (3, 41))})"""


def payments_feed(day: int) -> str:
    src = "select *, o_orderkey as k from orders"
    oid = "('o' || o_orderkey)"
    return f"""
        select {unless(23, spelled(oid))} as order_id,
               case when v = 3 then '2' else '1' end as payment_sequential,
               case when v = 2 then 'voucher' when k % 3 = 0 then 'credit_card'
                    when k % 3 = 1 then 'boleto' else 'debit_card' end as payment_type,
               {amount('o_totalprice')} as payment_value,
               {load_date(day)} as load_date
        from ({copies(src, (1, 29), (2, 31), (3, 5))})"""


def ratings_feed(day: int) -> str:
    src = "select *, event_id as k from events"
    changed = "when k % 7 = 0 then '4'" if day == 2 else ""
    return f"""
        select {unless(23, spelled(ident('g', 'h', 'event_id', day)))} as rating_id,
               'o' || event_id as order_id,
               case when k % 53 = 0 then '5.5' when k % 59 = 0 then 'x' when k % 61 = 0 then null
                    {changed} else cast(floor(value)::bigint % 7 as varchar) end as rating_score,
               {unless(13, stamp('ts')) if day == 1 else stamp('ts')} as rating_survey_creation_date,
               case when k % 43 = 0 then 'no date' else {stamp('ts')} end as rating_survey_answer_timestamp,
               {load_date(day)} as load_date
        from ({copies(src, (1, 29), (2, 31))})"""


FEED = {
    "Customers": customers_feed,
    "Orders": orders_feed,
    "Products": products_feed,
    "Sellers": sellers_feed,
    "Order_Items": items_feed,
    "Order_Payments": payments_feed,
    "Order_Ratings": ratings_feed,
}

# Dedupe key and remaining columns of each feed, in the order that breaks ties.
RAW = {
    "Customers": (["customer_id"], ["customer_email_id", "customer_state", "customer_state_code"]),
    "Orders": (
        ["order_id", "customer_id"],
        [
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ],
    ),
    "Products": (
        ["product_id", "seller_id"],
        [
            "product_category_name",
            "product_category_name_english",
            "price",
            "freight_value",
            "product_name_length",
            "product_description_length",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ],
    ),
    "Sellers": (["seller_id"], ["seller_state", "seller_state_code"]),
    "Order_Items": (
        ["order_id", "order_item_id", "product_id", "seller_id"],
        ["shipping_limit_date", "price", "freight_value"],
    ),
    "Order_Payments": (["order_id", "payment_sequential"], ["payment_type", "payment_value"]),
    "Order_Ratings": (
        ["rating_id", "order_id"],
        ["rating_score", "rating_survey_creation_date", "rating_survey_answer_timestamp"],
    ),
}

REQUIRED = {app: keys for app, (keys, _) in RAW.items()} | {
    "Order_Items": ["order_id", "product_id", "seller_id"]
}


def newest(source: str, keys: list[str], rest: list[str]) -> str:
    """One row per key: the greatest by ``rest``, column by column."""
    order = ", ".join(f"{c} desc nulls last" for c in rest)
    return (
        f"select * from ({source}) "
        f"qualify row_number() over (partition by {', '.join(keys)} order by {order}) = 1"
    )


def valid(app: str, day: int) -> str:
    keys, rest = RAW[app]
    present = " and ".join(f"{c} is not null" for c in REQUIRED[app])
    kept = newest(f"select * from ({FEED[app](day)}) where {present}", keys, ["load_date", *rest])
    if app == "Order_Ratings":
        return f"select * from ({kept}) where try_cast(rating_score as double) between 1 and 5"
    return kept


# ------------------------------------------------------------------ Silver


def _int(c: str) -> str:
    return f"try_cast(try_cast({c} as double) as integer) as {c}"


def _float(c: str) -> str:
    return f"try_cast({c} as float) as {c}"


SILVER_SELECT = {
    "Customers": f"""upper(trim(customer_id)) as customer_id, lower(trim(customer_email_id)) as customer_email_id,
        {title('trim(customer_state)')} as customer_state, upper(trim(customer_state_code)) as customer_state_code""",
    "Orders": f"""upper(trim(order_id)) as order_id, upper(trim(customer_id)) as customer_id,
        {title('trim(order_status)')} as order_status,
        {parse('order_purchase_timestamp')} as order_purchase_timestamp,
        {parse('order_approved_at')} as order_approved_at,
        {parse('order_delivered_carrier_date')} as order_delivered_carrier_date,
        {parse('order_delivered_customer_date')} as order_delivered_customer_date,
        {parse('order_estimated_delivery_date')}::date as order_estimated_delivery_date""",
    "Products": f"""upper(trim(product_id)) as product_id, upper(trim(seller_id)) as seller_id,
        {title('trim(product_category_name)')} as product_category_name,
        {title('trim(product_category_name_english)')} as product_category_name_english,
        {_float('price')}, {_float('freight_value')}, {_int('product_name_length')},
        {_int('product_description_length')}, {_int('product_photos_qty')},
        {_float('product_weight_g')}, {_float('product_length_cm')}, {_float('product_height_cm')},
        {_float('product_width_cm')}""",
    "Sellers": f"""upper(trim(seller_id)) as seller_id, {title('trim(seller_state)')} as seller_state,
        upper(trim(seller_state_code)) as seller_state_code""",
    "Order_Payments": f"""upper(trim(order_id)) as order_id, {_int('payment_sequential')},
        {title("trim(replace(payment_type, '_', ' '))")} as payment_type, {_float('payment_value')}""",
    "Order_Ratings": f"""upper(trim(rating_id)) as rating_id, upper(trim(order_id)) as order_id,
        {_float('rating_score')}, {parse('rating_survey_creation_date')}::date as rating_survey_creation_date,
        {parse('rating_survey_answer_timestamp')} as rating_survey_answer_timestamp""",
}


def silver(app: str, day: int) -> str:
    if app != "Order_Items":
        return f"select {SILVER_SELECT[app]}, load_date as last_update_date from ({valid(app, day)})"
    return f"""
        select order_id, product_id, seller_id, shipping_limit_date, shipping_year,
               count(order_item_id)::bigint as item_quantity,
               round(sum(cast(price as decimal(18,2))), 2)::double as price,
               round(sum(cast(freight_value as decimal(18,2))), 2)::double as freight_value,
               last_update_date
        from (select upper(trim(order_id)) as order_id, upper(trim(product_id)) as product_id,
                     upper(trim(seller_id)) as seller_id, order_item_id, price, freight_value,
                     {parse('shipping_limit_date')} as shipping_limit_date,
                     year({parse('shipping_limit_date')})::integer as shipping_year,
                     load_date as last_update_date
              from ({valid(app, day)}))
        group by order_id, product_id, seller_id, shipping_limit_date, shipping_year, last_update_date"""


# Record key and attributes of each Silver table.
TABLE = {
    "Customers": (["customer_id"], RAW["Customers"][1]),
    "Orders": (["order_id", "customer_id"], RAW["Orders"][1]),
    "Products": (["product_id", "seller_id"], RAW["Products"][1]),
    "Sellers": (["seller_id"], RAW["Sellers"][1]),
    "Order_Items": (
        ["order_id", "product_id", "seller_id"],
        ["shipping_limit_date", "shipping_year", "item_quantity", "price", "freight_value"],
    ),
    "Order_Payments": (["order_id", "payment_sequential"], ["payment_type", "payment_value"]),
    "Order_Ratings": RAW["Order_Ratings"],
}
FLOATS = {
    "Products": {
        "price",
        "freight_value",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    },
    "Order_Payments": {"payment_value"},
    "Order_Ratings": {"rating_score"},
}


def widen(app: str, query: str) -> str:
    """32-bit floats as doubles in the result."""
    floats = FLOATS.get(app, ())
    if not floats:
        return query
    return f"select * replace ({', '.join(f'{c}::double as {c}' for c in sorted(floats))}) from ({query})"


def silver_table(app: str, day: int) -> str:
    keys, attrs = TABLE[app]
    return newest(silver(app, day), keys, ["last_update_date", *attrs])


# ------------------------------------------------------------------ dimensions

TEXT_ATTRS = {
    "customer_email_id",
    "customer_state",
    "customer_state_code",
    "seller_state",
    "seller_state_code",
    "order_status",
    "product_category_name",
    "product_category_name_english",
}


def sk(key: str) -> str:
    return key.replace("_id", "_skey")


def version(start: str, end: str, now: int, ins: str, by: str, upd: str, upd_by: str) -> str:
    return f"""{start} as eff_start_dt, {end} as eff_end_dt, {now}::integer as is_current,
        {ins} as insert_date, {by} as inserted_by, cast({upd} as date) as update_date,
        cast({upd_by} as varchar) as updated_by"""


def fresh(day: int) -> str:
    return version(DAY[day], OPEN_END, 1, DAY[day], f"'{ACTOR}'", "null", "null")


def all_new(app: str, source: str, day: int) -> str:
    keys, attrs = TABLE[app]
    ids = ", ".join(f"s.{k} || '_skey' as {sk(k)}, s.{k}" for k in keys)
    return f"select {ids}, {', '.join(f's.{a}' for a in attrs)}, {fresh(day)} from ({source}) s"


def dim_day1(app: str) -> str:
    return all_new(app, silver_table(app, 1), 1)


def on_keys(app: str) -> str:
    return " and ".join(f"s.{k} = t.{k}" for k in TABLE[app][0])


def differs(a: str) -> str:
    if a in TEXT_ATTRS:
        return f"coalesce(s.{a}, '') <> coalesce(t.{a}, '')"
    return f"s.{a} is distinct from t.{a}"


def hits(app: str) -> str:
    changes = " or ".join(differs(a) for a in TABLE[app][1])
    return f"""from ({silver_table(app, 2)}) s join ({dim_day1(app)}) t on {on_keys(app)}
        where t.is_current = 1 and t.eff_end_dt = {OPEN_END}
          and s.last_update_date > t.eff_start_dt and ({changes})"""


def scd2_new(app: str) -> str:
    source = f"""select * from ({silver_table(app, 2)}) s
        where not exists (select 1 from ({dim_day1(app)}) t where {on_keys(app)})"""
    return all_new(app, source, 2)


def scd2_active(app: str) -> str:
    keys, attrs = TABLE[app]
    ids = ", ".join(f"t.{sk(k)}, t.{k}" for k in keys)
    return f"select {ids}, {', '.join(f's.{a}' for a in attrs)}, {fresh(2)} {hits(app)}"


def scd2_inactive(app: str) -> str:
    keys, attrs = TABLE[app]
    ids = ", ".join(f"t.{sk(k)}, t.{k}" for k in keys)
    closing = version(
        "t.eff_start_dt", D1, 0, "t.insert_date", "t.inserted_by", D2, f"'{ACTOR}'"
    )
    return f"select {ids}, {', '.join(f't.{a}' for a in attrs)}, {closing} {hits(app)}"


def scd2_all(app: str) -> str:
    return f"{scd2_new(app)} union all {scd2_active(app)} union all {scd2_inactive(app)}"


def dim_day2(app: str) -> str:
    """Changes, and every stored version whose record key they do not replace."""
    record_key = [c for k in TABLE[app][0] for c in (sk(k), k)] + ["eff_end_dt"]
    same = " and ".join(f"c.{k} = t.{k}" for k in record_key)
    return f"""with changes as ({scd2_all(app)})
        select * from changes union all
        select * from ({dim_day1(app)}) t where not exists (select 1 from changes c where {same})"""


def current(app: str, day: int) -> str:
    dim = dim_day1(app) if day == 1 else dim_day2(app)
    return f"select * from ({dim}) where is_current = 1 and eff_end_dt = {OPEN_END}"


# ------------------------------------------------------------------ facts

CALENDAR = f"""select d::date as cal_date, strftime(d, '%Y%m%d') as date_skey, strftime(d, '%B') as cal_month_name
    from generate_series({CAL_START}::timestamp, {CAL_END}::timestamp, interval 1 day) g(d)"""


def sales(day: int) -> str:
    return f"""
        select dt.date_skey, c.customer_skey, o.order_skey, i.product_skey, i.seller_skey,
               o.order_purchase_timestamp, dt.cal_month_name as order_purchase_month,
               p.product_category_name_english, i.item_quantity as sales_quantity,
               i.price as net_price, i.freight_value as net_freight_value,
               i.price + i.freight_value as net_sales_amount,
               c.customer_state, c.customer_state_code, {DAY[day]} as load_date
        from ({CALENDAR}) dt
        join ({current('Orders', day)}) o on dt.cal_date = o.order_purchase_timestamp::date
        join ({current('Customers', day)}) c on o.customer_skey = c.customer_skey
        join ({current('Order_Items', day)}) i on o.order_skey = i.order_skey
        join ({current('Products', day)}) p on i.product_skey = p.product_skey and i.seller_skey = p.seller_skey
        where o.order_status = 'Delivered'"""


PAYMENTS = f"""
    select dt.date_skey, o.customer_skey, o.order_skey, o.order_status,
           o.order_approved_at as payment_approved_at, dt.cal_month_name as order_payment_month,
           p.payment_sequential, p.payment_type, p.payment_value::double as payment_value,
           {D2} as load_date
    from ({CALENDAR}) dt
    join ({current('Orders', 2)}) o on dt.cal_date = o.order_approved_at::date
    join ({silver_table('Order_Payments', 2)}) p on o.order_skey = p.order_id || '_skey'"""

FACT_KEY = ["date_skey", "customer_skey", "order_skey", "product_skey", "seller_skey"]

SALES_UPSERT = f"""
    with old_sales as ({sales(1)}), new_sales as ({sales(2)})
    select * from new_sales union all
    select * from old_sales t where not exists (
        select 1 from new_sales n where {' and '.join(f'n.{k} = t.{k}' for k in FACT_KEY)})"""

MONTHLY = f"""
    select order_purchase_month, product_category_name_english, count(*)::bigint as sales_lines,
           sum(sales_quantity)::bigint as sales_quantity,
           sum(cast(net_sales_amount as decimal(18,2)))::double as net_sales_amount
    from ({sales(2)}) group by 1, 2"""

# ------------------------------------------------------------------ upserts

ORDER_BATCH = """
    select case when o_orderkey % 5 = 0 then o_orderkey + 1000000000000 else o_orderkey end as o_orderkey,
           o_custkey,
           case when o_orderkey % 7 = 0 then 'R' else o_orderstatus end as o_orderstatus,
           o_totalprice + take as o_totalprice,
           o_orderdate + to_days(take) as o_orderdate, o_orderpriority
    from (select *, 0 as take from orders union all
          select *, 1 as take from orders where o_orderkey % 3 = 0)"""
ORDER_REST = ["o_orderdate", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def orders_upsert(keys: list[str], keep_newer: bool = False) -> str:
    rest = [c for c in ORDER_REST if c not in keys]
    same = " and ".join(f"b.{k} = o.{k}" for k in keys)
    wins = (
        f"where not exists (select 1 from orders o where {same} and o.o_orderdate > b.o_orderdate)"
        if keep_newer
        else ""
    )
    return f"""
        with batch as (select * from ({newest(ORDER_BATCH, keys, rest)}) b {wins})
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from batch
        union all
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        from orders o where not exists (select 1 from batch b where {same})"""


# ------------------------------------------------------------------ counts and logs


def counts(app: str) -> str:
    feed = FEED[app](2)
    return f"""
        select '{app}' as app,
               (select count(*) from ({feed}))::bigint as total,
               (select count(*) from ({valid(app, 2)}))::bigint as valid,
               (select count(*) from (select * from ({feed}) except select * from ({valid(app, 2)})))::bigint
                   as invalid_distinct,
               (select count(*) from ({feed}))::bigint - (select count(*) from ({valid(app, 2)}))::bigint
                   as invalid_total"""


def _load_audit() -> str:
    """Counts of the Silver orders and of their dimension before and after each of two days."""
    s1, s2 = silver_table("Orders", 1), silver_table("Orders", 2)
    merged = f"""select order_id, customer_id from ({s1}) union select order_id, customer_id from ({s2})"""
    # Orders that the second day no longer delivers stay in the Silver table unchanged, so the
    # changes come from the second delivery alone.
    n_silver1, n_silver2 = f"(select count(*) from ({s1}))", f"(select count(*) from ({merged}))"
    n_dim1, n_dim2 = n_silver1, f"(select count(*) from ({dim_day2('Orders')}))"
    rows = [
        (1, "silver_orders", "0", n_silver1),
        (1, "dim_orders", "0", n_dim1),
        (2, "silver_orders", n_silver1, n_silver2),
        (2, "dim_orders", n_dim1, n_dim2),
    ]
    return " union all ".join(
        f"""select {job}::bigint as job_id, 'daily' as job_name, 'verification' as sys_name,
            'Orders' as app_nm, '{name}' as table_name, {pre}::bigint as pre_count,
            {post}::bigint as post_count, true as succeeded, ({post} - {pre})::bigint as rows_gained"""
        for job, name, pre, post in rows
    )


def silver_two_days(app: str) -> str:
    """The second delivery, and of the first what it does not hold."""
    same = " and ".join(f"n.{k} = t.{k}" for k in TABLE[app][0])
    return f"""with n as ({silver_table(app, 2)}) select * from n union all
        select * from ({silver_table(app, 1)}) t where not exists (select 1 from n where {same})"""


def rejected(app: str) -> str:
    """What each day's load does not keep: 1 null key, 2 copy, 4 superseded, 8 out of range."""
    keys, rest = RAW[app]
    columns = ", ".join([*dict.fromkeys([*keys, *rest]), "load_date"])
    present = " and ".join(f"{c} is not null" for c in REQUIRED[app])
    order = ", ".join(f"{c} desc nulls last" for c in ["load_date", *rest])
    outside = "coalesce(try_cast(rating_score as double) between 1 and 5, false)" if app == "Order_Ratings" else "true"
    days = []
    for day in DAY:
        judged = f"""select *, case when not ({present}) then 1
                when row_number() over (partition by {', '.join(keys)} order by {order}) > 1 then 4 else 0 end
                + case when {outside} then 0 else 8 end as why
            from (select {columns}, count(*) as n from ({FEED[app](day)}) group by all)"""
        days.append(f"""select {columns}, case why when 0 then n - 1 else n end as n_rows,
                (case why when 0 then 2 else why end)::integer as reasons, {day}::bigint as job_id
            from ({judged}) where why > 0 or n > 1""")
    return " union all ".join(days)


LOST_SALES = f"""
    select * from (
        select i.order_skey, i.product_skey, i.seller_skey, i.item_quantity as sales_quantity, i.price as net_price,
               i.freight_value as net_freight_value,
               case when o.order_skey is null then 'order' when o.order_status is distinct from 'Delivered' then 'status'
                    when dt.date_skey is null then 'date' when c.customer_skey is null then 'customer'
                    when p.product_skey is null then 'product' end as lost_at
        from ({current('Order_Items', 2)}) i
        left join ({current('Orders', 2)}) o on o.order_skey = i.order_skey
        left join ({CALENDAR}) dt on dt.cal_date = o.order_purchase_timestamp::date
        left join ({current('Customers', 2)}) c on o.customer_skey = c.customer_skey
        left join ({current('Products', 2)}) p on i.product_skey = p.product_skey and i.seller_skey = p.seller_skey)
    where lost_at is not null"""

BROKEN_LINES = """
    select order_id, customer_id, case when k % 13 <> 0 then status when k % 11 = 0 then 'more' end as status,
           case when k % 11 = 0 and k % 13 = 0 then order_id || '|' || customer_id || '|more|still'
                when k % 11 = 0 then order_id || '|' || customer_id || '|' || status || '|more'
                when k % 13 = 0 then order_id || '|' || customer_id end as broken_line
    from (select o_orderkey as k, o_orderkey::varchar as order_id, o_custkey::varchar as customer_id,
                 o_orderstatus as status from orders)"""

SPACED = "'  ' || c_mktsegment || ' of ' || c_name || ' '"
EVENT_AMOUNT = amount("value")

SHIFTED = """select c_custkey,
        case when c_custkey % 5 = 0 then '' when c_custkey % 3 <> 0 then c_mktsegment end as segment,
        case when c_custkey % 4 <> 0 then c_acctbal end as balance,
        case when c_custkey % 3 <> 0 then c_nationkey end as nation from customer"""

LINE_COLUMNS = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]

ORACLES: dict[str, str] = {
    "scan_csv_strings": "select cast(c_custkey as varchar) as c_custkey, c_name, c_mktsegment from customer",
    "scan_project": "select o_orderkey, o_custkey, o_orderstatus from orders",
    "bronze_ingest_audit": f"""
        select cast(s_suppkey as varchar) as s_suppkey, s_name, cast(s_nationkey as varchar) as s_nationkey,
               {amount('s_acctbal')} as s_acctbal, 20240201::bigint as process_id, {D2} as load_date,
               true as uuid_is_set from supplier""",
    "audit_columns": f"select *, 20240201::bigint as process_id, {D2} as load_date from orders",
    "ingest_spec_enabled": """
        select r_name as sys_name, n_name as app_name, n_nationkey as load_order, 'raw' as inbound_bucket,
               lower(r_name) || '/' as raw_file_path, lower(n_name) || '.csv' as raw_file_name,
               'csv' as raw_file_format, ',' as delimiter, 'bronze/' || lower(n_name) as bronze_file_path,
               'bronze_' || lower(n_name) as bronze_table_name
        from nation join region on n_regionkey = r_regionkey
        where r_name = 'ASIA' and length(n_name) > 8 order by n_nationkey nulls last""",
    "dq_required_not_null": """
        select o_orderkey, nullif(o_custkey % 11, 0) as customer_ref, o_orderstatus from orders
        where o_orderkey is not null and nullif(o_custkey % 11, 0) is not null""",
    "dedupe_by_key": newest("select * from lineitem", ["l_orderkey", "l_linenumber"], LINE_COLUMNS),
    "valid_invalid_counts": " union all ".join(counts(app) for app in FEED),
    "invalid_rows_except": f"select * from ({items_feed(2)}) except select * from ({valid('Order_Items', 2)})",
    "standardize_strings": f"""
        select c_custkey, upper(trim({SPACED})) as as_id, lower(trim({SPACED})) as as_lower,
               {title(f'trim({SPACED})')} as as_title from customer""",
    "translate_payment_type": f"""
        select o_orderkey, {title("trim(translate(lower(translate(o_orderpriority, ' -', '__')), '_', ' '))")}
            as label from orders""",
    "surrogate_key": """
        select 'O' || o_orderkey as order_id, 'O' || o_orderkey || '_skey' as order_skey,
               nullif(o_orderstatus, 'P') || '_skey' as status_skey from orders""",
    "parse_12h_timestamps": f"""
        select event_id, case when event_id % 13 <> 0 then date_trunc('second', ts) end as parsed_at,
               case when event_id % 13 <> 0 then ts::date end as parsed_day from events""",
    "lenient_numeric_casts": f"""
        select event_id, try_cast(case when event_id % 11 = 0 then 'x' else {EVENT_AMOUNT} end as float)::double
                   as amount,
               case when event_id % 7 <> 0 then floor(value)::integer end as whole from events""",
    "score_range_filter": """
        select event_id, cast(cast(value as decimal(18,2)) % 7 as varchar) as score from events
        where event_id % 11 <> 0 and cast(value as decimal(18,2)) % 7 between 1 and 5""",
    "null_safe_change": f"""
        select n.c_custkey, coalesce(o.segment, '') <> coalesce(n.segment, '') as segment_changed,
               o.balance is distinct from n.balance as balance_changed,
               o.nation is distinct from n.nation as nation_changed
        from ({SHIFTED}) n join (select * replace (c_custkey + 1 as c_custkey) from ({SHIFTED})) o
          on n.c_custkey = o.c_custkey""",
    "items_rollup": """
        select l_orderkey as order_id, l_partkey % 5 as product_id, l_suppkey % 5 as seller_id,
               l_shipdate as shipping_limit_date, year(l_shipdate)::integer as shipping_year,
               count(nullif(l_linenumber, 3))::bigint as item_quantity,
               sum(cast(l_extendedprice as decimal(18,2)))::double as price,
               sum(cast(l_tax * 100 as decimal(18,2)))::double as freight_value
        from lineitem group by 1, 2, 3, 4, 5""",
    **{f"silver_{app.lower()}": widen(app, silver(app, 2)) for app in FEED},
    "upsert_latest_wins": orders_upsert(["o_orderkey"]),
    "upsert_keep_newer": orders_upsert(["o_orderkey"], keep_newer=True),
    "upsert_partition_scoped": orders_upsert(["o_orderkey", "o_orderstatus"]),
    **{
        f"scd2_{part}_{app.lower()}": widen(app, make(app))
        for part, make in (
            ("new", scd2_new),
            ("active", scd2_active),
            ("inactive", scd2_inactive),
            ("upsert", scd2_all),
            ("apply", dim_day2),
        )
        for app in FEED
        if app != "Order_Payments"
    },
    "date_dim": """
        select d::date as cal_date, strftime(d, '%Y%m%d') as date_skey, strftime(d, '%B') as cal_month_name
        from (select unnest(generate_series(min(o_orderdate)::date::timestamp, max(o_orderdate)::date::timestamp,
                                            interval 1 day)) as d from orders)""",
    "date_join": f"""
        select o_orderkey, o_orderdate, date_skey, cal_month_name
        from orders join ({CALENDAR}) on cal_date = o_orderdate::date""",
    "undated_orders": f"""
        select o_orderkey, o_orderdate from orders
        where o_orderdate is null or o_orderdate::date not between {CAL_START} and {CAL_END}""",
    "dim_current_snapshot": current("Orders", 2),
    "fact_sales": sales(2),
    "fact_order_payments": PAYMENTS,
    "fact_sales_upsert": SALES_UPSERT,
    "fact_sales_sink": f"""select * replace (nullif(order_purchase_month, 'March') as order_purchase_month)
        from ({SALES_UPSERT})""",
    "bronze_reload": f"""select s_suppkey::varchar as s_suppkey, s_name, '2' as delivery, {D2} as load_date
        from supplier where s_suppkey % 5 <> 2""",
    **{f"dimension_sink_{app.lower()}": widen(app, dim_day2(app)) for app in ("Products", "Order_Items")},
    **{f"silver_sink_{app.lower()}": widen(app, silver_two_days(app)) for app in ("Products", "Order_Items")},
    **{f"quarantine_{app.lower()}": rejected(app) for app in ("Order_Ratings", "Order_Items")},
    "lost_sales": LOST_SALES,
    "scan_broken_lines": BROKEN_LINES,
    "load_audit_log": _load_audit(),
    "monthly_sales_by_category": MONTHLY,
}
