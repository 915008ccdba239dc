"""Independent DuckDB SQL for every catalogue query (the correctness oracle).

Each string runs on DuckDB with the given tables registered as views.  The
fixture CTEs are the SQL twins of ``riverbed.sources.fixtures``; the rest
re-states each operator's semantics in plain SQL.
"""

from __future__ import annotations

WS = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
_WS_SQL = "'" + WS.replace("'", "''") + "'"


def clean(x: str) -> str:
    """F1 in SQL."""
    return f"nullif(trim({x}, {_WS_SQL}), '')"


def upper_default(x: str, default: str) -> str:
    return f"coalesce(upper({clean(x)}), '{default}')"


def country(x: str, doc: bool = False) -> str:
    vn = "'VIETNAM', 'VIET NAM', 'VN'" if doc else "'VIETNAM', 'VIET NAM'"
    u = f"upper({clean(x)})"
    return (f"(case when {u} is null then 'UNKNOWN' when {u} in ({vn}) then 'VIETNAM' "
            f"when {u} in ('USA', 'UNITED STATES', 'US') then 'USA' else {u} end)")


def ts_ms(x: str) -> str:
    return f"make_timestamp(cast({x} as bigint) * 1000)"


def oid(k: str, prefix: str = "0") -> str:
    return f"lpad(lower(hex(cast({k} as bigint))), 24, '{prefix}')"


# ------------------------------------------------------------------ fixtures
SRC_CUSTOMERS = """
select cast(c_custkey as bigint) as id,
  concat('  ', c_name, ' ') as full_name,
  case when c_custkey % 11 = 0 then null when c_custkey % 17 = 0 then 'no-at-sign'
       when c_custkey % 19 = 0 then concat(' Two@At@', c_name, '.COM')
       else concat('  ', upper(replace(c_name, '#', '.')), '@MAIL', cast(c_custkey % 4 as varchar), '.COM ') end as email,
  concat('+1 (', cast(100 + c_custkey % 900 as varchar), ') ', cast(1000 + c_custkey % 1000 as varchar), '-00') as phone,
  case c_nationkey % 10 when 0 then 'vietnam' when 1 then ' VIETNAM ' when 2 then 'Viet Nam' when 3 then 'usa'
    when 4 then '  USA' when 5 then 'United States' when 6 then 'japan' when 7 then ' singapore' when 8 then ''
    else null end as country,
  cast(1704067200000 + c_custkey * 60000 as bigint) as created_at,
  cast(1704067200000 + c_custkey * 60000 + 3600000 as bigint) as updated_at,
  c_nationkey
from customer
"""

SRC_ORDERS = """
select cast(o_orderkey as bigint) as id,
  case when o_orderkey % 53 = 0 then null when o_orderkey % 13 = 0 then o_custkey + 5000000000
       else cast(o_custkey as bigint) end as customer_id,
  concat(' Product ', cast(o_orderkey % 10 as varchar), ' ') as product_name,
  case when o_orderkey % 997 = 5 then 2000000000 else cast(o_orderkey % 7 - 1 as integer) end as quantity,
  case when o_orderkey % 997 = 5 then '99999999.99' else cast(cast(o_totalprice as decimal(12,2)) as varchar) end as unit_price,
  case when o_orderkey % 6 = 0 then ' cancelled' when o_orderstatus = 'O' then 'new'
       when o_orderstatus = 'F' then 'Delivered ' else null end as status,
  epoch_ms(o_orderdate) as order_date,
  epoch_ms(o_orderdate) + 86400000 as updated_at
from orders
"""

SRC_REVIEWS = f"""
select {oid('o_orderkey')} as _id, cast(o_orderkey as varchar) as review_id,
  cast(o_custkey + case when o_orderkey % 17 = 0 then 5000000000 else 0 end as bigint) as customer_id, cast((o_orderkey * 7) % 500 as integer) as product_id,
  cast(o_orderkey % 9 - 1 as integer) as rating,
  case o_orderkey % 5 when 0 then 'approved' when 1 then ' PENDING' when 2 then 'Rejected'
    when 3 then 'APPROVED' else null end as status,
  concat(' Title ', cast(o_orderkey % 13 as varchar), ' ') as title,
  epoch_ms(o_orderdate) as updated_at, o_orderkey as k
from orders
"""

SRC_CLICKS = f"""
select {oid('event_id')} as _id, cast(event_id as varchar) as event_id,
  cast(user_id + case when event_id % 19 = 0 then 5000000000 else 0 end as bigint) as customer_id,
  case when event_id % 41 = 0 then null else concat(' ', event_type) end as event_type,
  cast(event_id % 500 + 1 as integer) as product_id, concat('s', cast(user_id as varchar)) as session_id,
  ' Mozilla/5.0 ' as user_agent,
  case event_id % 4 when 0 then 'direct' when 1 then 'ads ' when 2 then 'email' else null end as referrer,
  case event_id % 3 when 0 then 'home' when 1 then ' search' else 'cart' end as page,
  (epoch_us(ts) // 1000) as event_time
from events
"""

SRC_PROFILES = f"""
select {oid('c_custkey')} as _id, cast(c_custkey as bigint) as customer_id,
  concat(' ', c_name, ' ') as full_name,
  case c_nationkey % 6 when 0 then 'VN' when 1 then ' vietnam ' when 2 then 'us' when 3 then 'japan'
    when 4 then 'France' else null end as country,
  case when c_custkey % 5 = 0 then ' books ' else 'toys' end as category,
  c_custkey % 2 = 0 as newsletter,
  case when c_custkey % 4 = 0 then ' high' else null end as price_sensitivity,
  case c_mktsegment when 'BUILDING' then 'gold' when 'MACHINERY' then ' Silver' when 'HOUSEHOLD' then null
    else 'bronze' end as tier,
  cast(floor(c_acctbal) as integer) as points,
  case when c_custkey % 3 = 0 then 'mobile,web' else 'tablet' end as devices
from customer
"""

_DOC_KEY = ("concat(lang, '/', source, '/doc_', cast(doc_id as varchar), case doc_id % 4 when 0 then '.PNG' "
            "when 1 then '.mp4' when 2 then '.wav' else '.txt' end)")

SRC_OBJECTS = f"""
select case doc_id % 4 when 0 then 'raw-images' when 1 then 'raw-videos' when 2 then 'raw-audio'
    else 'raw-documents' end as bucket,
  {_DOC_KEY} as object_key,
  case when doc_id % 37 = 0 then 0 else n_chars end as size_bytes,
  md5(text) as etag,
  case when doc_id % 5 = 0 then null else 'text/plain' end as content_type,
  1704067200000 + doc_id * 1000 as last_modified_ms
from documents
"""

TARGET_INVENTORY = f"""
select case doc_id % 4 when 0 then 'clean-images' when 1 then 'clean-videos' when 2 then 'clean-audio'
    else 'clean-documents' end as bucket,
  {_DOC_KEY} as object_key,
  case when doc_id % 29 = 0 then n_chars + 1 else n_chars end as size_bytes
from documents where doc_id % 23 <> 0
union all
select 'clean-documents', concat('orphan/', cast(doc_id as varchar)), n_chars from documents where doc_id % 31 = 0
"""

# --------------------------------------------------------------- clean layers
CLEAN_CUSTOMERS = f"""
select id, {clean('full_name')} as full_name, lower({clean('email')}) as email,
  case when strpos(lower({clean('email')}), '@') > 0
       then substr(lower({clean('email')}), strpos(lower({clean('email')}), '@') + 1) end as email_domain,
  nullif(regexp_replace(coalesce(phone, ''), '[^0-9+]', '', 'g'), '') as phone,
  {country('country')} as country,
  {ts_ms('created_at')} as created_at, {ts_ms('updated_at')} as updated_at
from src_customers
"""

CLEAN_ORDERS = f"""
select id, customer_id, {clean('product_name')} as product_name,
  greatest(quantity, 0) as quantity,
  cast(round(cast(unit_price as decimal(28,10)), 2) as decimal(12,2)) as unit_price,
  try_cast(cast(unit_price as decimal(28,10)) * greatest(quantity, 0) as decimal(14,2)) as total_amount,
  {upper_default('status', 'NEW')} as status,
  {ts_ms('order_date')} as order_date, {ts_ms('updated_at')} as updated_at
from src_orders
"""

CLEAN_REVIEWS = f"""
select _id, review_id, greatest(customer_id, 0) as customer_id, greatest(product_id, 0) as product_id,
  least(greatest(rating, 0), 5) as rating, {upper_default('status', 'PENDING')} as status,
  {clean('title')} as title, {ts_ms('updated_at')} as updated_at
from src_reviews
"""

CLEAN_CLICKS = f"""
select _id, event_id, greatest(customer_id, 0) as customer_id, greatest(product_id, 0) as product_id,
  {upper_default('event_type', 'UNKNOWN')} as event_type, {clean('session_id')} as session_id,
  {clean('user_agent')} as user_agent, {upper_default('referrer', 'UNKNOWN')} as referrer,
  {upper_default('page', 'UNKNOWN')} as page, {ts_ms('event_time')} as event_time
from src_clicks
"""

CLEAN_PROFILES = f"""
select _id, customer_id, {clean('full_name')} as full_name, {country('country', True)} as country,
  {clean('category')} as category, coalesce(newsletter, false) as newsletter,
  {upper_default('price_sensitivity', 'UNKNOWN')} as price_sensitivity,
  {upper_default('tier', 'BRONZE')} as tier, greatest(coalesce(points, 0), 0) as points, devices
from src_profiles
"""

U_ORDERS_SRC = """
select id, customer_id, product_name, quantity + 1 as quantity, unit_price, 'shipped ' as status, order_date,
  updated_at + 3600000 as updated_at
from src_orders where id % 3 = 0
"""

FIN_ORDERS_SRC = """
select * from u_orders_src where id % 9 <> 0
union all select * from src_orders where id % 3 <> 0
"""

FIN_CUSTOMERS_SRC = """
select id, full_name, email, phone,
  case when id % 5 = 0 then (case when id % 2 = 0 then 'Singapore ' else ' usa' end) else country end as country,
  created_at, updated_at, c_nationkey
from src_customers
"""

U_REVIEWS = f"""
select _id, review_id, customer_id, product_id, least(greatest(rating + 1, 0), 5) as rating, 'APPROVED' as status,
  {clean('title')} as title, {ts_ms('updated_at')} as updated_at, k
from src_reviews where k % 4 = 0
"""

FIN_REVIEWS = f"""
select _id, review_id, customer_id, product_id, rating, status, title, updated_at
from u_reviews where k % 10 <> 0
union all
select _id, review_id, greatest(customer_id, 0), greatest(product_id, 0), least(greatest(rating, 0), 5),
  {upper_default('status', 'PENDING')}, {clean('title')}, {ts_ms('updated_at')}
from src_reviews where k % 4 <> 0 and k % 10 <> 0
union all
select {oid('k', 'f')}, review_id, greatest(customer_id, 0), greatest(product_id, 0), least(greatest(rating, 0), 5),
  {upper_default('status', 'PENDING')}, {clean('title')}, {ts_ms('updated_at')}
from src_reviews where k % 101 = 3 and k % 10 = 0
"""

FIN_PROFILES_SRC = """
select * replace (case when customer_id % 4 = 0 then 'Japan ' else country end as country,
                  case when customer_id % 4 = 0 then 'gold' else tier end as tier)
from src_profiles where customer_id % 10 <> 0
"""

FIN_CLICKS_SRC = """
select * replace (case when cast(event_id as bigint) % 4 = 0 then ' purchase' else event_type end as event_type)
from src_clicks where cast(event_id as bigint) % 10 <> 0
"""

BASE_CTES = {
    "src_customers": SRC_CUSTOMERS, "src_orders": SRC_ORDERS, "src_reviews": SRC_REVIEWS,
    "src_clicks": SRC_CLICKS, "src_profiles": SRC_PROFILES, "src_objects": SRC_OBJECTS,
    "target_inventory": TARGET_INVENTORY,
    "c_customers": CLEAN_CUSTOMERS, "c_orders_all": CLEAN_ORDERS,
    "c_orders": "select * from c_orders_all where total_amount is not null",
    "c_reviews": CLEAN_REVIEWS, "c_clicks": CLEAN_CLICKS, "c_profiles": CLEAN_PROFILES,
    "u_orders_src": U_ORDERS_SRC, "u_orders_all": CLEAN_ORDERS.replace("from src_orders", "from u_orders_src"),
    "fin_orders_src": FIN_ORDERS_SRC,
    "f_orders_all": CLEAN_ORDERS.replace("from src_orders", "from fin_orders_src"),
    "f_orders": "select * from f_orders_all where total_amount is not null",
    "fin_customers_src": FIN_CUSTOMERS_SRC,
    "f_customers": CLEAN_CUSTOMERS.replace("from src_customers", "from fin_customers_src"),
    "u_reviews": U_REVIEWS, "f_reviews": FIN_REVIEWS,
    "fin_profiles_src": FIN_PROFILES_SRC, "f_profiles": CLEAN_PROFILES.replace("from src_profiles", "from fin_profiles_src"),
    "fin_clicks_src": FIN_CLICKS_SRC, "f_clicks": CLEAN_CLICKS.replace("from src_clicks", "from fin_clicks_src"),
}


def with_ctes(body: str, extra: dict | None = None) -> str:
    ctes = dict(BASE_CTES)
    ctes.update(extra or {})
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in ctes.items()) + "\n" + body
