"""Domain inputs projected from the given tables, in SQL that Spark and DuckDB both accept.

The tables hold no tenants, devices or files, so these views derive them: a region is a tenant,
suppliers, parts and customers are its building, asset and staff lists, ``events`` are what
devices upload (with retries, delays and fast clocks driven by the row's own values), line items
are store sales. Members with a negative balance are the ones missing from their list.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events".split()

TENANTS = """
select r_name as tenant_id, 'Camp ' || r_name as camp_name,
       case when r_regionkey < 2 then 'US' else 'CA' end as country, r_name as region,
       case r_regionkey when 0 then 'America/New_York' when 1 then 'America/Detroit'
            when 2 then 'America/Toronto' when 3 then 'Europe/Paris' else 'Asia/Tokyo' end as timezone,
       date '2024-01-01' as onboarded_on
from {region}
"""

RAW_BUILDINGS = """
select r.r_name as tenant_id, 'SUP-' || cast(s.s_suppkey as string) as building_code,
       s.s_name as building_name,
       case when s.s_acctbal > 5000 then 'store' else 'cabin' end as building_type,
       cast(s.s_suppkey as int) as capacity, cast(null as int) as year_built,
       1 as _contract_version, timestamp '2024-01-01 00:00:00' as _loaded_at,
       cast(s.s_suppkey as bigint) as _source_row
from {supplier} s join {nation} n on s.s_nationkey = n.n_nationkey
join {region} r on n.n_regionkey = r.r_regionkey
where s.s_acctbal >= 0
"""

RAW_ASSETS = """
select r.r_name as tenant_id, 'PRT-' || cast(p.p_partkey as string) as asset_tag,
       p.p_name as asset_name, 'other' as category,
       'SUP-' || cast(p.p_size as string) as building_code,
       date '2020-01-01' as purchased_on, cast(p.p_retailprice as decimal(12,2)) as purchase_cost,
       'in_service' as status, 2 as _contract_version,
       timestamp '2024-01-01 00:00:00' as _loaded_at, cast(p.p_partkey as bigint) as _source_row
from {part} p join {region} r on p.p_size % 5 = r.r_regionkey
"""

RAW_STAFF = """
select r.r_name as tenant_id, 'STF-' || cast(c.c_custkey as string) as staff_code,
       c.c_name as first_name, c.c_mktsegment as last_name, 'counselor' as role,
       cast(null as string) as email, date '2024-01-01' as start_date, c.c_acctbal > 1000 as is_active,
       1 as _contract_version, timestamp '2024-01-01 00:00:00' as _loaded_at,
       cast(c.c_custkey as bigint) as _source_row
from {customer} c join {nation} n on c.c_nationkey = n.n_nationkey
join {region} r on n.n_regionkey = r.r_regionkey
where c.c_acctbal >= 0
"""

RAW_SALES = """
select r.r_name as tenant_id, cast(l.l_orderkey as string) as transaction_id,
       l.l_linenumber as line_number, o.o_orderdate as sold_at,
       'SUP-' || cast(l.l_suppkey as string) as store_building_code,
       case when l.l_tax > 0 then 'STF-' || cast(o.o_custkey as string) end as cashier_staff_code,
       'PRT-' || cast(l.l_partkey as string) as sku, 'Item ' || cast(l.l_partkey as string) as item_name,
       case l.l_returnflag when 'R' then 'snack' when 'A' then 'drink' else 'apparel' end as item_category,
       cast(l.l_quantity as int) as quantity, cast(l.l_extendedprice as decimal(12,2)) as unit_price,
       case o.o_orderpriority when '1-URGENT' then 'camper_account' when '2-HIGH' then 'cash'
            else 'card' end as payment_method,
       1 as _contract_version, l.l_shipdate as _loaded_at, l.l_partkey as _source_row
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
join {customer} c on o.o_custkey = c.c_custkey
join {nation} n on c.c_nationkey = n.n_nationkey
join {region} r on n.n_regionkey = r.r_regionkey
"""

RAW_APP_EVENTS = """
with base as (
  select e.event_id, e.ts, e.user_id, e.event_type, e.value,
         cast(translate(e.props, '{{}}"k: ', '') as int) as k, r.r_name as tenant_id,
         'WO-' || cast(e.user_id as string) || '-' || cast(extract(week from e.ts) as string) as wo
  from {events} e join {customer} c on e.user_id = c.c_custkey
  join {nation} n on c.c_nationkey = n.n_nationkey
  join {region} r on n.n_regionkey = r.r_regionkey
), sent as (
  select *, ts + interval '1' minute * (case when value > 140 then 60 + k * 43 else k end) as sent_at
  from base
), copies as (
  select *, 1 as copy_no, sent_at as received_at from sent
  union all
  select *, 2 as copy_no, sent_at + interval '1' minute * (1 + k * 40) as received_at
  from sent where value > 110
  union all
  select *, 3 as copy_no, sent_at as received_at from sent where value > 200
)
select 'E' || cast(event_id as string) as event_id, tenant_id,
       'DEV-' || cast(user_id as string) as device_id, cast(event_id as int) as device_seq,
       case event_type when 'signup' then 'work_order.opened' when 'view' then 'work_order.assigned'
            when 'click' then 'work_order.started' when 'purchase' then 'work_order.completed'
            else 'waterfront.check_logged' end as event_type,
       case when value < 1.2 then sent_at + interval '3' hour else ts end as occurred_at,
       received_at,
       'U' || cast(event_id as string) || '-' || cast(copy_no as string) as upload_id,
       case event_type
         when 'signup' then '{{"work_order_id":"' || wo || '","building_code":"SUP-' || cast(k as string)
           || '","asset_tag":' || (case when k < 10 then 'null' else '"PRT-'
             || cast(cast(floor(value) as int) as string) || '"' end)
           || ',"category":"' || (case when k < 50 then 'plumbing' else 'hvac' end)
           || '","priority":"' || (case when k < 10 then 'urgent' when k < 40 then 'high' else 'normal' end)
           || '","reported_by":"STF-' || cast(user_id as string) || '"}}'
         when 'purchase' then '{{"work_order_id":"' || wo || '","staff_code":"STF-' || cast(user_id as string)
           || '","labor_minutes":' || cast(k as string)
           || ',"parts_cost":' || cast(cast(value as decimal(12,2)) as string) || '}}'
         when 'error' then '{{"check_id":"CHK-' || cast(event_id as string) || '","building_code":"SUP-'
           || cast(k as string) || '","staff_code":"STF-' || cast(user_id as string) || '","chlorine_ppm":'
           || (case when k < 50 then cast(cast(k * 0.12 as decimal(8,2)) as string) else 'null' end)
           || ',"ph":' || cast(cast(6 + k * 0.03 as decimal(8,2)) as string) || ',"water_temp_f":71.5}}'
         else '{{"work_order_id":"' || wo || '","staff_code":"STF-' || cast(user_id as string) || '"}}'
       end as payload
from copies
"""

AMOUNT_TEXTS = """
select l_orderkey, l_linenumber, l_partkey, l_shipdate,
       case l_returnflag
         when 'R' then ' $' || cast(cast(l_extendedprice as decimal(12,2)) as string)
         when 'A' then '($' || cast(cast(l_extendedprice as decimal(12,2)) as string) || ')'
         else case when l_discount = 0.1 then 'free' when l_discount = 0 then '  '
              else 'cad 1,' || cast(cast(100 + l_quantity as int) as string) || '.5' end
       end as amount
from {lineitem}
"""

DATE_TEXTS = """
select o_orderkey,
       case o_orderstatus
         when 'F' then cast(extract(month from o_orderdate) as string) || '/'
           || cast(extract(day from o_orderdate) as string) || '/'
           || cast(extract(year from o_orderdate) as string)
         when 'O' then cast(cast(o_orderdate as date) as string)
         else case when o_totalprice > 250000 then 'week of ' else '13/' end
           || cast(cast(o_orderdate as date) as string) end as day_text
from {orders}
"""

TIME_TEXTS = """
select event_id,
       case event_type
         when 'click' then cast(extract(month from ts) as string) || '/' || cast(extract(day from ts) as string)
           || '/' || cast(extract(year from ts) as string) || ' ' || cast(extract(hour from ts) as string)
           || ':' || cast(extract(minute from ts) as string)
         when 'view' then cast(ts as string)
         when 'error' then cast(cast(ts as date) as string) || 'T12:30:00-07:00'
         else 'around ' || cast(ts as string) end as time_text
from {events}
"""

SALES_TEXTS = """
select s.tenant_id || '-' || cast(extract(year from s._loaded_at) as string) as batch_id, s.tenant_id,
       s._source_row as source_row, s.transaction_id, cast(s.line_number as string) as line_number,
       cast(cast(s.sold_at as date) as string) as sold_at, s.store_building_code, s.cashier_staff_code,
       s.sku, case when s.quantity = 10 then ' ' else s.item_name end as item_name, s.item_category,
       case s.quantity when 50 then 'fifty' when 49 then '51' else cast(s.quantity as string) end as quantity,
       '$' || cast(cast(s.quantity * 4.1 as decimal(12,2)) as string) as unit_price,
       case when s.item_category = 'apparel' and s.quantity < 3 then 'cheque' else s.payment_method end
         as payment_method,
       extract(year from s._loaded_at) = 1999 as lacks_payment,
       cast(cast(extract(year from s._loaded_at) as string) || '-12-31 00:00:00' as timestamp) as sent_on
from {raw_sales} s
"""

HELD_BUILDINGS = """
select r.r_name as tenant_id, 'SUP-' || cast(s.s_suppkey as string) as code
from {supplier} s join {nation} n on s.s_nationkey = n.n_nationkey
join {region} r on n.n_regionkey = r.r_regionkey where s.s_acctbal < 0
"""

HELD_STAFF = """
select r.r_name as tenant_id, 'STF-' || cast(c.c_custkey as string) as code
from {customer} c join {nation} n on c.c_nationkey = n.n_nationkey
join {region} r on n.n_regionkey = r.r_regionkey where c.c_acctbal < 0
"""

# Exports that land in two steps; files are cut by ranges of keys. Buildings without a name or of a kind
# nobody knows are held, every second one of them is corrected by the second step; some rows come twice.
SENT_BUILDINGS = """
with own as (
  select r.r_name as tenant_id, s.s_suppkey as k, s.s_name, s.s_acctbal, s.s_acctbal < 0 as nameless,
         s.s_suppkey % 11 = 3 as odd
  from {supplier} s join {nation} n on s.s_nationkey = n.n_nationkey
  join {region} r on n.n_regionkey = r.r_regionkey
), sent as (
  select *, 1 as step, 0 as again from own
  union all
  select *, 1 as step, 1 as again from own where k % 13 = 5
  union all
  select *, 2 as step, 0 as again from own where (nameless or odd) and k % 2 = 0
)
select tenant_id, step, again, k, 'buildings-' || cast(step as string) || '-'
         || cast(cast(floor(k / 100000.0) as int) as string) || '.csv' as file,
       'SUP-' || cast(k as string) as code, case when nameless and step = 1 then '' else s_name end as name,
       case when odd and step = 1 then 'Yurt' when s_acctbal > 5000 then 'camp  STORE' else ' Cabin' end as kind,
       cast(k % 500 as int) as beds
from sent
"""

# Parts in the building numbered like their size; those whose building was held are sent again.
SENT_ASSETS = """
with own as (
  select p.p_partkey as k, p.p_name, p.p_retailprice, p.p_size, coalesce(r.r_name, 'AFRICA') as tenant_id,
         coalesce(s.s_acctbal < 0 or s.s_suppkey % 11 = 3, false) as home_held,
         s.s_suppkey is null as home_unknown
  from {part} p left join {supplier} s on p.p_size = s.s_suppkey
  left join {nation} n on s.s_nationkey = n.n_nationkey
  left join {region} r on n.n_regionkey = r.r_regionkey
), sent as (
  select *, 1 as step from own
  union all
  select *, 2 as step from own where home_held
)
select tenant_id, step, 0 as again, k, 'assets-' || cast(step as string) || '-'
         || cast(cast(floor(k / 100000.0) as int) as string) || '.csv' as file,
       'PRT-' || cast(k as string) as tag, p_name as name, 'SUP-' || cast(p_size as string) as home,
       case when k % 19 = 2 then 'soon'
            else cast(k % 12 + 1 as string) || '/' || cast(k % 28 + 1 as string) || '/2021' end as bought,
       '$' || cast(cast(p_retailprice as decimal(12,2)) as string) as price, home_held, home_unknown,
       p_size % 2 = 0 and home_held as home_mended
from sent
"""

VIEWS = {
    "amount_texts": AMOUNT_TEXTS,
    "date_texts": DATE_TEXTS,
    "time_texts": TIME_TEXTS,
    "sales_texts": SALES_TEXTS,
    "sent_buildings": SENT_BUILDINGS,
    "sent_assets": SENT_ASSETS,
    "held_buildings": HELD_BUILDINGS,
    "held_staff": HELD_STAFF,
    "tenants": TENANTS,
    "raw_buildings": RAW_BUILDINGS,
    "raw_assets": RAW_ASSETS,
    "raw_staff": RAW_STAFF,
    "raw_sales": RAW_SALES,
    "raw_app_events": RAW_APP_EVENTS,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spark_sql(spark: SparkSession, sf_dir: str, sql: str, **views: DataFrame) -> DataFrame:
    """Run a shared SQL text; ``{name}`` is one of the given tables or a DataFrame passed in."""
    names = set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql))
    frames = {n: views[n] if n in views else table(spark, sf_dir, n) for n in names}
    out = spark.sql(sql, **frames)
    # Timestamp literals are zoned in Spark; the warehouse is naive UTC throughout.
    casts = {c: out[c].cast("timestamp_ntz") for c, t in out.dtypes if t == "timestamp"}
    return out.withColumns(casts) if casts else out


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    inner = {v: view(spark, sf_dir, v) for v in VIEWS if "{" + v + "}" in sql}
    return spark_sql(spark, sf_dir, sql, **inner)


def duck(sql: str, **names: str) -> str:
    """The same text for DuckDB, where every table is already a view."""
    found = set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql))
    return sql.format(**{n: names.get(n, n) for n in found})
