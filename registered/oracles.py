"""DuckDB side: one SQL text per registered query, over the same projected views."""

from __future__ import annotations

from .views import VIEWS, duck

_NULL_PART = "_dbt_utils_surrogate_key_null_"


def sk(*parts: str) -> str:
    text = " || '-' || ".join(f"coalesce(cast({p} as varchar), '{_NULL_PART}')" for p in parts)
    return f"md5({text})"


def opt_sk(tenant: str, code: str) -> str:
    return f"if({code} is null, null, {sk(tenant, code)})"


def local_day(ts: str) -> str:
    return f"cast(timezone(timezone, timezone('UTC', {ts})) as date)"


_TEXTS = (
    "work_order_id check_id building_code asset_tag staff_code category priority"
).split()
_NUMBERS = "parts_cost chlorine_ppm ph water_temp_f".split()

CTES = {name: duck(sql) for name, sql in VIEWS.items()}
CTES["stg"] = (
    """select event_id, tenant_id, device_id, device_seq, event_type,
  string_split(event_type, '.')[1] as event_entity, string_split(event_type, '.')[2] as event_action,
  occurred_at as device_occurred_at, received_at,
  case when occurred_at > received_at then received_at else occurred_at end as event_at,
  occurred_at > received_at as is_clock_corrected, upload_id, """
    + ", ".join(f"payload::json ->> '{n}' as {n}" for n in _TEXTS)
    + ", payload::json ->> 'reported_by' as reported_by_staff_code, "
    + "cast(payload::json ->> 'labor_minutes' as int) as labor_minutes, "
    + ", ".join(f"cast(payload::json ->> '{n}' as decimal(28,6)) as {n}" for n in _NUMBERS)
    + " from raw_app_events"
)
CTES["ev"] = """select * exclude (rn), date_diff('minute', event_at, received_at) as arrival_lag_minutes
  from (select *, row_number() over (partition by event_id order by received_at, upload_id) as rn
        from stg) where rn = 1"""
CTES["fct"] = f"""select event_id, tenant_id, {sk('tenant_id', 'work_order_id')} as work_order_key,
  work_order_id, event_action, event_at, {local_day('event_at')} as event_date_local,
  {opt_sk('tenant_id', 'building_code')} as building_key, {opt_sk('tenant_id', 'asset_tag')} as asset_key,
  {opt_sk('tenant_id', 'coalesce(staff_code, reported_by_staff_code)')} as staff_key,
  category, priority, labor_minutes, parts_cost, device_id, device_seq, received_at,
  arrival_lag_minutes, arrival_lag_minutes > 60 as is_late_arrival, is_clock_corrected
  from ev join tenants using (tenant_id) where event_entity = 'work_order'"""
CTES["wo"] = """select *, date_diff('minute', opened_at, assigned_at) as minutes_to_assign,
  date_diff('minute', opened_at, completed_at) as minutes_to_complete,
  opened_at is null as is_missing_open_event
  from (select work_order_key, any_value(tenant_id) as tenant_id, any_value(work_order_id) as work_order_id,
    max(building_key) filter (event_action = 'opened') as building_key,
    max(asset_key) filter (event_action = 'opened') as asset_key,
    max(category) filter (event_action = 'opened') as category,
    max(priority) filter (event_action = 'opened') as priority,
    max(staff_key) filter (event_action = 'opened') as reported_by_staff_key,
    max(staff_key) filter (event_action = 'assigned') as assigned_staff_key,
    case (list(event_action order by event_at desc, device_seq desc, event_id desc))[1]
      when 'completed' then 'completed' when 'started' then 'in_progress'
      when 'assigned' then 'assigned' else 'open' end as status,
    min(event_at) filter (event_action = 'opened') as opened_at,
    min(event_at) filter (event_action = 'assigned') as assigned_at,
    min(event_at) filter (event_action = 'started') as started_at,
    max(event_at) filter (event_action = 'completed') as completed_at,
    cast(sum(labor_minutes) as bigint) as labor_minutes, sum(parts_cost) as parts_cost,
    count(*) as event_count, count(*) filter (is_late_arrival) as late_event_count,
    max(event_at) as last_event_at
    from fct group by work_order_key)"""
CTES["daily"] = """select tenant_id, event_date_local as activity_date, building_key,
  count(*) filter (event_action = 'opened') as work_orders_opened,
  count(*) filter (event_action = 'completed') as work_orders_completed,
  count(*) filter (event_action = 'opened' and priority = 'urgent') as urgent_opened,
  cast(coalesce(sum(labor_minutes), 0) as bigint) as labor_minutes,
  coalesce(sum(parts_cost), 0) as parts_cost, count(*) filter (is_late_arrival) as late_events
  from fct group by all"""
CTES["dim_b"] = f"""select {sk('tenant_id', 'building_code')} as building_key, * from (
  select tenant_id, building_code, building_name, building_type, capacity, year_built, false as is_inferred
  from raw_buildings
  union all
  select distinct tenant_id, building_code, 'Unknown building ' || building_code, 'unknown',
    cast(null as int), cast(null as int), true
  from ev where building_code is not null
    and (tenant_id, building_code) not in (select (tenant_id, building_code) from raw_buildings))"""
CTES["latest_sales"] = """select * from raw_sales qualify row_number() over (
  partition by tenant_id, transaction_id, line_number order by _loaded_at desc, _source_row desc) = 1"""
CTES["sales"] = f"""select {sk('tenant_id', 'transaction_id', 'line_number')} as sale_line_key, tenant_id,
  transaction_id, line_number, sold_at, {local_day('sold_at')} as sold_date_local,
  {sk('tenant_id', 'store_building_code')} as building_key,
  {opt_sk('tenant_id', 'cashier_staff_code')} as staff_key, sku, item_name, item_category, quantity,
  unit_price, quantity * unit_price as line_amount, payment_method
  from latest_sales join tenants using (tenant_id)"""

CTES["checked"] = """select *, transaction_id || '|' || line_number as record_key,
  concat_ws(',', case when trim(item_name) = '' then 'required:item_name' end,
    case quantity when 'fifty' then 'invalid_type:quantity' when '51' then 'out_of_range:quantity' end,
    case when cast(substr(unit_price, 2) as decimal(12,2)) > 200 then 'out_of_range:unit_price' end,
    case when payment_method = 'cheque' then 'not_allowed:payment_method' end) as own
  from sales_texts"""
CTES["first_rows"] = """select batch_id, record_key, min(source_row) as first_row from checked
  where own = '' and not lacks_payment group by 1, 2"""
CTES["ruled"] = """select c.*, f.first_row,
  case when lacks_payment then '' else concat_ws(',', nullif(own, ''),
    case when own = '' and source_row > first_row then 'duplicate_key:transaction_id' end,
    case when (tenant_id, store_building_code) in (select (tenant_id, building_code) from raw_buildings)
           then null
         when (tenant_id, store_building_code) in (select (tenant_id, code) from held_buildings)
           then 'held_reference:store_building_code' else 'unknown_reference:store_building_code' end,
    case when cashier_staff_code is null
              or (tenant_id, cashier_staff_code) in (select (tenant_id, staff_code) from raw_staff) then null
         when (tenant_id, cashier_staff_code) in (select (tenant_id, code) from held_staff)
           then 'held_reference:cashier_staff_code' else 'unknown_reference:cashier_staff_code' end)
  end as rules
  from checked c left join first_rows f using (batch_id, record_key)"""
CTES["broken"] = """select batch_id, tenant_id, source_row, split_part(r, ':', 1) as rule,
  split_part(r, ':', 2) as field, store_building_code, cashier_staff_code
  from (select *, unnest(string_split(rules, ',')) as r from ruled where rules <> '')"""
CTES["batch_totals"] = """select batch_id, tenant_id, 'commissary_transactions' as feed,
  count(*) as rows_received, count(*) filter (rules = '' and not lacks_payment) as rows_loaded,
  count(*) filter (rules <> '' or lacks_payment) as rows_quarantined, max(sent_on) as finished_at,
  case when bool_or(lacks_payment) then 'rejected'
       when bool_or(rules <> '') then 'loaded_with_errors' else 'loaded' end as batch_status
  from ruled group by 1, 2"""
CTES["loads"] = """select distinct tenant_id, record_key, batch_id, sent_on from ruled
  where rules = '' and not lacks_payment"""
CTES["held"] = """select h.*, (select min(l.sent_on) from loads l where l.tenant_id = h.tenant_id
    and l.record_key = h.record_key and l.sent_on > h.sent_on) as resolved_at
  from ruled h where rules <> '' or lacks_payment"""
# Onboarding. Row numbers count the header; a building's clean repetition in a file is a duplicate.
CTES["landed_buildings"] = """select *, concat_ws(',',
    if(name = '', 'required', null), if(kind = 'Yurt', 'not_allowed', null),
     if(name <> '' and kind <> 'Yurt' and again = 1, 'duplicate_key', null)) as rules
  from (select *, 1 + row_number() over (partition by tenant_id, file order by again, k) as source_row from sent_buildings)"""
CTES["landed_assets"] = """select *, concat_ws(',',
    if(bought = 'soon', 'invalid_type', null), if(home_unknown, 'unknown_reference', null),
     if(home_held and not (step = 2 and home_mended), 'held_reference', null)) as rules
  from (select *, 1 + row_number() over (partition by tenant_id, file order by k) as source_row from sent_assets)"""
CTES["landed"] = """select tenant_id, 'buildings' as feed, file as source_file, step, source_row, code as record_key,
    rules, name as building_name from landed_buildings
  union all
  select tenant_id, 'assets', file, step, source_row, tag, rules, '' from landed_assets"""
CTES["closed"] = """select h.*, l.source_file as resolved_by
  from (select * from landed where rules <> '') h
  left join (select tenant_id, feed, record_key, source_file from landed where rules = '' and step = 2) l
    on h.step = 1 and l.tenant_id = h.tenant_id and l.feed = h.feed and l.record_key = h.record_key"""

_USES = {
    "landed_buildings": ["sent_buildings"],
    "landed_assets": ["sent_assets"],
    "landed": ["landed_buildings", "landed_assets"],
    "closed": ["landed"],
    "sales_texts": ["raw_sales"],
    "checked": ["sales_texts"],
    "first_rows": ["checked"],
    "ruled": ["first_rows", "raw_buildings", "raw_staff", "held_buildings", "held_staff"],
    "broken": ["ruled"],
    "batch_totals": ["ruled"],
    "loads": ["ruled"],
    "held": ["loads"],
    "stg": ["raw_app_events"],
    "ev": ["stg"],
    "fct": ["ev", "tenants"],
    "wo": ["fct"],
    "daily": ["fct"],
    "dim_b": ["ev", "raw_buildings"],
    "latest_sales": ["raw_sales"],
    "sales": ["latest_sales", "tenants"],
}


def with_ctes(sql: str, *needs: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for dep in _USES.get(name, []):
            add(dep)
        if name not in ordered:
            ordered.append(name)

    for need in needs:
        add(need)
    heads = ",\n".join(f"{n} as materialized ({CTES[n]})" for n in ordered)
    return f"with {heads}\n{sql}" if heads else sql


def plain(sql: str, ts: str = "", day: str = "", money: str = "") -> str:
    """Dates and timestamps as text, decimals as doubles, like the Spark side."""
    swaps = [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') as {c}" for c in ts.split()]
    swaps += [f"strftime({c}, '%Y-%m-%d') as {c}" for c in day.split()]
    swaps += [f"cast({c} as double) as {c}" for c in money.split()]
    return f"select * replace ({', '.join(swaps)}) from ({sql})" if swaps else sql


ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str, *needs: str, ts: str = "", day: str = "", money: str = "") -> None:
    ORACLES[name] = with_ctes(plain(sql, ts, day, money), *needs)


_EV_TS = "device_occurred_at received_at event_at"
_EV_MONEY = "parts_cost chlorine_ppm ph water_temp_f"
_WO = dict(ts="opened_at assigned_at started_at completed_at last_event_at", money="parts_cost")

oracle("stg_app_events", "select * from stg", "stg", ts=_EV_TS, money=_EV_MONEY)
oracle(
    "payload_rejects",
    """select event_id, upload_id, 'ph' as unreadable_fields from stg
       where event_type = 'waterfront.check_logged' and ph < 7""",
    "stg",
)
oracle("dedupe_events", "select * from ev", "ev", ts=_EV_TS, money=_EV_MONEY)
oracle(
    "latest_per_key_sales", "select * from latest_sales", "latest_sales",
    ts="sold_at _loaded_at", money="unit_price",
)
oracle("dim_tenant", "select * from tenants", "tenants", day="onboarded_on")
oracle("dim_building", "select * from dim_b", "dim_b")
oracle(
    "dim_asset",
    f"""select {sk('tenant_id', 'asset_tag')} as asset_key,
       {sk('tenant_id', 'building_code')} as building_key, * from (
       select tenant_id, asset_tag, asset_name, category as asset_category, status as asset_status,
         building_code, purchased_on, purchase_cost, false as is_inferred from raw_assets
       union all
       select tenant_id, asset_tag, 'Unknown asset ' || asset_tag, 'unknown', 'unknown',
         max(building_code), null, null, true
       from ev where asset_tag is not null
         and (tenant_id, asset_tag) not in (select (tenant_id, asset_tag) from raw_assets)
       group by tenant_id, asset_tag)""",
    "ev", "raw_assets", day="purchased_on", money="purchase_cost",
)
oracle(
    "dim_staff",
    f"""select {sk('tenant_id', 'staff_code')} as staff_key, * from (
       select tenant_id, staff_code, first_name, last_name, role as staff_role, email, start_date,
         is_active, false as is_inferred from raw_staff
       union all
       select tenant_id, staff_code, null, null, 'unknown', null, null, null, true
       from (select tenant_id, staff_code from ev where staff_code is not null
             union select tenant_id, reported_by_staff_code from ev where reported_by_staff_code is not null)
       where (tenant_id, staff_code) not in (select (tenant_id, staff_code) from raw_staff))""",
    "ev", "raw_staff", day="start_date",
)
oracle(
    "maintenance_by_calendar",
    """select cast(extract(year from day) as int) as year,
       cast(extract(month from day) as int) as month,
       cast(extract(dow from day) as int) as day_of_week,
       extract(dow from day) in (0, 6) as is_weekend, count(*) as events,
       cast(sum(labor_minutes) as bigint) as labor_minutes
       from (select labor_minutes,
               case when event_date_local >= date '2024-01-01' then event_date_local end as day from fct)
       group by 1, 2, 3, 4""",
    "fct",
)
oracle(
    "fct_maintenance_events", "select * from fct", "fct",
    ts="event_at received_at", day="event_date_local", money="parts_cost",
)
oracle("fct_work_orders", "select * from wo", "wo", **_WO)
oracle(
    "fct_waterfront_checks",
    f"""select event_id, tenant_id, check_id, {sk('tenant_id', 'building_code')} as building_key,
       {sk('tenant_id', 'staff_code')} as staff_key, event_at as checked_at,
       {local_day('event_at')} as checked_date_local, chlorine_ppm, ph, water_temp_f,
       chlorine_ppm is not null as is_pool,
       if(chlorine_ppm is null, ph not between 6.5 and 9.0,
          chlorine_ppm not between 1.0 and 4.0 or ph not between 7.2 and 7.8) as is_out_of_range,
       device_id, arrival_lag_minutes
       from ev join tenants using (tenant_id) where event_type = 'waterfront.check_logged'""",
    "ev", "tenants", ts="checked_at", day="checked_date_local", money="chlorine_ppm ph water_temp_f",
)
oracle(
    "fct_commissary_sales", "select * from sales", "sales",
    ts="sold_at", day="sold_date_local", money="unit_price line_amount",
)
oracle("rpt_maintenance_daily", "select * from daily", "daily", day="activity_date", money="parts_cost")
oracle(
    "rpt_commissary_daily",
    """select tenant_id, sold_date_local, item_category, count(distinct transaction_id) as transactions,
       cast(sum(quantity) as bigint) as units, sum(line_amount) as revenue,
       coalesce(sum(line_amount) filter (payment_method = 'camper_account'), 0) as camper_account_revenue
       from sales group by all""",
    "sales", day="sold_date_local", money="revenue camper_account_revenue",
)
oracle(
    "rpt_work_order_backlog",
    """select w.tenant_id, w.work_order_id, w.status, w.priority, w.category, b.building_name,
       b.building_type, w.opened_at,
       date_diff('hour', w.opened_at, w.last_event_at) as hours_open_at_last_activity,
       w.is_missing_open_event
       from wo w left join dim_b b using (building_key) where w.status <> 'completed'""",
    "wo", "dim_b", ts="opened_at",
)
oracle(
    "mon_event_delivery",
    """select tenant_id, device_id, cast(received_at as date) as received_date,
       count(*) as copies_uploaded, count(*) filter (rn = 1) as new_events,
       count(*) filter (rn > 1) as duplicate_copies,
       count(*) filter (rn = 1 and lag > 60) as late_events,
       max(lag) filter (rn = 1) as max_arrival_lag_minutes,
       count(*) filter (rn = 1 and is_clock_corrected) as clock_corrections
       from (select *, row_number() over (partition by event_id order by received_at, upload_id) as rn,
               date_diff('minute', event_at, received_at) as lag from stg)
       group by 1, 2, 3""",
    "stg", day="received_date",
)
oracle(
    "source_freshness",
    """select max(received_at) as max_received_at,
       max(received_at) < timestamp '2024-01-30 00:00:00' as is_stale from raw_app_events""",
    "raw_app_events", ts="max_received_at",
)
oracle(
    "tenant_view", "select * from fct where tenant_id in ('AMERICA', 'AFRICA')", "fct",
    ts="event_at received_at", day="event_date_local", money="parts_cost",
)
oracle(
    "check_unique",
    """select transaction_id, count(*) as n_records from raw_sales
       group by 1 having count(*) > 1""",
    "raw_sales",
)
oracle(
    "check_unique_combination",
    """select tenant_id, transaction_id, line_number, count(*) as n_records from raw_sales
       group by 1, 2, 3 having count(*) > 1""",
    "raw_sales",
)
oracle("check_not_null", "select event_id, upload_id from stg where asset_tag is null", "stg")
oracle(
    "check_relationships",
    """select event_id, building_key from fct where building_key is not null
       and building_key not in (select building_key from dim_b where not is_inferred)""",
    "fct", "dim_b",
)
oracle(
    "check_accepted_values",
    "select event_id, event_action from fct where event_action in ('assigned', 'started')", "fct",
)
oracle(
    "check_accepted_range",
    """select 'SUP-' || s_suppkey as building_code, cast(s_suppkey as int) as capacity
       from supplier where s_suppkey < 10""",
)

oracle(
    "coerce_decimal",
    """select l_orderkey, l_linenumber, l_partkey, l_shipdate,
       if(starts_with(t, '('), -n, n) as value,
       if(t <> '' and n is null, 'expected a number', null) as error
       from (select *, try_cast(replace(trim(t, '()'), ',', '') as decimal(12,2)) as n
             from (select *, trim(regexp_replace(amount, '[$]|cad|usd', '', 'gi')) as t from amount_texts))""",
    "amount_texts", ts="l_shipdate", money="value",
)
oracle(
    "coerce_date",
    """select o_orderkey, value, if(value is null, 'expected a date like 07/04/2026', null) as error
       from (select o_orderkey, coalesce(try_strptime(day_text, '%m/%d/%Y'),
               try_strptime(day_text, '%Y-%m-%d')) as value from date_texts)""",
    "date_texts", day="value",
)
oracle(
    "coerce_timestamp",
    """select event_id, value,
       if(value is null, 'expected a date and time like 07/04/2026 14:30', null) as error
       from (select event_id, case
         when time_text like '%-07:00' then timezone('UTC', cast(time_text as timestamptz))
         else timezone('UTC', timezone('America/New_York', coalesce(
           try_strptime(time_text, '%m/%d/%Y %H:%M'), try_cast(time_text as timestamp)))) end as value
         from time_texts)""",
    "time_texts", ts="value",
)
oracle(
    "coerce_integer",
    """select batch_id, source_row, transaction_id, line_number, try_cast(quantity as int) as value,
       if(quantity = 'fifty', 'expected a whole number', null) as error from sales_texts""",
    "sales_texts",
)
oracle(
    "coerce_boolean",
    """select c_custkey, case c_mktsegment when 'FURNITURE' then true when 'BUILDING' then true
       when 'MACHINERY' then false end as value,
       case c_mktsegment when 'AUTOMOBILE' then 'expected yes or no' end as error from customer""",
)
oracle(
    "map_values",
    """select o_orderstatus as batch_id, o_orderkey as source_row,
       cast(o_orderkey as varchar) as transaction_id,
       case o_orderpriority when '1-URGENT' then 'camper_account' when '2-HIGH' then 'cash'
         when '5-LOW' then 'card' else ' ' || lower(o_orderpriority) || '  ' end as payment_method,
       true as sold_at_missing, 'Shipped' as missing_columns from orders""",
)
oracle(
    "validate_rows",
    """select batch_id, source_row, record_key, rules, cast(lacks_payment as int) as file_problems,
       if(lacks_payment or own like '%quantity%', null, try_cast(quantity as int)) as quantity from ruled""",
    "ruled",
)
oracle(
    "duplicate_keys",
    """select batch_id, source_row, record_key,
       'transaction_id, line_number ' || chr(39) || record_key || chr(39) || ' already appears on row ' || first_row
         || '. We kept row ' || first_row || '.' as message
       from ruled where rules like '%duplicate_key%'""",
    "ruled",
)
oracle(
    "reference_check",
    """select tenant_id, rule, field,
       if(field = 'cashier_staff_code', cashier_staff_code, store_building_code) as value,
       count(*) as n_rows from broken where rule like '%_reference' group by all""",
    "broken",
)
oracle(
    "violation_groups",
    """select batch_id, row_number() over (partition by batch_id
         order by rule = 'held_reference', count desc, rule, "column") as position,
       rule, "column", count, array_to_string(shown[1:12], ',') as example_rows,
       greatest(0, count - 12) as more
       from (select batch_id, rule,
               if(rule = 'duplicate_key', 'transaction_id, line_number', field) as "column",
               count(*) as count, list(source_row order by source_row) as shown
             from broken group by 1, 2, 3)""",
    "broken",
)
oracle("batch_status", "select * from batch_totals", "batch_totals", ts="finished_at")
oracle(
    "quarantine_resolution",
    """select h.batch_id, h.source_row, l.batch_id as resolved_batch_id, h.resolved_at
       from held h join loads l on l.tenant_id = h.tenant_id and l.record_key = h.record_key
         and l.sent_on = h.resolved_at""",
    "held", ts="resolved_at",
)
oracle(
    "mon_ingestion_quality",
    """select b.tenant_id, t.camp_name, b.feed, b.batches, b.files_rejected, b.rows_received, b.rows_loaded,
       b.rows_quarantined, q.rows_resolved, q.rows_open, q.oldest_open_since, b.last_batch_at
       from (select tenant_id, feed, count(*) as batches,
               count(*) filter (batch_status = 'rejected') as files_rejected,
               cast(sum(rows_received) as bigint) as rows_received,
               cast(sum(rows_loaded) as bigint) as rows_loaded,
               cast(sum(rows_quarantined) as bigint) as rows_quarantined,
               max(finished_at) as last_batch_at from batch_totals group by 1, 2) b
       join tenants t using (tenant_id)
       left join (select tenant_id, count(*) filter (done) as rows_resolved,
                    count(*) filter (not done) as rows_open, min(sent_on) filter (not done) as oldest_open_since
                  from (select *, max(resolved_at) over (partition by batch_id, source_row) is not null as done
                        from held) group by 1) q using (tenant_id)""",
    "batch_totals", "held", "tenants", ts="oldest_open_since last_batch_at",
)
oracle(
    "contract_upgrade",
    """select tenant_id, asset_tag, asset_name, 'other' as category, building_code, purchased_on,
       purchase_cost, 'in_service' as status from raw_assets""",
    "raw_assets", day="purchased_on", money="purchase_cost",
)
oracle("incremental_work_orders", "select * from wo", "wo", **_WO)
oracle(
    "incremental_maintenance_daily", "select * from daily", "daily", day="activity_date", money="parts_cost",
)
ORACLES["incremental_fct_maintenance_events"] = ORACLES["fct_maintenance_events"]
ORACLES["incremental_waterfront_checks"] = ORACLES["fct_waterfront_checks"]
oracle("streamed_dedupe", "select * from ev", "ev", ts=_EV_TS, money=_EV_MONEY)

oracle(
    "pending_files",
    "select distinct tenant_id, feed, source_file from landed where step = 1", "landed",
)
oracle(
    "results_of_runs",
    """select tenant_id, feed, source_file, count(*) as rows_received, count(*) filter (rules = '') as rows_loaded,
         count(*) filter (rules <> '') as rows_quarantined,
         (select count(*) from closed c where c.tenant_id = l.tenant_id and c.feed = l.feed
            and c.resolved_by = l.source_file) as rows_resolved,
         if(count(*) filter (rules <> '') > 0, 'loaded_with_errors', 'loaded') as status, step as run
       from landed l group by tenant_id, feed, source_file, step
       union all
       select distinct tenant_id, feed, source_file, 0, 0, 0, 0, 'skipped', 2 from landed where step = 1
       union all
       select distinct tenant_id, feed, replace(source_file, 's-1-', 's-copy-'), 0, 0, 0, 0, 'skipped', 2
       from landed where step = 1 and feed = 'buildings'""",
    "landed", "closed",
)
oracle(
    "raw_after_ingest",
    """select tenant_id, tag as asset_tag, name as asset_name, 'other' as category, home as building_code,
         strptime(bought, '%m/%d/%Y') as purchased_on, cast(replace(price, '$', '') as decimal(12,2)) as purchase_cost,
         'in_service' as status, file as source_file, source_row, 1 as contract_version
       from landed_assets where rules = ''""",
    "landed_assets", day="purchased_on", money="purchase_cost",
)
oracle(
    "quarantine_after_ingest",
    """select tenant_id, feed, source_file, source_row, record_key, rules, building_name, resolved_by from closed""",
    "closed",
)
oracle(
    "open_quarantine",
    """select tenant_id, feed, source_file, source_row, record_key from closed
       where tenant_id = 'ASIA' and resolved_by is null""",
    "closed",
)
oracle(
    "rows_to_fix",
    """select tenant_id, file as source_file, source_row, code, name as house,
         if(rules = 'duplicate_key', 'Code ' || chr(39) || code || chr(39) || ' already appears on row ' || first_row
              || '. We kept row ' || first_row || '.',
            concat_ws(' ', if(name = '', 'House is blank, and every row needs one.', null),
              if(kind = 'Yurt', chr(39) || 'Yurt' || chr(39) || ' isn' || chr(39)
                || 't a recognised Used as. Check the spelling or ask us to add it.', null))) as fix
       from (select *, min(source_row) over (partition by tenant_id, file, code) as first_row from landed_buildings)
       where rules <> ''""",
    "landed_buildings",
)
oracle(
    "run_totals",
    """select (select count(distinct (tenant_id, feed, source_file)) from landed where step = 2) as files,
         0 as rejected, (select count(*) from landed where step = 2 and rules = '') as rows_loaded,
         (select count(*) from landed where step = 2 and rules <> '') as rows_quarantined,
         (select count(*) from closed where resolved_by is not null) as rows_resolved""",
    "landed", "closed",
)
