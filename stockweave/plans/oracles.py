"""DuckDB SQL for the registered queries, on the same tables."""

from __future__ import annotations

SKU = """cast(case when event_id % 3 = 0 then event_id // 6 else event_id * 7 % 997 end as varchar)"""

# Stock feed derived from the events: the event type gives the phase, event_id the order.
FEED = f"""
feed as (
  select phase, phase * 1000000000000000000 + event_id as ord,
         case when phase in (2, 3) then null else cast(user_id as varchar) end as item,
         {SKU} as sku,
         concat('B', cast(event_id % 8 as varchar)) as branch,
         value as qty
  from (select *, case event_type when 'view' then 1 when 'purchase' then 2 when 'signup' then 3
                                  when 'click' then 4 else 5 end as phase from events) e)
"""

# The same records as they arrive through the landed files of the nightly run: each feed has its
# branch, whole quantities except online, positive ones only from head office.
LANDED_FEED = f"""
feed as (
  select phase,
         phase * 1000000000000000000
           + case when phase = 1 then event_id % 8 else 0 end * 10000000000000000 + event_id as ord,
         case when phase in (2, 3) then null else cast(user_id as varchar) end as item,
         {SKU} as sku,
         case phase when 2 then 'On Time' when 4 then 'HQ' when 5 then 'Saimai'
                    else concat('B', cast(event_id % 8 as varchar)) end as branch,
         case when phase = 2 then value else trunc(value) end as qty
  from (select *, case event_type when 'view' then 1 when 'purchase' then 2 when 'signup' then 3
                                  when 'click' then 4 else 5 end as phase from events) e
  where not (phase = 4 and trunc(value) <= 0))
"""

RECONCILE = """
reg1 as (select item, min_by(sku, ord) as sku, min(ord) as ord from feed where phase = 1
         group by item),
sku_new as (select sku as item, sku, min(ord) as ord from feed f where phase in (2, 3)
            and not exists (select 1 from reg1 r where r.sku = f.sku)
            and not exists (select 1 from reg1 r where r.item = f.sku) group by sku),
cand as (select item, sku, ord from reg1 union all select item, sku, ord from sku_new
         union all select item, sku, ord from feed where phase in (4, 5)),
entries as (select item, min_by(sku, ord) as sku, min(ord) as entry_ord from cand group by item),
head as (select sku, min(ord) as entry_ord
         from (select sku, ord from reg1 union all select sku, ord from sku_new) u group by sku),
facts as (select e.sku, e.entry_ord, f.ord, f.branch, f.qty
          from feed f join entries e on e.item = f.item where f.phase in (1, 4, 5)
          union all
          select h.sku, h.entry_ord, f.ord, f.branch, f.qty
          from feed f join head h on h.sku = f.sku where f.phase in (2, 3)),
win as (select sku, branch, qty from (
          select *, row_number() over (partition by sku, branch
                                       order by entry_ord desc, ord desc) as rn from facts) t
        where rn = 1),
rep as (select sku, min_by(item, entry_ord) as item, min(entry_ord) as entry_ord
        from entries group by sku),
snap as (select w.sku, r.item, w.branch, w.qty, r.entry_ord from win w join rep r on r.sku = w.sku)
"""

SNAP = f"with {FEED}, {RECONCILE}"

DIRTY = """
with dirty as (
  select event_id, event_type,
         case event_id % 14 when 0 then 'NA' when 1 then '' when 2 then '1,234' when 3 then '5d'
                            when 4 then '-3' when 5 then '0.5' when 6 then '2.9' when 7 then ' 5 '
                            when 8 then concat(chr(9), '7') when 9 then concat(chr(160), '8')
                            when 10 then '๕' when 11 then '1_000' when 12 then '1__0'
                            else cast(event_id % 50 as varchar) end as qty_text
  from events),
-- head office reads ASCII alone, the strict rules all scripts, blanks and single underscores
plain as (
  select *, trim(qty_text, concat(' ', chr(9))) as ascii_text,
         regexp_replace(translate(trim(qty_text, concat(' ', chr(9), chr(160))), '๐๑๒๓๔๕๖๗๘๙', '0123456789'),
                        '([0-9])_([0-9])', '\\1\\2', 'g') as spelt
  from dirty),
counted as (
  select *, case when regexp_matches(ascii_text, '^[+-]?[0-9]+([.][0-9]*)?$')
                 then cast(ascii_text as double) else 0 end as hq_qty
  from plain)
"""

CATALOG = """
with cat as (
  select concat(strftime(max(ts), '%d%m%y_%H%M%S'), '.json') as file_name,
         date_trunc('second', max(ts)) as snapshot_ts
  from events group by date_trunc('day', ts))
"""

DAILY = """
with daily as (
  select date_trunc('day', ts) as day, cast(user_id as varchar) as sku, event_type as branch,
         max_by(value, event_id) as qty
  from events group by 1, 2, 3),
ids as (select date_trunc('day', ts) as day, strftime(max(ts), '%d%m%y_%H%M%S') as snapshot_id
        from events group by 1)
"""

ALIASES = "(values ('Brand#1', 'CANON-1'), ('Brand#7', 'CANON-7'), ('Brand#12', 'CANON-1'))"

GROUPS = """case when branch in ('B0', 'B1', 'B2') then 'store' when branch = 'B3' then 'hq'
  when branch = 'B4' then 'online' when branch in ('B5', 'B6') then 'vending' else '' end"""

ROW = "lower(concat_ws(' ', sku, item, branch))"

QTY_TEXT = """case when qty = trunc(qty) then cast(cast(qty as bigint) as varchar)
  else cast(qty as varchar) end"""

ORACLES = {
    # Feeds
    "feed_scan_tagged": f"""
        select concat(event_type, ': 5% [a]') as branch, cast(user_id as varchar) as item,
               {SKU} as sku, trunc(value) as qty from events""",
    "api_inline": "select event_id, cast(props->>'$.k' as bigint) as k from events",
    "api_documents": "select event_id, cast(props->>'$.k' as bigint) as k from events",
    "sheet_line_breaks": """
        select event_id, concat(event_type, chr(10), '"two", ', chr(10), cast(event_id % 7 as varchar), '"') as item,
               event_id % 50 as qty
        from events""",
    "vend_positional": """
        select event_id, event_type as branch, trunc(value) as qty from events
        where event_id < (select coalesce(min(event_id), 9223372036854775807) from events
                          where value > 300
                            and event_id * 10 > (select max(event_id) from events) * 9)""",
    "vend_whole": "select event_id, event_type as branch, trunc(value) as qty from events",
    "sheet_bad_width": """
        select cast(event_id as varchar) as sku, 'a, b' as branch,
               case when event_id % 10 = 3 then 'a row with more cells than the header'
                    else 'kept' end as fate
        from events""",
    "hq_sheet": DIRTY + """
        select event_id, event_type as item, cast(trunc(hq_qty) as bigint) as qty
        from counted where hq_qty >= 1""",
    "depot_sheet": f"""
        select cast(p_partkey as varchar) as item, coalesce(a.canonical, p.p_brand) as sku,
               cast(p_size as bigint) as qty
        from part p left join {ALIASES} a(source, canonical) on a.source = p.p_brand""",
    "feed_status": """
        select event_type as unit, 'read' as status, cast(count(*) as bigint) as n_rows
        from events group by event_type
        union all select 'closed store', 'failed', cast(0 as bigint)""",
    "positional_projection":
        "select user_id as sku, event_type as item, value as qty from events",
    "row_offset": "select event_id, value from events where event_id >= 2",
    "drop_all_null": """
        select a, b from (
          select case when event_id % 3 = 0 then null else event_type end as a,
                 case when event_id % 2 = 0 then null else value end as b from events) t
        where a is not null or b is not null""",
    "feed_union": f"with {FEED} select phase, ord, item, sku, branch, qty from feed",
    # Cleaning
    "hq_clean": DIRTY + """
        select event_id, cast(trunc(hq_qty) as bigint) as qty from counted where hq_qty >= 1""",
    "depot_clean": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey,
               cast(trunc(l_quantity) as bigint) as qty from lineitem""",
    "na_normalise": DIRTY + """
        select event_id,
               case when qty_text in ('', 'NA', 'N/A', 'null', 'None', '#N/A', 'nan', 'NaN')
                    then null else qty_text end as qty_text from dirty""",
    "cast_strict_int": DIRTY + """
        select event_id, case when regexp_matches(spelt, '^[+-]?[0-9]+$')
                              then cast(spelt as bigint) end as qty from plain""",
    "cast_strict_double": "select event_id, value as qty from events",
    "prefix_until_bad": """
        with m as (select event_id, event_type, value,
                          min(case when value > 300 then event_id end)
                            over (partition by event_type) as bad from events)
        select event_id, event_type, value from m where bad is null or event_id < bad""",
    "sku_alias_map": f"""
        select p_partkey, coalesce(a.canonical, p.p_brand) as sku
        from part p left join {ALIASES} a(source, canonical) on a.source = p.p_brand""",
    # Reconciliation
    "item_registry": SNAP + "select item, sku, entry_ord from entries",
    "resolve_by_item": SNAP + """
        select f.ord, e.sku, f.branch, f.qty from feed f join entries e on e.item = f.item
        where f.phase in (1, 4, 5)""",
    "resolve_by_sku": SNAP + """
        select f.ord, h.sku, h.entry_ord, f.branch, f.qty from feed f join head h on h.sku = f.sku
        where f.phase in (2, 3)""",
    "new_sku_entries": SNAP + "select sku, ord from sku_new",
    "dropped_sku_name_clash": SNAP + """
        select f.ord, f.sku from feed f where f.phase in (2, 3)
        and not exists (select 1 from head h where h.sku = f.sku)""",
    "branch_last_wins": f"""
        with {FEED} select item, branch, max_by(qty, ord) as qty from feed
        where item is not null group by item, branch""",
    "snapshot_reconcile": SNAP + "select sku, item, branch, qty from snap",
    "snapshot_ordered": SNAP + "select sku, item, entry_ord from rep order by entry_ord",
    "snapshot_nested": SNAP + """
        select sku, item,
               string_agg(concat(branch, '=', cast(cast(qty as decimal(18, 2)) as varchar)), ','
                          order by branch) as branches
        from snap group by sku, item""",
    "explode_branches": SNAP + "select sku, item, branch, qty from snap",
    "nightly_run": f"with {LANDED_FEED}, {RECONCILE} select sku, item, branch, qty from snap",
    "mended_run": f"with {LANDED_FEED}, {RECONCILE} select sku, item, branch, qty from snap",
    "rerun_replaces": """
        select cast(event_id as varchar) as sku, event_type as branch, trunc(value) as qty
        from events""",
    "nightly_document": """
        select cast(event_id as varchar) as sku, cast(event_id as varchar) as item,
               event_type as branch, trunc(value) as qty from events""",
    # History
    "snapshot_text_qty": """
        select event_id, event_type as branch,
               cast(case when event_id % 2 = 0 then 1 else -1 end
                    * case event_id % 3 when 0 then event_id % 50
                                        when 1 then event_id % 50 + 0.5
                                        else event_id % 50 * 10 end as double) as qty
        from events""",
    "import_documents": DAILY + """
        select i.snapshot_id, d.sku, d.branch, d.qty from daily d join ids i on i.day = d.day""",
    "snapshot_read": SNAP + "select sku, item, branch, qty from snap",
    "sink_latest": SNAP + "select sku, item, branch, qty from snap",
    "lost_race": SNAP + "select sku, item, branch, qty from snap",
    "swept_history": DAILY + """
        select i.snapshot_id, d.sku, d.branch, d.qty from daily d join ids i on i.day = d.day""",
    "sink_history": DAILY + """
        select i.snapshot_id, d.sku, d.branch, d.qty from daily d join ids i on i.day = d.day""",
    "sink_catalog": CATALOG + "select file_name, snapshot_ts from cat order by snapshot_ts desc",
    "snapshot_catalog":
        CATALOG + "select file_name, snapshot_ts from cat order by snapshot_ts desc",
    "latest_snapshot": CATALOG + "select file_name from cat order by snapshot_ts desc limit 1",
    "snapshot_count": CATALOG + "select cast(count(*) as bigint) as snapshots from cat",
    "snapshot_at": """
        select cast(user_id as varchar) as sku, event_type as branch,
               max_by(value, event_id) as qty
        from events where ts >= timestamp '2024-01-15' and ts < timestamp '2024-01-16'
        group by user_id, event_type""",
    "snapshot_label": CATALOG + """
        select file_name, concat('วันที่ ', strftime(snapshot_ts, '%d/%m/%Y %H:%M:%S')) as label
        from cat""",
    "snapshot_name": "select event_id, strftime(ts, '%d%m%y_%H%M%S') as name from events",
    "last_updated_text": """
        select event_id, strftime(ts + interval 7 hour, '%Y-%m-%d %H:%M:%S') as last_updated
        from events""",
    "json_roundtrip": """
        select user_id, event_type, cast(count(*) as bigint) as n
        from events group by user_id, event_type""",
    # Dashboard
    "rollup_selected": SNAP + """
        select sku, item, round(sum(qty), 2) as qty from snap where branch in ('B0', 'B3', 'B5')
        group by sku, item""",
    "sink_export": SNAP + """
        select sku, item, round(sum(qty), 2) as qty from snap where branch in ('B0', 'B3', 'B5')
        group by sku, item""",
    "stock_band": SNAP + """
        , totals as (select sku, round(sum(qty), 2) as qty from snap where branch in ('B0', 'B3')
                     group by sku)
        select sku, qty, case when qty < 5 then 'critical' when qty < 10 then 'low'
                              else 'normal' end as band from totals""",
    "dashboard_table": SNAP + f"""
        , totals as (select sku, item, round(sum(qty), 2) as qty from snap group by sku, item),
        visible as (select sku, item, qty from totals
                    where concat_ws(' ', sku, item, {QTY_TEXT}) like '%1%'
                    order by qty desc, sku limit 30 offset 30)
        select sku, item, qty, case when qty < 5 then 'critical' when qty < 10 then 'low'
                                    else 'normal' end as band from visible""",
    "distinct_branches": SNAP + "select distinct branch from snap",
    "branch_group": SNAP + f"select distinct branch, {GROUPS} as branch_group from snap",
    "branch_group_table": SNAP + f"select sku, branch, {GROUPS} as branch_group from snap",
    "search_rows": SNAP + f"""
        select sku, item, branch from snap where {ROW} like '%b3%' and {ROW} like '%12%'""",
    "search_table": SNAP + f"""
        , totals as (select sku, item, round(sum(qty), 2) as qty from snap group by sku, item)
        select sku, item, qty from totals
        where concat_ws(' ', sku, item, {QTY_TEXT}) like '%12%'
          and concat_ws(' ', sku, item, {QTY_TEXT}) like '%.5%'""",
    "table_info": SNAP + f"""
        select cast(count(*) as bigint) as total,
               cast(count_if({ROW} like '%b3%') as bigint) as shown from snap""",
    "page_rows": SNAP + """
        select sku, round(sum(qty), 2) as qty from snap group by sku order by sku
        limit 30 offset 30""",
    "page_far": SNAP + """
        select sku, round(sum(qty), 2) as qty from snap group by sku order by sku
        limit 30 offset 600""",
    "page_ties": f"""
        with {FEED} select ord, cast(floor(qty) as bigint) as qty from feed order by qty desc, ord
        limit 100 offset 2500""",
    "page_after": SNAP + """
        , totals as (select sku, round(sum(qty), 2) as qty from snap group by sku)
        select sku, qty from totals where qty < 90 or (qty = 90 and sku > '5')
        order by qty desc, sku limit 30""",
    "page_all": SNAP + "select sku, round(sum(qty), 2) as qty from snap group by sku order by sku",
    "number_rows": SNAP + """
        select sku, cast(row_number() over (order by sku) as bigint) as row_no
        from (select distinct sku from snap) t""",
    "stock_dashboard": SNAP + f"""
        , totals as (select sku, item, round(sum(qty), 2) as qty from snap
                     where branch in ('B0', 'B3', 'B5') group by sku, item)
        select sku, item, qty, case when qty < 5 then 'critical' when qty < 10 then 'low'
                                    else 'normal' end as band from totals""",
}
