"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each text runs on the test tables registered as views (``lineitem``,
``orders``, ``customer``, ``supplier``, ...). The SQL is composed from the
CTE blocks below: the dirty feed, the cleaning chain and the KPIs. Rounding
goes through ``decimal(18,8)`` like the Spark side, so ties round the same
way in both engines.
"""

from __future__ import annotations


def round2(x: str) -> str:
    return f"cast(round(cast({x} as decimal(18,8)), 2) as double)"


def ratio(num: str, den: str) -> str:
    return round2(f"cast({num} as double) * 100.0 / {den}")


def money(x: str) -> str:
    return f"cast(round(sum(cast({x} as decimal(24,6))), 2) as double)"


def count_if(cond: str) -> str:
    return f"cast(count(*) filter (where coalesce({cond}, false)) as bigint)"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def parse_ts(x: str) -> str:
    return (f"coalesce(try_strptime({x}, '%Y-%m-%d %H:%M:%S'), "
            f"try_strptime({x}, '%d/%m/%Y %H:%M:%S'))")


def hm(h: str, m: str) -> str:
    return f"(to_hours(cast({h} as int)) + to_minutes(cast({m} as int)))"


def courier_key(sk: str) -> str:
    return (f"concat('REP-', case when length(cast({sk} as varchar)) < 5 "
            f"then lpad(cast({sk} as varchar), 5, '0') else cast({sk} as varchar) end)")


def h2(key: str, rule: str, digits: int = 2) -> str:
    return f"substr(md5(concat({key}, ':{rule}')), 1, {digits})"


FEED_SHIPMENTS = f"""
fb AS (
  select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date)) as k,
    l_orderkey ok, l_linenumber ln, l_partkey pk, l_suppkey sk,
    cast(l_quantity*0.5 as varchar) as w, cast(l_extendedprice as varchar) as amount_raw, c_mktsegment as seg,
    l_shipdate + {hm('8+l_orderkey%11', 'l_partkey%60')} as pickup
  from lineitem join orders on l_orderkey=o_orderkey join customer on o_custkey=c_custkey),
fs AS (
  select *, pickup + {hm('4+(pk*7+ln)%33', 'ok%60')} as delivery,
    case when {h2('k', 'st')} < 'd9' then 'DELIVERED'
         when {h2('k', 'st')} < 'f3' then 'INCIDENT' else 'RETURNED' end as status,
    case when {h2('k', 'cl')} < 'b3' then 'PERSON' else 'COMPANY' end as client_type,
    lpad(cast(1000 + (pk*37 + length(seg)) % 90000 as varchar), 5, '0') as zip5
  from fb),
fc AS (
  select *, concat(k,'#0') as kc from fs
  union all
  select *, concat(k,'#1') as kc from fs where {h2('k', 'dup', 4)} < '051f'),
raw_shipments AS (
  select k as tracking_id,
    case when {h2('kc', 'eu')} < '1a' then strftime(pickup,'%d/%m/%Y %H:%M:%S')
         else strftime(pickup,'%Y-%m-%d %H:%M:%S') end as pickup_raw,
    case when status='DELIVERED' then strftime(delivery,'%Y-%m-%d %H:%M:%S') end as delivery_raw,
    case when {h2('kc', 'city')} < '07' then lower(seg)
         when {h2('kc', 'city')} < '0e' then concat('  ',seg,'  ')
         else concat(substr(seg,1,1),lower(substr(seg,2))) end as city,
    case when {h2('kc', 'zip')} < '0b' and zip5 like '0%' then substr(zip5,2) else zip5 end as zip,
    case when {h2('kc', 'bad', 4)} < '0148' then
           case pk%4 when 0 then '-0.5' when 1 then '0.0' when 2 then '75.5' else '640.0' end
         when {h2('k', 'wn')} < '08' then null
         when {h2('kc', 'com')} < '04' then replace(w,'.',',') else w end as weight_raw,
    status,
    case when {h2('kc', 'fk', 4)} < '028f' then concat('REP-X',lpad(cast(sk%100 as varchar),4,'0'))
         else {courier_key('sk')} end as courier_id,
    client_type, amount_raw
  from fc)"""

FEED_COURIERS = f"""
cb AS (
  select {courier_key('s_suppkey')} as k, s_suppkey sk, s_name, s_nationkey nk from supplier),
cs AS (
  select k as courier_id,
    case when sk%7=0 then concat(' ',s_name,' ') else s_name end as first_name,
    concat('Family ',cast(nk as varchar)) as last_name,
    concat(cast(2019+sk%5 as varchar),'-',lpad(cast(1+sk%12 as varchar),2,'0'),'-',lpad(cast(1+sk%28 as varchar),2,'0')) as hire_date,
    case when {h2('k', 'cv')} < '10'
           then case when sk%5<3 then case sk%3 when 0 then 'employee' when 1 then 'Employee' else 'EMP' end else 'contractor' end
         when sk%5<3 then 'EMPLOYEE' else 'CONTRACTOR' end as contract,
    case sk%5 when 0 then 'Automobile' when 1 then 'Building' when 2 then 'Furniture' when 3 then 'Household' else ' Machinery ' end as assigned_city,
    case when sk%20<10 then 'VAN' when sk%20<17 then 'MOTO' else 'BIKE' end as vehicle,
    case when {h2('k', 'ph')} < '1a' then null else concat('+34 6',lpad(cast(sk as varchar),8,'0')) end as phone
  from cb),
raw_couriers AS (
  select * from cs
  union all
  select * from cs where {h2('courier_id', 'dup')} < '0d')"""

BROKEN_SHIPMENTS = f"""
bs AS (select *, {h2('tracking_id', 'broken')} as h from raw_shipments),
broken_shipments AS (
  select case when h < '02' then concat_ws(',', tracking_id, pickup_raw, status, courier_id)
              when h < '04' then concat_ws(',', tracking_id, pickup_raw, 'x', 'X', '00000', '1', status, courier_id, client_type, amount_raw, 'surplus')
              else concat(tracking_id, ',"', pickup_raw, ',x,X,00000,1,', status, ',', courier_id, ',', client_type, ',', amount_raw) end as line,
    case when h < '02' then 'short_line' when h < '04' then 'long_line' else 'unclosed_quote' end as reason
  from bs where h < '06')"""

BROKEN_COURIERS = f"""
bc AS (select *, {h2('courier_id', 'broken')} as h from raw_couriers),
broken_couriers AS (
  select case when h < '20' then concat('{{"courier_id":"', courier_id, '","first_name":')
              when h < '40' then concat(courier_id, ';', vehicle)
              when h < '60' then concat('["', courier_id, '"]')
              else concat('{{"vehicle":"', vehicle, '"}}') end as line,
    case when h < '40' then 'broken_json' when h < '60' then 'not_an_object' else 'no_key' end as reason
  from bc where h < '80')"""

KEYS = "tracking_id, pickup, delivery, city, zip, weight, status, courier_id, client_type, amount"

CLEAN_COURIERS = f"""
cc1 AS (
  select * replace (case when upper(contract) in ('EMPLOYEE','EMP') then 'EMPLOYEE'
                         when upper(contract) in ('CONTRACTOR') then 'CONTRACTOR'
                         else upper(contract) end as contract)
  from raw_couriers),
cc2 AS (
  select * exclude (rn) from (
    select *, row_number() over (partition by courier_id order by first_name nulls first, last_name nulls first,
      hire_date nulls first, contract nulls first, assigned_city nulls first, vehicle nulls first, phone nulls first) rn
    from cc1) where rn = 1),
couriers AS (
  select * replace (trim(first_name) as first_name, trim(last_name) as last_name,
                    trim(assigned_city) as assigned_city,
                    cast(try_strptime(hire_date, '%Y-%m-%d') as date) as hire_date)
  from cc2)"""

NORMALIZED = f"""
normalized AS (
  select *, {parse_ts('pickup_raw')} as pickup, {parse_ts('delivery_raw')} as delivery,
    {initcap('trim(city_raw)')} as city, lpad(zip_raw, 5, '0') as zip,
    try_cast(replace(weight_raw, ',', '.') as double) as weight, try_cast(amount_raw as double) as amount
  from (select * rename (city as city_raw, zip as zip_raw) from raw_shipments)),
in_range AS (
  select * from normalized where weight is null or (weight > 0.1 and weight <= 50.0)),
median AS (
  select quantile_disc(weight, 0.5) as median from in_range where weight is not null),
imputed AS (
  select * replace (coalesce(weight, (select median from median)) as weight) from in_range),
dedup AS (
  select distinct {KEYS} from imputed)"""

SILVER = f"""
silver AS (
  select d.tracking_id, d.courier_id, d.pickup, d.delivery, d.city, d.zip, d.weight, d.status,
    d.client_type, d.amount, c.first_name as courier_first_name, c.last_name as courier_last_name,
    c.contract, c.assigned_city, c.vehicle,
    {round2("cast(date_diff('second', d.pickup, d.delivery) as double) / 3600.0")} as transit_hours,
    case when d.status = 'DELIVERED' and date_diff('second', d.pickup, d.delivery) <= 86400
         then 1 else 0 end as on_time
  from dedup d join couriers c on d.courier_id = c.courier_id)"""


def with_ctes(*blocks: str) -> str:
    return "WITH " + ",".join(blocks)


BASE = (FEED_SHIPMENTS, FEED_COURIERS, CLEAN_COURIERS, NORMALIZED, SILVER)


def measures() -> str:
    return f"""count(tracking_id) as total_shipments,
    {count_if("status = 'DELIVERED'")} as delivered,
    {count_if("status = 'INCIDENT'")} as incidents,
    {count_if("status = 'RETURNED'")} as returned,
    {ratio('sum(on_time)', 'count(tracking_id)')} as sla_pct,
    {ratio(count_if("status = 'INCIDENT'"), 'count(tracking_id)')} as incident_pct,
    {round2('avg(transit_hours)')} as avg_transit_h,
    {money('amount')} as revenue"""


COURIER_KPI = f"""
courier_agg AS (
  select courier_id, courier_first_name, courier_last_name, contract, assigned_city, vehicle,
    count(tracking_id) as shipments,
    {count_if("status = 'DELIVERED'")} as delivered,
    {count_if("status = 'INCIDENT'")} as incidents,
    {ratio('sum(on_time)', 'count(tracking_id)')} as sla_pct,
    {round2('avg(transit_hours)')} as avg_transit_h,
    {money('amount')} as revenue
  from silver group by courier_id, courier_first_name, courier_last_name, contract, assigned_city, vehicle
  having count(tracking_id) >= 10),
courier_ranked AS (
  select *, cast(rank() over (order by shipments desc) as integer) as volume_rank,
    cast(rank() over (order by sla_pct desc) as integer) as quality_rank
  from courier_agg),
kpi_courier AS (
  select *, {round2('(volume_rank + quality_rank) / 2.0')} as score from courier_ranked)"""

COUNTS = f"""
stage_raw AS (
  select count(*) as raw_rows,
    {count_if('weight is null or (weight > 0.1 and weight <= 50.0)')} as in_range_rows,
    {count_if('not (weight is null or (weight > 0.1 and weight <= 50.0))')} as weight_out_of_range,
    {count_if('pickup is null and pickup_raw is not null')} as unparsed_pickup,
    {count_if('delivery is null and delivery_raw is not null')} as unparsed_delivery,
    {count_if("try_strptime(pickup_raw, '%Y-%m-%d %H:%M:%S') is null and pickup is not null")} as european_pickup,
    {count_if('city_raw <> city')} as city_fixed,
    {count_if('length(zip_raw) < 5')} as short_zip_padded,
    {count_if('length(lpad(zip_raw, 5, chr(48))) <> 5')} as bad_zip_length,
    {count_if("instr(weight_raw, ',') > 0")} as decimal_comma_weight,
    {count_if('amount_raw is not null and (amount is null or isnan(amount) or isinf(amount) or abs(amount) >= 1e36)')} as amount_not_summable,
    {count_if('(weight is null or (weight > 0.1 and weight <= 50.0)) and weight is null')} as null_weight_imputed
  from normalized),
stage_clean AS (
  select count(*) as dedup_rows,
    {count_if('c.courier_id is null')} as orphan_shipments,
    {count_if('d.weight is null')} as null_weight_left,
    {count_if('d.delivery is null')} as null_delivery_kept
  from dedup d left join couriers c on d.courier_id = c.courier_id),
stage_couriers AS (
  select (select count(*) from raw_couriers) as courier_raw_rows,
    (select {count_if("contract is not null and contract not in ('EMPLOYEE', 'CONTRACTOR')")} from raw_couriers)
      as contract_variants_fixed,
    (select count(*) from couriers) as courier_rows,
    (select {count_if('phone is null')} from couriers) as null_phone_kept),
counts AS (
  select *, in_range_rows - dedup_rows as duplicates_removed, dedup_rows - orphan_shipments as silver_rows,
    courier_raw_rows - courier_rows as courier_duplicates_removed
  from stage_raw, stage_clean, stage_couriers)"""

QUALITY_CHECKS = (
    "raw_rows", "unparsed_pickup", "unparsed_delivery", "european_pickup", "city_fixed",
    "short_zip_padded", "bad_zip_length", "decimal_comma_weight", "amount_not_summable", "weight_out_of_range",
    "null_weight_imputed", "duplicates_removed", "orphan_shipments", "null_weight_left",
    "null_delivery_kept", "silver_rows", "courier_raw_rows", "courier_duplicates_removed",
    "contract_variants_fixed", "null_phone_kept", "courier_rows",
)


def latest(rows: str) -> str:
    """One row per tracking id: the latest pickup, then the greatest of the other columns."""
    return f"""select * exclude (rn) from (select *, row_number() over (
              partition by tracking_id order by pickup desc nulls last, pickup_raw desc nulls last, delivery_raw desc nulls last,
              city desc nulls last, zip desc nulls last, weight_raw desc nulls last, status desc nulls last,
              courier_id desc nulls last, client_type desc nulls last, amount_raw desc nulls last) rn
              from ({rows})) where rn = 1"""


def _q(*extra_ctes: str, body: str, base=BASE) -> str:
    return with_ctes(*base, *extra_ctes) + "\n" + body


def sql_texts() -> dict[str, str]:
    feed = (FEED_SHIPMENTS, FEED_COURIERS)
    up_to_couriers = (FEED_SHIPMENTS, FEED_COURIERS, CLEAN_COURIERS)
    up_to_dedup = (FEED_SHIPMENTS, FEED_COURIERS, CLEAN_COURIERS, NORMALIZED)
    quality_union = " union all ".join(
        f"select '{c}' as \"check\", cast({c} as bigint) as value from counts" for c in QUALITY_CHECKS)
    return {
        "raw_shipments": _q(body="select * from raw_shipments", base=feed),
        "raw_couriers": _q(body="select * from raw_couriers", base=feed),
        "parse_mixed_ts": _q(body="select tracking_id, pickup_raw, pickup, delivery_raw, delivery from normalized",
                             base=up_to_dedup),
        "canonical_city": _q(body="select tracking_id, city_raw, city from normalized", base=up_to_dedup),
        "pad_zip": _q(body="select tracking_id, zip_raw, zip from normalized", base=up_to_dedup),
        "decimal_comma": _q(body="select tracking_id, weight_raw, weight from normalized", base=up_to_dedup),
        "weight_range": _q(body=f"select {KEYS} from in_range", base=up_to_dedup),
        "contract_canon": _q(body="""select courier_id, contract as contract_raw,
              case when upper(contract) in ('EMPLOYEE','EMP') then 'EMPLOYEE'
                   when upper(contract) in ('CONTRACTOR') then 'CONTRACTOR' else upper(contract) end as contract
              from raw_couriers""", base=feed),
        "couriers_clean": _q(body="select * from couriers", base=up_to_couriers),
        "median_weight_exact": _q(body="select median from median", base=up_to_dedup),
        "impute_median_exact": _q(body=f"select {KEYS} from imputed", base=up_to_dedup),
        "dedup_shipments": _q(body="select * from dedup", base=up_to_dedup),
        "orphans": _q(body="select d.* from dedup d where not exists "
                           "(select 1 from couriers c where c.courier_id = d.courier_id)", base=up_to_dedup),
        "orphan_ids": _q(body="select distinct d.courier_id from dedup d where not exists "
                              "(select 1 from couriers c where c.courier_id = d.courier_id)", base=up_to_dedup),
        "orphan_marked": _q(body="select d.*, c.courier_id is null as is_orphan from dedup d "
                                 "left join couriers c on d.courier_id = c.courier_id", base=up_to_dedup),
        "quarantine": _q(body=f"""
              select * exclude (city_raw, zip_raw), 'weight_out_of_range' as reason from normalized
                where not (weight is null or (weight > 0.1 and weight <= 50.0))
              union all
              select * exclude (city_raw, zip_raw), 'orphan_courier' as reason from in_range i
                where not exists (select 1 from couriers c where c.courier_id = i.courier_id)""",
                         base=up_to_dedup),
        "enriched": _q(body="""select d.*, c.first_name as courier_first_name, c.last_name as courier_last_name,
              c.contract, c.assigned_city, c.vehicle from dedup d join couriers c on d.courier_id = c.courier_id""",
                       base=up_to_dedup),
        "enriched_hot_couriers": _q(body="""select d.*, c.first_name as courier_first_name, c.last_name as courier_last_name,
              c.contract, c.assigned_city, c.vehicle from dedup d join couriers c on d.courier_id = c.courier_id""",
                                    base=up_to_dedup),
        "silver": _q(body="select * from silver"),
        "transit_hours": _q(body="select tracking_id, courier_id, status, pickup, delivery, transit_hours from silver"),
        "on_time": _q(body="select tracking_id, courier_id, status, pickup, delivery, on_time from silver"),
        "join_reconciliation": _q(body=f"""select *, pre_join_rows - post_join_rows = orphan_rows as reconciled from (
              select count(*) as pre_join_rows, cast(coalesce(sum(m), 0) as bigint) as post_join_rows,
                {count_if('m is null')} as orphan_rows, coalesce(max(m) <= 1, true) as dimension_key_unique
              from dedup d left join (select courier_id as ck, count(*) as m from couriers group by courier_id) c
                on d.courier_id = c.ck)""", base=up_to_dedup),
        "silver_cities": _q(body="select distinct city from normalized", base=up_to_dedup),
        "contract_values": _q(body="select distinct contract from couriers", base=up_to_couriers),
        "time_dims": _q(body="""select tracking_id, courier_id, pickup, cast(pickup as date) as day,
              cast(year(pickup) as integer) as year, cast(month(pickup) as integer) as month,
              cast(dayofweek(pickup) + 1 as integer) as weekday, cast(hour(pickup) as integer) as hour
              from silver"""),
        "kpi_daily": _q(body=f"""select cast(pickup as date) as day, cast(year(pickup) as integer) as year,
              cast(month(pickup) as integer) as month, city, {measures()}
              from silver group by all"""),
        "kpi_courier": _q(COURIER_KPI, body="select * from kpi_courier"),
        "incremental_equals_rebuild": _q(body=f"""select cast(pickup as date) as day, cast(year(pickup) as integer) as year,
              cast(month(pickup) as integer) as month, city, {measures()}
              from silver group by all"""),
        "incremental_kpi_courier": _q(COURIER_KPI, body="select * from kpi_courier"),
        "incremental_silver": _q(body="select * from silver"),
        "summary": _q(body=f"""select count(tracking_id) as total_shipments,
              {count_if("status = 'DELIVERED'")} as delivered,
              {count_if("status = 'INCIDENT'")} as incidents,
              {count_if("status = 'RETURNED'")} as returned,
              {ratio('sum(on_time)', 'count(tracking_id)')} as sla_pct,
              {round2('avg(transit_hours)')} as avg_transit_h,
              {money('amount')} as revenue,
              {ratio(count_if("status = 'DELIVERED'"), 'count(tracking_id)')} as delivered_pct,
              {ratio(count_if("status = 'INCIDENT'"), 'count(tracking_id)')} as incident_pct,
              {ratio(count_if("status = 'RETURNED'"), 'count(tracking_id)')} as returned_pct
              from silver"""),
        "city_volume": _q(body="select city, count(*) as shipments from silver group by city"),
        "top_cities": _q(body="select city, count(*) as shipments from silver group by city "
                              "order by shipments desc, city asc nulls first limit 3"),
        "top_couriers": _q(COURIER_KPI, body="""select courier_id, courier_first_name, courier_last_name,
              assigned_city, shipments, sla_pct, score from kpi_courier order by score, courier_id limit 10"""),
        "monthly_sla_city": _q(body=f"""select cast(year(pickup) as integer) as year,
              cast(month(pickup) as integer) as month, city, count(tracking_id) as total_shipments,
              cast(sum(on_time) as bigint) as on_time, {ratio('sum(on_time)', 'count(tracking_id)')} as sla_pct
              from silver group by all"""),
        "by_contract": _q(body=f"select contract, {measures()} from silver group by contract"),
        "by_vehicle": _q(body=f"select vehicle, {measures()} from silver group by vehicle"),
        "quality": _q(COUNTS, body=quality_union),
        "funnel": _q(COUNTS, body="""
              select 1 as step_no, 'raw' as step, raw_rows as rows, cast(0 as bigint) as removed from counts
              union all select 2, 'weight_range', in_range_rows, raw_rows - in_range_rows from counts
              union all select 3, 'impute_weight', in_range_rows, 0 from counts
              union all select 4, 'drop_duplicates', dedup_rows, in_range_rows - dedup_rows from counts
              union all select 5, 'courier_join', silver_rows, dedup_rows - silver_rows from counts"""),
        "bronze_shipments": _q(body="select *, 'shipments.csv' as source_file, "
                                    "'shipment_tracking' as source_system from raw_shipments", base=feed),
        "csv_roundtrip": _q(body="select * from raw_shipments", base=feed),
        "json_roundtrip": _q(body="select * from raw_couriers", base=feed),
        "export_kpi_courier": _q(COURIER_KPI, body="select * from kpi_courier"),
        "preview_silver": _q(body=f"select * from silver order by {', '.join(k + ' nulls first' for k in KEYS.split(', '))} limit 5"),
        "latest_per_tracking_id": _q(body=latest(f"select *, {parse_ts('pickup_raw')} as pickup from raw_shipments"),
                                     base=feed),
        "upsert_resent": _q(f"""parsed as (select *, {parse_ts('pickup_raw')} as pickup from raw_shipments)""",
                            body=latest("""select * from parsed union all
              select * replace ('RETURNED' as status, case when upper(trim(city)) < 'F' then pickup + interval 1 day
                else pickup - interval 1 day end as pickup) from parsed where length(amount_raw) % 7 = 0"""), base=feed),
        "median_weight_approx": _q(body="select median from median", base=up_to_dedup),
        "impute_median_approx": _q(body=f"select {KEYS} from imputed", base=up_to_dedup),
        "silver_approx_median": _q(body="select * from silver"),
        "ingest_shipments": _q(body="select *, true as source_file, 'shipment_tracking' as source_system "
                                    "from raw_shipments", base=feed),
        "ingest_couriers": _q(body="select *, true as source_file, 'courier_registry' as source_system "
                                   "from raw_couriers", base=feed),
        "layer_roundtrip": _q(body="select * from silver"),
        "rejected_shipments": _q(BROKEN_SHIPMENTS, body="select *, true as source_file, 'shipment_tracking' as source_system "
                                                        "from broken_shipments", base=feed),
        "rejected_couriers": _q(BROKEN_COURIERS, body="select *, true as source_file, 'courier_registry' as source_system "
                                                      "from broken_couriers", base=feed),
        "landing_quality": _q(BROKEN_SHIPMENTS, BROKEN_COURIERS, body="""
              select 'shipments' as kind, 'accepted' as outcome, count(*) as lines from raw_shipments
              union all select 'shipments', reason, count(*) from broken_shipments group by reason
              union all select 'couriers', 'accepted', count(*) from raw_couriers
              union all select 'couriers', reason, count(*) from broken_couriers group by reason""", base=feed),
        "ingest_among_broken_lines": _q(body="select * from raw_shipments", base=feed),
        "layer_counts": _q(COURIER_KPI, body="""
              select 'bronze' as layer, 'shipments' as table_name, count(*) as rows from raw_shipments
              union all select 'bronze', 'couriers', count(*) from raw_couriers
              union all select 'silver', 'shipments', count(*) from silver
              union all select 'silver', 'couriers', count(*) from couriers
              union all select 'gold', 'kpi_daily_city', count(*) from (select distinct cast(pickup as date), city from silver)
              union all select 'gold', 'kpi_courier', count(*) from kpi_courier"""),
        "kpi_daily_one_city": _q(body=f"""select cast(pickup as date) as day, cast(year(pickup) as integer) as year,
              cast(month(pickup) as integer) as month, city, {measures()}
              from silver where city = 'Automobile' group by all"""),
        "kpi_courier_employees": _q(COURIER_KPI, body="select * from kpi_courier where contract = 'EMPLOYEE'"),
        "yield_rate": _q(COUNTS, body=f"""select cast(raw_rows as bigint) as raw_rows,
              cast(silver_rows as bigint) as silver_rows, {ratio('silver_rows', 'raw_rows')} as yield_pct
              from counts"""),
    }
