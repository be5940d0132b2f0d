"""Independent DuckDB SQL for the bindings and every model.

This is the correctness oracle: the same semantics written as plain SQL over
the driver's views (``orders``, ``lineitem``, ...).  ``with_ctes`` assembles a
statement from the named CTEs a query needs, in dependency order.
"""

from __future__ import annotations

import re

AS_OF_TS = "TIMESTAMP '2024-02-01 00:00:00'"
AS_OF_DATE = "DATE '2024-02-01'"


def H(e: str) -> str:
    return f"to_hours(cast({e} as int))"


def D(e: str) -> str:
    return f"to_days(cast({e} as int))"


def hb(a: str, b: str) -> str:
    """Hour-boundary difference (DATEDIFF('hour', a, b))."""
    return f"date_diff('hour', {a}, {b})"


def rnd(x: str, n: int) -> str:
    return f"round(cast({x} as double), {n})"


def pct(part: str, whole: str = "count(*)", n: int = 1) -> str:
    return f"round(cast({part} as double) / nullif({whole}, 0) * 100, {n})"


def cnt(pred: str) -> str:
    return f"cast(sum(case when {pred} then 1 else 0 end) as bigint)"


def davg(x: str) -> str:
    return f"cast(sum({x}) as double) / count({x})"


def pctl(x: str, p: float) -> str:
    return f"round(quantile_cont(cast({x} as double), {p}), 6)"


def haversine(lat1, lon1, lat2, lon2) -> str:
    return (f"2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
            f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))")


def cell(lat: str, lon: str, res: int) -> str:
    size = 1.0 / (2 ** (res - 2))
    return (f"'r{res}:' || cast(cast(floor(({lat} + 90.0) / {size}) as bigint) as varchar) || ':' || "
            f"cast(cast(floor(({lon} + 180.0) / {size}) as bigint) as varchar)")


CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


# ---------------------------------------------------------------- bindings
cte("ph_ports", """
select n_name port_code, 'Port of ' || n_name port_name, r_name region,
  case when n_nationkey % 3 = 0 then 'international' else 'domestic' end port_type,
  cast(5.0 + 1.3 * (n_nationkey % 5) as double) lat,
  cast(118.0 + 1.3 * floor(n_nationkey / 5) as double) lon
from nation join region on n_regionkey = r_regionkey""")

cte("b_calls0", """
select event_id, 'IMO' || cast(9000001 + user_id as varchar) vessel_imo,
  ' nation_' || cast(event_id % 26 as varchar) || ' ' port_code,
  date_trunc('second', ts) t0,
  case when event_id % 10 < 3 then 12 + event_id % 61 else 0 end w,
  6 + event_id % 91 stay,
  case event_type when 'click' then 'fcl' when 'view' then 'lcl' when 'purchase' then 'roro' else 'bulk' end cargo_type
from events""")

cte("raw_vessel_calls", f"""
select vessel_imo, port_code, case when event_id % 97 = 0 then null else t0 end arrival_ts,
  t0 + {H('w')} berth_ts, t0 + {H('w + stay')} departure_ts,
  cast(case when event_id % 7 = 0 then null when event_id % 89 = 0 then 0 else w + stay end as int) dwell_hours,
  cast(w as int) anchorage_wait_h, cargo_type, cast(10 + event_id % 1991 as int) teu_count,
  cast(cast(t0 as date) as timestamp) + interval 1 day _loaded_at
from b_calls0""")

cte("b_ship0", """
select o_orderkey k, 'S' || cast(o_orderkey as varchar) shipment_id,
  'BL' || cast(100000 + o_orderkey % 900000 as varchar) bl_number,
  'org' || cast(c_nationkey as varchar) origin_port, 'nation_' || cast(o_orderkey % 26 as varchar) dest_port,
  case o_custkey % 7 when 0 then 'maersk' when 1 then 'msc' when 2 then 'evergreen' when 3 then 'one'
    when 4 then 'hmm' when 5 then 'zim' else 'unlisted' end carrier_code,
  'imo' || cast(9000001 + o_custkey % 150 as varchar) vessel_imo,
  cast(o_orderdate as timestamp) + interval 28 years etd,
  case o_orderkey % 6 when 0 then 'Electronics' when 1 then 'Machinery' when 2 then 'Textiles'
    when 3 then 'Food' when 4 then 'Chemicals' else 'Other' end cargo_type,
  'Brand#' || cast(1 + o_orderkey % 27 as varchar) commodity_code,
  cast(o_totalprice as decimal(15,2)) declared_value_usd
from orders join customer on o_custkey = c_custkey""")

cte("b_ship1", f"select *, etd + {D('3 + k % 23')} eta from b_ship0")

cte("raw_shipments", f"""
select shipment_id, bl_number, origin_port, dest_port, carrier_code, vessel_imo, etd, eta,
  case when k % 20 = 0 then null when k % 20 = 1 then eta - {H('5')} when k % 10 < 6 then eta
    else eta + {H('24 + k % 97')} end ata,
  cargo_type, commodity_code, declared_value_usd,
  cast(round(declared_value_usd * 0.08, 2) as decimal(15,2)) freight_usd,
  cast(round(declared_value_usd * 0.005, 2) as decimal(15,2)) insurance_usd,
  etd + interval 1 day _loaded_at
from b_ship1""")

cte("b_cust0", """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, cast(l_extendedprice as decimal(15,2)) v,
  cast(case l_partkey % 6 when 0 then 0 when 1 then 3 when 2 then 5 when 3 then 7 when 4 then 10 else 15 end
    as decimal(5,2)) r,
  cast(l_shipdate as timestamp) + interval 28 years lodge, l_returnflag, l_linestatus
from lineitem""")

cte("b_cust1", "select *, cast(round(v * r * 0.01, 2) as decimal(15,2)) du from b_cust0")

cte("raw_customs_entries", f"""
select 'CE' || cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) entry_number,
  'S' || cast(l_orderkey as varchar) shipment_id,
  'BL' || cast(100000 + l_orderkey % 900000 as varchar) bl_number,
  ' brand#' || cast(1 + l_partkey % 27 as varchar) commodity_code,
  case l_returnflag when 'A' then 'formal ' when 'N' then 'informal' else 'warehousing' end entry_type,
  v declared_value_usd, r tariff_rate_pct, du duties_usd,
  cast(round(case when l_partkey % 50 = 0 then v * 0.12 else (v + du) * 0.12 end, 2) as decimal(15,2)) vat_usd,
  cast(du + cast(round(case when l_partkey % 50 = 0 then v * 0.12 else (v + du) * 0.12 end, 2)
    as decimal(15,2)) as decimal(15,2)) total_tax_usd,
  cast(lodge as date) lodge_date, cast(lodge + {D('1 + l_partkey % 5')} as date) assessment_date,
  cast(lodge + {D('1 + l_partkey % 5 + l_suppkey % 4')} as date) release_date,
  cast(case when l_partkey % 11 = 0 then null else 1 + l_partkey % 5 + l_suppkey % 4 end as int) processing_days,
  case l_linestatus when 'O' then 'cash' else ' deferred ' end payment_mode,
  ' nation_' || cast(l_orderkey % 26 as varchar) port_code,
  lodge + interval 1 day _loaded_at
from b_cust1""")

cte("ph_tariff_rates", """
select p_brand commodity_code, 'Goods ' || p_brand description,
  cast(max(p_size) % 16 as decimal(5,2)) mfn_rate_pct, cast(max(p_size) % 6 as decimal(5,2)) atiga_rate_pct
from part group by p_brand""")

cte("usd_php_rates", """
select d rate_date, cast(50 + ((dayofyear(d) * 37) % 1000) * 0.01 as decimal(8,4)) usd_php_close
from (select distinct cast(o_orderdate + interval 28 years as date) d from orders) x
where dayofyear(d) % 7 <> 0""")

# ------------------------------------------------------------------ silver
cte("stg_vessel_calls", f"""
select vessel_imo, upper(trim(port_code)) port_code, arrival_ts, berth_ts, departure_ts,
  coalesce(cast(dwell_hours as bigint), {hb('arrival_ts', 'departure_ts')}) dwell_hours,
  anchorage_wait_h, upper(cargo_type) cargo_type, teu_count, _loaded_at
from raw_vessel_calls
where arrival_ts is not null
  and coalesce(cast(dwell_hours as bigint), {hb('arrival_ts', 'departure_ts')}) > 0""")

cte("stg_shipments", f"""
select shipment_id, bl_number, upper(origin_port) origin_port_code, upper(dest_port) dest_port_code,
  upper(carrier_code) carrier_code, upper(vessel_imo) vessel_imo, etd, eta, ata,
  case when {hb('eta', 'ata')} is null then null else greatest(0, {hb('eta', 'ata')}) end delay_hours,
  case when {hb('eta', 'ata')} = 0 then 'ON_TIME'
       when {hb('eta', 'ata')} <= 24 then 'MINOR_DELAY'
       when {hb('eta', 'ata')} <= 72 then 'MODERATE_DELAY'
       else 'SEVERE_DELAY' end delay_category,
  cargo_type, commodity_code, declared_value_usd, freight_usd, insurance_usd, _loaded_at
from raw_shipments where shipment_id is not null""")

cte("stg_customs_entries", """
select entry_number, shipment_id, bl_number, upper(trim(commodity_code)) commodity_code,
  upper(trim(entry_type)) entry_type, declared_value_usd, tariff_rate_pct, duties_usd, vat_usd,
  total_tax_usd, lodge_date, assessment_date, release_date,
  cast(coalesce(processing_days, date_diff('day', lodge_date, release_date)) as int) processing_days,
  upper(trim(payment_mode)) payment_mode, upper(trim(port_code)) port_code, _loaded_at
from raw_customs_entries
where entry_number is not null and shipment_id is not null""")

# -------------------------------------------------------------- dimensions
cte("dim_date", """
select date_key, cast(year(date_key) as int) year_num, cast(quarter(date_key) as int) quarter_num,
  cast(month(date_key) as int) month_num, strftime(date_key, '%b') month_name,
  cast(weekofyear(date_key) as int) week_num, cast(day(date_key) as int) day_of_month,
  cast(dayofweek(date_key) as int) day_of_week, strftime(date_key, '%a') day_name,
  dayofweek(date_key) in (0, 6) is_weekend, strftime(date_key, '%Y-%m') year_month,
  cast(year(date_key) as varchar) || '-Q' || cast(quarter(date_key) as varchar) year_quarter
from (select cast(DATE '2020-01-01' + to_days(cast(i as int)) as date) date_key
      from range(4018) t(i)) s
where date_key <= DATE '2030-12-31'""")

cte("dim_port", f"""
select md5(port_code) port_key, port_code, port_name, region, port_type, lat, lon,
  {cell('lat', 'lon', 5)} cell_res5, {cell('lat', 'lon', 7)} cell_res7
from ph_ports""")

cte("dim_vessel", """
select md5(vessel_imo) vessel_key, vessel_imo, cast(null as varchar) vessel_name,
  cast(null as varchar) flag_country, vessel_type, cast(null as int) capacity_teu
from (select vessel_imo, cargo_type vessel_type,
        row_number() over (partition by vessel_imo order by cargo_type asc nulls last) rn
      from (select distinct vessel_imo, cargo_type from stg_vessel_calls where vessel_imo is not null) v) r
where rn = 1""")

# FIXED VALUES: carrier code, carrier name, alliance.  Other codes are their own name and
# independent.
CARRIERS = [
    ("MAERSK", "Maersk Line", "2M"),
    ("MSC", "Mediterranean Shipping Company", "2M"),
    ("EVERGREEN", "Evergreen Marine", "OCEAN"),
    ("CMA CGM", "CMA CGM", "OCEAN"),
    ("OOCL", "Orient Overseas Container Line", "OCEAN"),
    ("COSCO SHIPPING", "COSCO Shipping Lines", "OCEAN"),
    ("HAPAG-LLOYD", "Hapag-Lloyd", "THE"),
    ("ONE", "Ocean Network Express", "THE"),
    ("YANG MING", "Yang Ming Marine Transport", "THE"),
    ("ZIM", "Zim Integrated Shipping", "INDEPENDENT"),
    ("PIL", "Pacific International Lines", "INDEPENDENT"),
    ("WAN HAI", "Wan Hai Lines", "INDEPENDENT"),
    ("HMM", "Hyundai Merchant Marine", "THE"),
    ("MCC TRANSPORT", "MCC Transport", "INDEPENDENT"),
    ("SITC", "SITC Container Lines", "INDEPENDENT"),
    ("TS LINES", "TS Lines", "INDEPENDENT"),
    ("X-PRESS FEEDERS", "X-Press Feeders", "INDEPENDENT"),
    ("KMTC", "Korea Marine Transport", "INDEPENDENT"),
    ("MATSON", "Matson Navigation", "INDEPENDENT"),
    ("SEABOARD MARINE", "Seaboard Marine", "INDEPENDENT"),
    ("GRIMALDI", "Grimaldi Lines", "INDEPENDENT"),
    ("ARKAS", "Arkas Line", "INDEPENDENT"),
    ("SAFMARINE", "Safmarine", "INDEPENDENT"),
    ("EMIRATES SHIPPING LINE", "Emirates Shipping Line", "INDEPENDENT"),
    ("IRISL", "Islamic Republic of Iran Shipping Lines", "INDEPENDENT"),
]

# FIXED VALUES: cargo type, incoterm.  Other cargo is FOB.
INCOTERMS = [
    ("Electronics", "CIF"),
    ("Semiconductors", "CIF"),
    ("Telecommunications Equipment", "CIF"),
    ("Machinery", "CFR"),
    ("Industrial Equipment", "CFR"),
    ("Mining Equipment", "CFR"),
    ("Renewable Energy Components", "CFR"),
    ("Automotive Parts", "CFR"),
    ("Vehicles", "CFR"),
    ("Food", "CIF"),
    ("Frozen Food", "CIF"),
    ("Beverages", "CIF"),
    ("Agricultural Products", "CIF"),
    ("Pharmaceuticals", "CIF"),
    ("Medical Equipment", "CIF"),
    ("Chemicals", "CFR"),
    ("Petrochemicals", "CFR"),
    ("Textiles", "FOB"),
    ("Garments", "FOB"),
    ("Footwear", "FOB"),
    ("Furniture", "FOB"),
    ("Consumer Goods", "FOB"),
    ("Household Products", "FOB"),
    ("Construction Materials", "FOB"),
    ("Steel Products", "FOB"),
    ("Paper Products", "FOB"),
    ("Plastic Resins", "FOB"),
    ("Rubber Products", "FOB"),
    ("Solar Panels", "CIF"),
    ("Batteries", "CIF"),
]


def values(rows: list[tuple[str, ...]]) -> str:
    return "values " + ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


cte("dim_carrier", f"""
select md5(carrier_code) carrier_key, carrier_code, coalesce(full_name, carrier_code) carrier_name,
  coalesce(grouping, 'INDEPENDENT') alliance
from (select distinct carrier_code from stg_shipments) codes
left join ({values(CARRIERS)}) listed(carrier_code, full_name, grouping) using (carrier_code)""")

cte("dim_shipment", f"""
select md5(shipment_id) shipment_key, shipment_id, bl_number, origin_port_code, dest_port_code,
  carrier_code, cargo_type, commodity_code, coalesce(term, 'FOB') incoterm, declared_value_usd
from stg_shipments left join ({values(INCOTERMS)}) listed(cargo_type, term) using (cargo_type)""")

cte("dim_customs_entry", """
select md5(entry_number) customs_key, entry_number, shipment_id, bl_number, commodity_code, entry_type,
  declared_value_usd, tariff_rate_pct, duties_usd, vat_usd, total_tax_usd, lodge_date, assessment_date,
  release_date, processing_days, payment_mode, port_code
from stg_customs_entries where entry_number is not null""")

# ------------------------------------------------------------------- facts
# Keys are functions of the codes; a scalar subquery says whether the dimension has them.
def key_in(dim: str, key: str, code: str, value: str) -> str:
    return f"(select any_value({key}) from {dim} where {dim}.{code} = {value})"


def in_calendar(ts: str) -> str:
    return f"case when year({ts}) between 2020 and 2030 then cast({ts} as date) end"


cte("fct_port_dwell", f"""
select md5(vessel_imo || strftime(ifnull(berth_ts, arrival_ts), '%Y-%m-%d %H:%M:%S.%g')) dwell_key,
  vessel_imo, md5(vessel_imo) vessel_key, {in_calendar('arrival_ts')} arrival_date_key, berth_ts, cargo_type,
  {key_in('dim_port', 'port_key', 'port_code', 'calls.port_code')} port_key,
  {key_in('dim_port', 'cell_res5', 'port_code', 'calls.port_code')} port_cell_res5,
  dwell_hours, anchorage_wait_h, teu_count, ifnull(anchorage_wait_h, 0) > 24 is_congested, _loaded_at
from stg_vessel_calls calls""")

cte("fct_shipment_events", f"""
select shipment_id, md5(shipment_id) shipment_key, md5(carrier_code) carrier_key,
  {key_in('dim_port', 'port_key', 'port_code', 'moves.origin_port_code')} origin_port_key,
  {key_in('dim_port', 'port_key', 'port_code', 'moves.dest_port_code')} dest_port_key,
  {in_calendar('etd')} etd_date_key, {in_calendar('eta')} eta_date_key, {in_calendar('ata')} ata_date_key,
  etd, eta, ata, delay_hours, delay_category,
  if(ata is null, 'IN_TRANSIT', 'ARRIVED_' || if(delay_hours = 0, 'ON_TIME',
     if(delay_category in ('MINOR_DELAY', 'MODERATE_DELAY'), delay_category, 'SEVERE_DELAY'))) event_type,
  declared_value_usd, freight_usd, insurance_usd, _loaded_at
from stg_shipments moves""")

cte("fx_filled", f"""
select s.shipment_id,
  max(case when f.rate_date <= coalesce(cast(s.eta as date), {AS_OF_DATE}) then f.usd_php_close end) usd_php_rate
from stg_shipments s cross join usd_php_rates f
group by s.shipment_id""")

cte("fx_asof", f"""
select s.shipment_id, f.usd_php_close usd_php_rate
from (select shipment_id, coalesce(cast(eta as date), {AS_OF_DATE}) anchor from stg_shipments) s
asof left join usd_php_rates f on s.anchor >= f.rate_date""")


def landed_cost_sql(rates: str) -> str:
    """Amounts step by step: CIF, duty on CIF, VAT on both, pesos."""
    return f"""
select shipment_id, bl_number, dest_port_code, cast(eta as date) eta_date_key, declared_value_usd, freight_usd,
  insurance_usd, cast(cif as decimal(17,2)) cif_usd, cast(pct as decimal(5,2)) duty_rate_pct,
  cast(round(cif * pct * 0.01, 2) as decimal(17,2)) duties_usd,
  cast(round(cif * (100 + pct) * 0.0012, 2) as decimal(17,2)) vat_usd,
  cast(round(cif * (100 + pct) * 0.0112 * pesos, 2) as decimal(22,2)) total_landed_cost_php,
  pesos usd_php_rate, _loaded_at
from (select *, cast(declared_value_usd + freight_usd + insurance_usd as decimal(30,2)) cif,
        ifnull((select any_value(mfn_rate_pct) from ph_tariff_rates t where t.commodity_code = moves.commodity_code), 0) pct,
        cast(ifnull((select any_value(usd_php_rate) from {rates} r where r.shipment_id = moves.shipment_id), 56)
          as decimal(8,4)) pesos
      from stg_shipments moves) amounts"""


cte("fct_landed_cost", landed_cost_sql("fx_filled"))
cte("fct_landed_cost_asof", landed_cost_sql("fx_asof"))


# ------------------------------------------------------------------- marts
def share(condition: str) -> str:
    """Percentage of the group's rows."""
    return f"round(100 * count(*) filter ({condition})::double / count(*), 1)"


def mean(x: str, digits: int) -> str:
    return f"round(sum({x})::double / count({x}), {digits})"


cte("carrier_performance", f"""
select lane.*, port_name dest_port_name
from (select carrier_code, carrier_name, alliance, origin_port_code, dest_port_code, origin_port_code origin_port_name,
        dest_port_key,
        count(*) total_shipments, {share("delay_category = 'ON_TIME'")} on_time_pct,
        count(*) filter (delay_category = 'MINOR_DELAY') minor_delay_count,
        count(*) filter (delay_category = 'MODERATE_DELAY') moderate_delay_count,
        count(*) filter (delay_category = 'SEVERE_DELAY') severe_delay_count,
        {mean('delay_hours', 1)} avg_delay_hours, {mean('nullif(delay_hours, 0)', 1)} avg_delay_hours_when_late,
        max(delay_hours) max_delay_hours,
        round(quantile_cont(delay_hours::double, 0.5), 6) p50_delay_hours,
        round(quantile_cont(delay_hours::double, 0.9), 6) p90_delay_hours,
        round(sum(delay_hours * declared_value_usd)::double / nullif(sum(declared_value_usd)::double, 0), 1)
          value_weighted_delay_hours
      from fct_shipment_events
      natural join (select carrier_key, carrier_code, carrier_name, alliance from dim_carrier) carriers
      natural join (select shipment_key, origin_port_code, dest_port_code from dim_shipment) routes
      group by all) lane
left join (select port_key dest_port_key, port_name from dim_port) ports using (dest_port_key)""".replace("lane.*", "lane.* exclude (dest_port_key)"))

cte("port_days", f"""
select port_key, arrival_date_key, count(*) vessel_calls, sum(teu_count)::bigint total_teu,
  {mean('teu_count', 0)} avg_teu_per_call, sum(dwell_hours)::double / count(dwell_hours) dwell,
  min(dwell_hours) min_dwell_hours, max(dwell_hours) max_dwell_hours,
  round(quantile_cont(dwell_hours::double, 0.5), 6) p50_dwell_hours,
  round(quantile_cont(dwell_hours::double, 0.9), 6) p90_dwell_hours,
  {mean('anchorage_wait_h', 1)} avg_anchorage_wait_hours,
  count(*) filter (is_congested) congested_vessel_calls, {share('is_congested')} congestion_rate_pct
from fct_port_dwell group by all""")

cte("port_throughput_daily", """
select port_code, port_name, region, port_type, date_key report_date, year_num, month_num, week_num, year_month,
  days.* exclude (port_key, arrival_date_key, dwell), round(dwell, 1) avg_dwell_hours,
  round(avg(dwell) over (partition by port_code order by date_key rows 6 preceding), 1) rolling_7d_avg_dwell_hours
from dim_port, dim_date, port_days days
where days.port_key = dim_port.port_key and days.arrival_date_key = dim_date.date_key""")

cte("customs_clearance_kpi", f"""
select port_code, (select any_value(port_name) from dim_port where dim_port.port_code = kpi.port_code) port_name,
  kpi.* exclude (port_code)
from (select port_code, entry_type, payment_mode, count(*) total_entries, {mean('processing_days', 1)} avg_processing_days,
        min(processing_days) min_processing_days, max(processing_days) max_processing_days,
        round(quantile_cont(processing_days::double, 0.5), 6) p50_processing_days,
        round(quantile_cont(processing_days::double, 0.9), 6) p90_processing_days,
        count(*) filter (processing_days > 5) sla_breach_count, {share('processing_days > 5')} sla_breach_pct,
        count(*) filter (processing_days < 3) fast_count,
        count(*) filter (processing_days between 3 and 5) standard_count,
        count(*) filter (processing_days between 6 and 10) slow_count,
        count(*) filter (processing_days is null or processing_days > 10) critical_count,
        {mean('tariff_rate_pct', 2)} avg_tariff_rate_pct, {mean('total_tax_usd', 2)} avg_total_tax_usd,
        sum(total_tax_usd)::decimal(38,2) total_tax_collected_usd, {mean('declared_value_usd', 2)} avg_declared_value_usd
      from dim_customs_entry group by all) kpi""")

cte("commodity_cost_summary", f"""
select commodity_code, (select any_value(description) from ph_tariff_rates t where t.commodity_code = costs.commodity_code)
    commodity_desc, cargo_type, dest_port_code,
  (select any_value(port_name) from dim_port where dim_port.port_code = costs.dest_port_code) dest_port_name,
  costs.* exclude (commodity_code, cargo_type, dest_port_code),
  (select max(atiga_rate_pct) from ph_tariff_rates t where t.commodity_code = costs.commodity_code)
    atiga_preferential_rate_pct
from (select commodity_code, cargo_type, dest_port_code, count(*) shipment_count, {mean('cif_usd', 2)} avg_cif_usd,
        {mean('duties_usd', 2)} avg_duties_usd, {mean('vat_usd', 2)} avg_vat_usd,
        {mean('cif_usd + duties_usd + vat_usd', 2)} avg_total_tax_inclusive_usd,
        {mean('total_landed_cost_php', 2)} avg_landed_cost_php,
        sum(total_landed_cost_php)::decimal(38,2) total_landed_cost_php,
        min(total_landed_cost_php) min_landed_cost_php, max(total_landed_cost_php) max_landed_cost_php,
        round(quantile_cont(total_landed_cost_php::double, 0.5), 6) p50_landed_cost_php,
        {mean('duty_rate_pct', 2)} avg_duty_rate_pct,
        round(100 * avg((duties_usd + vat_usd)::double / nullif((cif_usd + duties_usd + vat_usd)::double, 0)), 1)
          avg_tax_burden_pct,
        {mean('usd_php_rate', 4)} avg_usd_php_rate
      from fct_landed_cost natural join (select shipment_id, commodity_code, cargo_type from dim_shipment) cargo
      group by all) costs""")

# Calls and expected arrivals as one list of things that happen in a port's week.
cte("port_weeks", """
select port_key, day - cast(isodow(day) - 1 as int) week_start_date, is_call, teu, wait, dwell, congested, delay, category
from (select port_key, arrival_date_key as day, true is_call, teu_count teu, anchorage_wait_h wait, dwell_hours dwell,
        is_congested congested, null delay, null category from fct_port_dwell
      union all
      select dest_port_key, eta_date_key, false, null, null, null, null, delay_hours, delay_category
      from fct_shipment_events) happenings
where port_key is not null""")

cte("congestion_delay_impact", """
select port_code, port_name, week_start_date, vessel_calls, total_teu_handled, avg_anchorage_wait_hours, avg_dwell_hours,
  congestion_rate_pct, nullif(arriving, 0) shipments_arriving, avg_shipment_delay_hours, on_time_rate_pct,
  if(arriving > 0, severe, null) severe_delay_count,
  list_extract(['NORMAL', 'MODERATE', 'HIGH', 'CRITICAL'], 1 + (congestion_rate_pct >= 15)::int
    + (congestion_rate_pct >= 35)::int + (congestion_rate_pct >= 60)::int) congestion_level,
  round(avg_shipment_delay_hours / nullif(avg_anchorage_wait_hours, 0), 2) delay_to_wait_ratio
from dim_port join (
  select port_key, week_start_date, count(*) filter (is_call) vessel_calls, sum(teu)::bigint total_teu_handled,
    round(avg(wait), 1) avg_anchorage_wait_hours, round(avg(dwell), 1) avg_dwell_hours,
    round(100 * count(*) filter (congested)::double / nullif(count(*) filter (is_call), 0), 1) congestion_rate_pct,
    count(*) filter (not is_call) arriving, round(avg(delay), 1) avg_shipment_delay_hours,
    round(100 * count(*) filter (category = 'ON_TIME')::double / nullif(count(*) filter (not is_call), 0), 1)
      on_time_rate_pct,
    count(*) filter (category = 'SEVERE_DELAY') severe
  from port_weeks group by all) weeks using (port_key)
where vessel_calls > 0""")

cte("port_pairs", f"""
select p.port_key key_a, p.port_code, p.port_name, p2.port_key key_b, p2.port_code alt_port_code,
  p2.port_name alt_name, round({haversine('p.lat', 'p.lon', 'p2.lat', 'p2.lon')}, 6) distance_km,
  {haversine('p.lat', 'p.lon', 'p2.lat', 'p2.lon')} raw_km
from dim_port p join dim_port p2 on p2.port_key != p.port_key""")

cte("port_catchment_area", """
select s.shipment_id, pp.port_code dest_port_code, pp.port_name, pp.distance_km, pp.alt_name nearest_alt_port
from fct_shipment_events s join port_pairs pp on s.dest_port_key = pp.key_a
where pp.raw_km <= 200 and s.delay_category in ('MODERATE_DELAY', 'SEVERE_DELAY')""")

_NAME = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(sql: str) -> list[str]:
    return [w for w in dict.fromkeys(_NAME.findall(sql)) if w in CTES]


def with_ctes(final_sql: str) -> str:
    """``WITH`` every CTE the statement needs (transitively), in order."""
    order: list[str] = []

    def visit(name: str, stack: tuple = ()) -> None:
        if name in order or name in stack:
            return
        for dep in _deps(CTES[name]):
            if dep != name:
                visit(dep, stack + (name,))
        order.append(name)

    for dep in _deps(final_sql):
        visit(dep)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in order)
    return f"WITH {body}\n{final_sql}"


def model(name: str, columns: str = "*") -> str:
    return with_ctes(f"SELECT {columns} FROM {name}")


def model_over(name: str, source: str, instead: str) -> str:
    """``model`` with the CTE ``source`` replaced by ``instead``, which may read the
    replaced one as ``given``."""
    own = CTES[source]
    CTES["given"], CTES[source] = own, instead
    try:
        return model(name)
    finally:
        CTES[source] = own
        del CTES["given"]


REDELIVERED = """
select * from given where cast(substr(shipment_id, 2) as bigint) % 7 <> 0
union all
select * replace ('Vehicles' as cargo_type, eta + interval 30 hours as ata, _loaded_at + interval 10 years as _loaded_at,
  'nation_' || cast((cast(substr(shipment_id, 2) as bigint) + 1) % 26 as varchar) as dest_port)
from given where cast(substr(shipment_id, 2) as bigint) % 7 = 0"""
