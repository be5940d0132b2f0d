"""DuckDB oracle SQL for checks, monitoring, dashboards and single reports."""

from __future__ import annotations

from . import catalogue as q
from .models import AS_OF_DATE, AS_OF_TS, cnt, cte, hb, pct, pctl, rnd, share, with_ctes

SQL: dict[str, str] = {}
RAW: dict[str, str] = {}


def _lst(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


def add(name: str, sql: str) -> None:
    RAW[name] = sql
    SQL[name] = with_ctes(sql)


# ------------------------------------------------------------ live twins
cte("active_shipments", f"""
select s.shipment_id, s.bl_number, s.origin_port_code, s.dest_port_code, s.carrier_code, s.eta,
  s.delay_hours, s.delay_category, p.port_name dest_port_name, p.lat dest_lat, p.lon dest_lon,
  {hb(AS_OF_TS, 's.eta')} hours_to_eta
from (select * from stg_shipments
      qualify row_number() over (partition by shipment_id order by _loaded_at desc) = 1) s
left join dim_port p on s.dest_port_code = p.port_code
where s.ata is null""")

cte("port_congestion_24h", f"""
select p.port_code, p.port_name, p.lat, p.lon, count(*) vessels_in_port,
  {rnd('avg(v.anchorage_wait_h)', 1)} avg_wait_hours,
  {cnt('coalesce(v.anchorage_wait_h > 24, false)')} congested_vessels,
  {pct(cnt('coalesce(v.anchorage_wait_h > 24, false)'))} congestion_pct,
  case when {pct(cnt('coalesce(v.anchorage_wait_h > 24, false)'))} >= 60 then 'CRITICAL'
       when {pct(cnt('coalesce(v.anchorage_wait_h > 24, false)'))} >= 35 then 'HIGH'
       when {pct(cnt('coalesce(v.anchorage_wait_h > 24, false)'))} >= 15 then 'MODERATE'
       else 'NORMAL' end congestion_level
from stg_vessel_calls v join dim_port p on v.port_code = p.port_code
where v.arrival_ts > (select max(arrival_ts) from stg_vessel_calls) - interval 24 hours
  and v.arrival_ts <= (select max(arrival_ts) from stg_vessel_calls)
group by p.port_code, p.port_name, p.lat, p.lon""")

add("active_shipments", "select * from active_shipments")
add("port_congestion_24h", "select * from port_congestion_24h")

# ------------------------------------------------------------ single ops
add("fx_max_to_date", """
select s.shipment_id, cast(s.eta as date) eta_date, f.usd_php_rate
from stg_shipments s join fx_filled f on s.shipment_id = f.shipment_id""")

add("fx_asof", """
select s.shipment_id, cast(s.eta as date) eta_date, f.usd_php_rate
from stg_shipments s join fx_asof f on s.shipment_id = f.shipment_id""")

add("fct_landed_cost_asof", "select * from fct_landed_cost_asof")

add("delay_bands", f"""
select delay_category, count(*) shipments,
  min({hb('eta', 'ata')}) min_raw_hours, max({hb('eta', 'ata')}) max_raw_hours,
  {cnt('ata is null')} in_transit, {cnt(hb('eta', 'ata') + ' < 0')} early_arrivals
from stg_shipments group by delay_category""")

add("join_inner_dim", """
select p.port_code, p.port_name, count(*) shipments, count(distinct s.carrier_key) carriers
from fct_shipment_events s join dim_port p on s.dest_port_key = p.port_key
group by p.port_code, p.port_name""")

add("percentiles", f"""
select p.port_code, count(*) calls, {pctl('f.dwell_hours', 0.5)} p50_dwell_hours,
  {pctl('f.dwell_hours', 0.9)} p90_dwell_hours, {pctl('f.anchorage_wait_h', 0.5)} p50_wait_hours,
  {pctl('f.anchorage_wait_h', 0.9)} p90_wait_hours
from fct_port_dwell f join dim_port p on f.port_key = p.port_key group by p.port_code""")

add("rolling_7d_dwell", """
select port_code, report_date, vessel_calls, avg_dwell_hours, rolling_7d_avg_dwell_hours
from port_throughput_daily""")

add("weekly_bucket", f"""
select port_code, port_name, week_start_date, count(*) vessel_calls, round(avg(wait), 1) avg_anchorage_wait_hours,
  round(avg(dwell), 1) avg_dwell_hours, {share('congested')} congestion_rate_pct, sum(teu)::bigint total_teu_handled
from port_weeks join dim_port using (port_key) where is_call group by port_code, port_name, week_start_date""")

add("geo_cell_heatmap", f"""
select f.port_cell_res5 cell_id, count(*) vessel_calls, cast(sum(f.teu_count) as bigint) total_teu,
  {rnd('avg(f.dwell_hours)', 1)} avg_dwell_hours, {cnt('f.is_congested')} congested_calls
from fct_port_dwell f where f.port_cell_res5 is not null group by f.port_cell_res5""")

add("port_distance", """
select port_code, alt_port_code, distance_km from port_pairs where raw_km <= 200""")

add("customs_tax_recompute", """
select entry_number, shipment_id, declared_value_usd, tariff_rate_pct, duties_usd, vat_usd, total_tax_usd,
  expected_duties_usd, expected_vat_usd,
  cast(expected_duties_usd + expected_vat_usd as decimal(17,2)) expected_total_tax_usd,
  duties_usd <> expected_duties_usd duties_mismatch, vat_usd <> expected_vat_usd vat_mismatch,
  total_tax_usd <> cast(expected_duties_usd + expected_vat_usd as decimal(17,2)) total_mismatch
from (select *, cast(round((declared_value_usd + expected_duties_usd) * 0.12, 2) as decimal(17,2)) expected_vat_usd
      from (select *, cast(round(declared_value_usd * tariff_rate_pct * 0.01, 2) as decimal(17,2)) expected_duties_usd
            from stg_customs_entries) a) c
where duties_usd <> expected_duties_usd or vat_usd <> expected_vat_usd
   or total_tax_usd <> cast(expected_duties_usd + expected_vat_usd as decimal(17,2))""")

# --------------------------------------------------------------- quality
_nn = []
for m, cols in q.NOT_NULL.items():
    parts = []
    for c in cols:
        where = q.NOT_NULL_WHERE.get((m, c))
        cond = f"{c} is null" + (f" and {where}" if where else "")
        parts.append(f"select '{m}' model, '{c}' column_name, "
                     f"cast(coalesce(sum(case when {cond} then 1 else 0 end), 0) as bigint) failing_rows from {m}")
    _nn += parts
add("dq_not_null", "\nunion all\n".join(_nn))

add("dq_unique", "\nunion all\n".join(
    f"""select '{m}' model, '{c}' column_name, cast(count(*) as bigint) failing_values,
  cast(coalesce(sum(n), 0) as bigint) failing_rows
from (select {c}, count(*) n from {m} where {c} is not null group by {c} having count(*) > 1) x"""
    for m, cols in q.UNIQUE.items() for c in cols))

add("dq_accepted_values", "\nunion all\n".join(
    f"""select '{m}' model, '{c}' column_name, cast(count(*) as bigint) failing_values,
  cast(coalesce(sum(n), 0) as bigint) failing_rows
from (select {c}, count(*) n from {m} group by {c}) x where {c} not in ({_lst(vals)})"""
    for m, c, vals in q.ACCEPTED))

add("dq_expression", "\nunion all\n".join(
    f"""select '{m}' model, '{c}' column_name, '{e}' expression,
  cast(coalesce(sum(case when not ({c} {e}) then 1 else 0 end), 0) as bigint) failing_rows from {m}"""
    for m, c, e in q.EXPRESSIONS))

add("dq_singular_dwell", "select * from fct_port_dwell where dwell_hours < 0")

add("dq_grain", "\nunion all\n".join(
    f"""select '{m}' model, '{",".join(keys)}' grain, cast(count(*) as bigint) duplicate_keys,
  cast(coalesce(sum(n), 0) as bigint) rows_in_duplicates
from (select {", ".join(keys)}, count(*) n from {m} group by {", ".join(keys)} having count(*) > 1) x"""
    for m, keys in q.GRAINS.items()))


def _fresh(name: str, table: str) -> str:
    age = f"date_diff('second', max(_loaded_at), {AS_OF_TS}) / 3600.0"
    return f"""select '{name}' source_table, max(_loaded_at) max_loaded_at, round({age}, 2) age_hours,
  case when {age} > 24 then 'ERROR' when {age} > 8 then 'WARN' else 'OK' end freshness_status from {table}"""


add("source_freshness", "\nunion all\n".join(
    _fresh(n, n) for n in ["raw_vessel_calls", "raw_shipments", "raw_customs_entries"]))

add("outliers_iqr", "\nunion all\n".join(
    f"""select '{label}' column_check, q1, q3, q1 - 1.5 * (q3 - q1) lower_fence, q3 + 1.5 * (q3 - q1) upper_fence,
  cast(coalesce(sum(case when v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1) then 1 else 0 end), 0)
    as bigint) outlier_count, count(v) checked_rows
from (select cast({c} as double) v from {t}) x,
  (select quantile_cont(cast({c} as double), 0.25) q1, quantile_cont(cast({c} as double), 0.75) q3 from {t}) qq
group by q1, q3"""
    for label, t, c in [("fct_port_dwell.dwell_hours", "fct_port_dwell", "dwell_hours"),
                        ("fct_shipment_events.delay_hours", "fct_shipment_events", "delay_hours")]))

# ------------------------------------------------------------ monitoring


def _bronze_fresh(name, table):
    h = hb("max(_loaded_at)", AS_OF_TS)
    return f"""select '{name}' table_name, max(_loaded_at) latest_load_ts, {h} hours_since_load,
  case when {h} > {q.CRITICAL_HOURS} then 'CRITICAL' when {h} > {q.STALE_HOURS} then 'STALE' else 'OK' end
    freshness_status from {table}"""


add("bronze_freshness", "\nunion all\n".join(_bronze_fresh(f"bronze.{t}", t)
                                           for t in ["raw_vessel_calls", "raw_shipments", "raw_customs_entries"]))

add("fact_freshness", "\nunion all\n".join(
    f"select 'gold.{t}' table_name, max(_loaded_at) latest_load_ts, {hb('max(_loaded_at)', AS_OF_TS)} hours_since_load from {t}"
    for t in ["fct_port_dwell", "fct_shipment_events", "fct_landed_cost"]))

_LAYERS = [("bronze.raw_vessel_calls", "raw_vessel_calls"), ("bronze.raw_shipments", "raw_shipments"),
           ("bronze.raw_customs_entries", "raw_customs_entries"),
           ("silver.stg_vessel_calls", "stg_vessel_calls"), ("silver.stg_shipments", "stg_shipments"),
           ("silver.stg_customs_entries", "stg_customs_entries"), ("gold.dim_port", "dim_port"),
           ("gold.dim_vessel", "dim_vessel"), ("gold.dim_carrier", "dim_carrier"),
           ("gold.dim_shipment", "dim_shipment"), ("gold.dim_customs_entry", "dim_customs_entry"),
           ("gold.fct_port_dwell", "fct_port_dwell"), ("gold.fct_shipment_events", "fct_shipment_events"),
           ("gold.fct_landed_cost", "fct_landed_cost"), ("gold.carrier_performance", "carrier_performance"),
           ("gold.port_throughput_daily", "port_throughput_daily"),
           ("gold.customs_clearance_kpi", "customs_clearance_kpi"),
           ("gold.commodity_cost_summary", "commodity_cost_summary"),
           ("gold.congestion_delay_impact", "congestion_delay_impact"),
           ("gold.port_catchment_area", "port_catchment_area"),
           ("realtime.dt_active_shipments", "active_shipments"),
           ("realtime.dt_port_congestion", "port_congestion_24h")]
add("row_counts", "\nunion all\n".join(f"select '{n}' table_name, count(*) row_count from {t}" for n, t in _LAYERS))

add("layer_retention", """
select round(silver_vessel / nullif(bronze_vessel, 0) * 100, 2) vessel_bronze_to_silver_pct,
  round(silver_shipments / nullif(bronze_shipments, 0) * 100, 2) shipment_bronze_to_silver_pct,
  round(silver_customs / nullif(bronze_customs, 0) * 100, 2) customs_bronze_to_silver_pct,
  round(gold_dwell / nullif(silver_vessel, 0) * 100, 2) vessel_silver_to_gold_pct,
  round(gold_shipments / nullif(silver_shipments, 0) * 100, 2) shipment_silver_to_gold_pct,
  round(gold_landed / nullif(silver_shipments, 0) * 100, 2) landed_silver_to_gold_pct
from (select (select count(*) from raw_vessel_calls) bronze_vessel,
        (select count(*) from raw_shipments) bronze_shipments,
        (select count(*) from raw_customs_entries) bronze_customs,
        (select count(*) from stg_vessel_calls) silver_vessel,
        (select count(*) from stg_shipments) silver_shipments,
        (select count(*) from stg_customs_entries) silver_customs,
        (select count(*) from fct_port_dwell) gold_dwell,
        (select count(*) from fct_shipment_events) gold_shipments,
        (select count(*) from fct_landed_cost) gold_landed) c""")

add("daily_load_volume", "\nunion all\n".join(
    f"""select '{n}' table_name, cast(_loaded_at as date) load_date, count(*) rows_loaded from {t}
where _loaded_at >= cast({AS_OF_DATE} - 14 as timestamp) group by cast(_loaded_at as date)"""
    for n, t in [("bronze.raw_vessel_calls", "raw_vessel_calls"), ("bronze.raw_shipments", "raw_shipments")]))

add("null_rates", "\nunion all\n".join(
    f"select '{t}.{c}' column_check, round(sum(case when {c} is null then 1 else 0 end) / count(*) * 100, 2) null_pct from {t}"
    for t, c in [("raw_vessel_calls", "vessel_imo"), ("raw_vessel_calls", "arrival_ts"),
                 ("raw_shipments", "shipment_id"), ("raw_shipments", "eta"),
                 ("raw_customs_entries", "entry_number"), ("raw_customs_entries", "shipment_id")]))

add("duplicate_keys", "\nunion all\n".join(
    f"select '{n}' check_name, cast(count(*) - count(distinct {c}) as bigint) duplicate_count from {t}"
    for n, t, c in [("raw_shipments.shipment_id duplicates", "raw_shipments", "shipment_id"),
                    ("raw_customs_entries.entry_number duplicates", "raw_customs_entries", "entry_number"),
                    ("gold.fct_shipment_events.shipment_id duplicates", "fct_shipment_events", "shipment_id"),
                    ("gold.fct_landed_cost.shipment_id duplicates", "fct_landed_cost", "shipment_id"),
                    ("gold.dim_port.port_code duplicates", "dim_port", "port_code"),
                    ("gold.dim_vessel.vessel_imo duplicates", "dim_vessel", "vessel_imo")]))

_RANGE = [("fct_port_dwell: negative dwell_hours", "fct_port_dwell", "dwell_hours < 0"),
          ("fct_port_dwell: zero dwell_hours", "fct_port_dwell", "dwell_hours = 0"),
          ("fct_port_dwell: anchorage_wait_h > dwell_hours (impossible)", "fct_port_dwell",
           "anchorage_wait_h > dwell_hours"),
          ("fct_shipment_events: negative delay_hours", "fct_shipment_events", "delay_hours < 0"),
          ("fct_shipment_events: ATA before ETA but delay_hours > 0", "fct_shipment_events",
           "ata < eta and delay_hours > 0"),
          ("fct_landed_cost: total_landed_cost_php <= 0", "fct_landed_cost", "total_landed_cost_php <= 0"),
          ("fct_landed_cost: duties_usd > cif_usd (duty rate > 100%)", "fct_landed_cost", "duties_usd > cif_usd"),
          ("dim_customs_entry: negative processing_days", "dim_customs_entry", "processing_days < 0"),
          ("dim_customs_entry: release_date before lodge_date", "dim_customs_entry", "release_date < lodge_date")]
add("range_checks", "\nunion all\n".join(
    f"select '{n}' check_name, count(*) violation_count from {t} where {p}" for n, t, p in _RANGE))

_ACC = [("stg_vessel_calls: invalid cargo_type", "stg_vessel_calls", "cargo_type", q.MONITORED_CARGO),
        ("stg_shipments: invalid delay_category", "stg_shipments", "delay_category", q.DELAY_CATEGORIES),
        ("stg_customs_entries: invalid entry_type", "stg_customs_entries", "entry_type", q.MONITORED_ENTRY_TYPES),
        ("stg_customs_entries: invalid payment_mode", "stg_customs_entries", "payment_mode", q.MONITORED_PAYMENT_MODES),
        ("congestion_delay_impact: invalid congestion_level", "congestion_delay_impact", "congestion_level",
         q.CONGESTION_LEVELS)]
add("accepted_value_violations", "\nunion all\n".join(
    f"select '{n}' check_name, count(*) violation_count from {t} where {c} not in ({_lst(v)})"
    for n, t, c, v in _ACC))

_ORPH = [("fct_shipment_events → dim_shipment orphans", "fct_shipment_events", "dim_shipment", "shipment_key", "shipment_key"),
         ("fct_port_dwell → dim_port orphans", "fct_port_dwell", "dim_port", "port_key", "port_key"),
         ("fct_port_dwell → dim_vessel orphans", "fct_port_dwell", "dim_vessel", "vessel_key", "vessel_key"),
         ("fct_landed_cost → dim_shipment orphans", "fct_landed_cost", "dim_shipment", "shipment_id", "shipment_id"),
         ("stg_customs_entries → stg_shipments FK orphans", "stg_customs_entries", "stg_shipments", "shipment_id",
          "shipment_id")]
add("orphans", "\nunion all\n".join(
    f"select '{n}' check_name, count(*) orphan_count from {c} f left join {p} s on f.{ck} = s.{pk} where s.{pk} is null"
    for n, c, p, ck, pk in _ORPH))

add("tariff_coverage", """
select s.commodity_code, count(*) shipment_count, 'no tariff rate match — duty defaults to 0%' note
from stg_shipments s left join ph_tariff_rates t on s.commodity_code = t.commodity_code
where t.commodity_code is null group by s.commodity_code""")

add("fx_coverage", """
select count(*) shipments_missing_fx_rate, min(cast(s.eta as date)) earliest_eta,
  (select min(rate_date) from usd_php_rates) earliest_fx_date
from stg_shipments s where cast(s.eta as date) < (select min(rate_date) from usd_php_rates)""")

add("delay_distribution", """
select delay_category, count(*) shipment_count,
  round(count(*) / sum(count(*)) over () * 100, 1) pct_of_total
from fct_shipment_events group by delay_category""")

add("port_congestion_rate", f"""
select p.port_code, p.port_name, count(*) total_calls, {cnt('f.is_congested')} congested_calls,
  {pct(cnt('f.is_congested'))} congestion_rate_pct, {rnd('avg(f.dwell_hours)', 1)} avg_dwell_hours,
  {rnd('avg(f.anchorage_wait_h)', 1)} avg_anchorage_wait_hours
from fct_port_dwell f join dim_port p on f.port_key = p.port_key group by p.port_code, p.port_name""")

add("carrier_on_time", f"""
select c.carrier_code, c.carrier_name, c.alliance, count(*) total_shipments,
  {pct(cnt("f.delay_category = 'ON_TIME'"))} on_time_pct, {rnd('avg(f.delay_hours)', 1)} avg_delay_hours
from fct_shipment_events f join dim_carrier c on f.carrier_key = c.carrier_key
group by c.carrier_code, c.carrier_name, c.alliance""")

add("cost_by_cargo_type", """
select s.cargo_type, count(*) shipment_count,
  round(cast(sum(lc.cif_usd) as double) / count(lc.cif_usd), 2) avg_cif_usd,
  round(cast(sum(lc.duty_rate_pct) as double) / count(lc.duty_rate_pct), 2) avg_duty_rate_pct,
  round(cast(sum(lc.total_landed_cost_php) as double) / count(lc.total_landed_cost_php), 2) avg_landed_cost_php,
  round(cast(sum(lc.usd_php_rate) as double) / count(lc.usd_php_rate), 4) avg_fx_rate
from fct_landed_cost lc join dim_shipment s on lc.shipment_id = s.shipment_id group by s.cargo_type""")

add("customs_time_by_type", f"""
select entry_type, payment_mode, count(*) entry_count, {rnd('avg(processing_days)', 1)} avg_processing_days,
  min(processing_days) min_processing_days, max(processing_days) max_processing_days,
  {cnt('processing_days > 5')} sla_breach_count
from dim_customs_entry group by entry_type, payment_mode""")

add("rt_sanity", """
select 'dt_active_shipments row count' check_name, count(*) value from active_shipments
union all select 'dt_active_shipments: severe delays', count(*) from active_shipments
  where delay_category = 'SEVERE_DELAY'
union all select 'dt_port_congestion row count', count(*) from port_congestion_24h
union all select 'dt_port_congestion: CRITICAL ports', count(*) from port_congestion_24h
  where congestion_level = 'CRITICAL'""")

cte("metering_log", """
select ts start_time, upper(event_type) group_name,
  case when event_type = 'error' then 0.0 else value end credits_used from events""")
cte("query_log", """
select 'q' || cast(event_id as varchar) query_id,
  'SELECT /* ' || event_type || ' */ * FROM t' || cast(event_id % 13 as varchar) || ' WHERE user_id = '
    || cast(user_id as varchar) query_text,
  upper(event_type) group_name, cast(value * 1000 as bigint) total_elapsed_ms,
  cast(value * 100 as bigint) compilation_ms, cast(value * 900 as bigint) execution_ms,
  event_id * 4096 + user_id bytes_scanned, event_id % 1000 rows_produced,
  cast(json_extract_string(props, '$.k') as bigint) partitions_scanned, cast(100 as bigint) partitions_total,
  ts start_time
from events""")
cte("refresh_log", """
select case when event_id % 2 = 0 then 'DT_ACTIVE_SHIPMENTS' else 'DT_PORT_CONGESTION' end table_name,
  ts start_time, value * 0.001 credits_used from events""")

add("usage_daily", f"""
select cast(start_time as date) usage_date, group_name, round(sum(credits_used), 4) credits_used,
  count(*) query_count
from metering_log where start_time >= cast({AS_OF_DATE} - 30 as timestamp)
group by cast(start_time as date), group_name""")

add("slow_query_topk", f"""
select query_id, query_text, group_name, round(total_elapsed_ms / 1000, 1) elapsed_seconds,
  round(compilation_ms / 1000, 1) compile_seconds, round(execution_ms / 1000, 1) execute_seconds,
  bytes_scanned, rows_produced, start_time
from query_log where start_time >= cast({AS_OF_DATE} - 7 as timestamp) and total_elapsed_ms > 30000
order by total_elapsed_ms desc, query_id asc limit 20""")

add("scan_ratio_topk", f"""
select query_id, substr(query_text, 1, 120) query_preview, bytes_scanned, partitions_scanned, partitions_total,
  round(partitions_scanned / nullif(partitions_total, 0) * 100, 1) pct_partitions_scanned, start_time
from query_log where start_time >= cast({AS_OF_DATE} - 7 as timestamp) and partitions_total > 0
  and partitions_scanned / nullif(partitions_total, 0) > 0.9
order by bytes_scanned desc, query_id asc limit 20""")

add("active_idle_ratio", f"""
select group_name, {cnt('credits_used > 0')} active_intervals, {cnt('credits_used = 0')} idle_intervals,
  {pct(cnt('credits_used > 0'))} active_pct, round(sum(credits_used), 4) total_credits
from metering_log where start_time >= cast({AS_OF_DATE} - 7 as timestamp) group by group_name""")

add("refresh_usage", f"""
select table_name, cast(start_time as date) usage_date, round(sum(credits_used), 6) credits_used,
  count(*) refresh_count
from refresh_log where start_time >= cast({AS_OF_DATE} - 30 as timestamp)
group by table_name, cast(start_time as date)""")

add("health_summary", f"""
select f.latest_bronze_ts, {hb('f.latest_bronze_ts', AS_OF_TS)} hours_since_bronze_load,
  case when {hb('f.latest_bronze_ts', AS_OF_TS)} > 5 then 'STALE' else 'OK' end freshness_status,
  c.bronze_rows, c.silver_rows, c.gold_rows, c.rt_rows realtime_rows,
  round(c.silver_rows / nullif(c.bronze_rows, 0) * 100, 1) silver_retention_pct,
  round(c.gold_rows / nullif(c.silver_rows, 0) * 100, 1) gold_retention_pct,
  d.null_shipment_ids, d.dup_shipment_ids, d.negative_delays,
  case when d.null_shipment_ids > 0 or d.dup_shipment_ids > 0 or d.negative_delays > 0
       then 'DQ VIOLATIONS FOUND' else 'OK' end dq_status
from (select max(_loaded_at) latest_bronze_ts from raw_shipments) f
cross join (select (select count(*) from raw_shipments) bronze_rows, (select count(*) from stg_shipments) silver_rows,
              (select count(*) from fct_shipment_events) gold_rows,
              (select count(*) from active_shipments) rt_rows) c
cross join (select {cnt('shipment_id is null')} null_shipment_ids,
              cast(count(*) - count(distinct shipment_id) as bigint) dup_shipment_ids,
              {cnt('delay_hours < 0')} negative_delays from fct_shipment_events) d""")

add("rt_freshness", f"""
select 'realtime.dt_active_shipments' table_name, max(s._loaded_at) latest_ts,
  round(date_diff('second', max(s._loaded_at), {AS_OF_TS}) / 3600.0, 2) age_hours,
  case when date_diff('second', max(s._loaded_at), {AS_OF_TS}) / 3600.0 <= 0.25 then 'PASS' else 'FAIL' end
    freshness_check
from active_shipments a join stg_shipments s on a.shipment_id = s.shipment_id""")

# -------------------------------------------------------------- dashboards
add("dash_congestion_map", "select port_code, port_name, lat, lon, congestion_level from port_congestion_24h")

add("dash_delay_trend", f"""
select c.carrier_name, d.year_month, count(*) shipments, {rnd('avg(f.delay_hours)', 2)} avg_delay_hours
from fct_shipment_events f join dim_carrier c on f.carrier_key = c.carrier_key
join dim_date d on f.eta_date_key = d.date_key group by c.carrier_name, d.year_month""")

add("dash_active_by_category", "select delay_category, count(*) active_shipments from active_shipments group by delay_category")

add("dash_cost_by_commodity", """
select commodity_code, count(*) shipments, cast(sum(entries) as bigint) customs_entries,
  cast(sum(down + case when place <= cents - spent then 1 else 0 end) / 100 as decimal(38,2)) total_landed_cost_php
from (select *, sum(down) over (partition by shipment_id) spent,
        row_number() over (partition by shipment_id order by rest desc, commodity_code nulls last) place
      from (select *, cents * own // total down, cents * own % total rest
            from (select *, sum(own) over (partition by shipment_id) total
                  from (select c.shipment_id, c.commodity_code, c.entries, l.cents,
                          case when sum(c.val) over (partition by c.shipment_id) > 0 then c.val else c.entries end own
                        from (select shipment_id, commodity_code, count(*) entries,
                                cast(sum(coalesce(declared_value_usd, 0)) * 100 as hugeint) val
                              from dim_customs_entry group by shipment_id, commodity_code) c
                        join (select shipment_id, cast(sum(total_landed_cost_php) * 100 as hugeint) cents
                              from fct_landed_cost group by shipment_id) l on c.shipment_id = l.shipment_id) w) t) d) p
group by commodity_code""")

add("dash_dwell_by_port", f"""
select p.port_code, p.port_name, {rnd('avg(f.dwell_hours)', 2)} avg_dwell_hours
from fct_port_dwell f join dim_port p on f.port_key = p.port_key group by p.port_code, p.port_name""")

add("union_checks", "select 'range' check_kind, check_name, violation_count from (" + RAW["range_checks"]
    + ") r\nunion all select 'accepted_values', check_name, violation_count from ("
    + RAW["accepted_value_violations"] + ") a\nunion all select 'orphans', check_name, orphan_count from ("
    + RAW["orphans"] + ") o")

cte("fx_feed_clean", """
select rate_date, round(close - cast(0.0125 as double), 4) usd_php_open,
  round(close + cast(0.0311 as double), 4) usd_php_high, round(close - cast(0.0407 as double), 4) usd_php_low,
  round(close, 4) usd_php_close, cast(coalesce(volume, 0.0) as bigint) usd_php_volume,
  'yahoo_finance / USDPHP=X' source
from (select rate_date,
        cast(usd_php_close as double) + (dayofyear(rate_date) % 7) * cast(0.0000123 as double) close,
        case when dayofyear(rate_date) % 5 = 0 then null else dayofyear(rate_date) * cast(1000.0 as double) end volume
      from usd_php_rates) f""")
add("fx_feed_clean", "select * from fx_feed_clean")
add("fx_feed_validate", """
select count(*) row_count, cast(count(*) - count(distinct rate_date) as bigint) duplicate_dates,
  min(usd_php_close) close_min, max(usd_php_close) close_max,
  cast(sum(case when usd_php_open is null then 1 else 0 end) + sum(case when usd_php_close is null then 1 else 0 end)
    as bigint) null_open_close,
  min(rate_date) first_date, max(rate_date) last_date,
  coalesce(min(usd_php_close) between 40.0 and 75.0 and max(usd_php_close) between 40.0 and 75.0, false) close_in_range,
  case when count(*) = 0 then 'FAIL' when count(*) - count(distinct rate_date) > 0 then 'FAIL'
       when not coalesce(min(usd_php_close) between 40.0 and 75.0 and max(usd_php_close) between 40.0 and 75.0, false)
         or coalesce(sum(case when usd_php_open is null then 1 else 0 end)
                     + sum(case when usd_php_close is null then 1 else 0 end), 0) > 0 then 'WARN'
       else 'OK' end status
from fx_feed_clean""")

# Sliding 24 h windows every 15 minutes: each call belongs to the 96 windows
# whose start lies in (arrival - 24 h, arrival], aligned to 15 minutes.
add("stream_port_congestion", f"""
select window_start, window_start + interval 24 hours window_end, port_code, port_name, lat, lon,
  count(*) vessels_in_port, round(sum(anchorage_wait_h) / nullif(count(anchorage_wait_h), 0), 1) avg_wait_hours,
  {cnt('coalesce(anchorage_wait_h > 24, false)')} congested_vessels,
  {pct(cnt('coalesce(anchorage_wait_h > 24, false)'), 'count(*)')} congestion_pct,
  case when {pct(cnt('coalesce(anchorage_wait_h > 24, false)'), 'count(*)')} >= 60 then 'CRITICAL'
       when {pct(cnt('coalesce(anchorage_wait_h > 24, false)'), 'count(*)')} >= 35 then 'HIGH'
       when {pct(cnt('coalesce(anchorage_wait_h > 24, false)'), 'count(*)')} >= 15 then 'MODERATE'
       else 'NORMAL' end congestion_level
from (select v.port_code, p.port_name, p.lat, p.lon, v.anchorage_wait_h,
        time_bucket(interval 15 minutes, v.arrival_ts) - k * interval 15 minutes window_start
      from stg_vessel_calls v join dim_port p on v.port_code = p.port_code, range(96) t(k)) w
group by window_start, port_code, port_name, lat, lon""")

# ------------------------------------------------------------ streams
add("stream_unknown_ports", """
select dest_port_code, 'UNKNOWN PORT' dest_port_status, count(*) shipments
from (select shipment_id, arg_max(dest_port_code, _loaded_at) dest_port_code from stg_shipments group by shipment_id) latest
where not exists (select 1 from dim_port p where p.port_code = latest.dest_port_code)
group by dest_port_code""")

add("stream_late_calls", """
select port_code, count(*) calls, count(*) filter (where pane <= seen - 96) late_calls
from (select c.*, case delivery when 2 then max(case when delivery = 1 then pane end) over ()
                                when 3 then max(case when delivery < 3 then pane end) over () end seen
      from (select v.port_code, cast(floor(epoch(v.arrival_ts) / 900) as bigint) pane,
              case when v.teu_count % 50 = 0 then 3 when v._loaded_at <= n.newest - interval 20 days then 1
                   when v._loaded_at <= n.newest - interval 10 days then 2 else 3 end delivery
            from stg_vessel_calls v, (select max(_loaded_at) newest from raw_vessel_calls) n) c) d
group by port_code""")

add("stream_lag", """
select t.*, cast(3 as bigint) batches, cast(0 as bigint) late_rows_dropped, 'OK' lag_status
from (select 'dt_active_shipments' query_name, cast(5 as double) target_lag_minutes,
        (select count(*) from raw_shipments) input_rows
      union all
      select 'dt_port_congestion', 15, (select count(*) from raw_vessel_calls)) t""")

# ------------------------------------------------------------ the run's tests


def _tests(name: str, test: str, severity: str = "'error'", model: str = "model", column: str = "column_name",
           failing: str = "failing_rows") -> str:
    return (f"select '{test}' test, {model} model, {column} column_name, cast({failing} as bigint) failing_rows, "
            f"{severity} severity from ({RAW[name]}) t")


add("data_tests", "\nunion all\n".join([
    _tests("dq_not_null", "not_null"), _tests("dq_unique", "unique"), _tests("dq_accepted_values", "accepted_values"),
    _tests("dq_expression", "expression_is_true"),
    "select 'singular', 'fct_port_dwell', 'dwell_hours', count(*), 'error' from fct_port_dwell where dwell_hours < 0",
    _tests("dq_grain", "grain", column="grain", failing="duplicate_keys"),
    _tests("source_freshness", "freshness", "case freshness_status when 'ERROR' then 'error' else 'warn' end",
           "source_table", "'_loaded_at'", "freshness_status <> 'OK'"),
    _tests("outliers_iqr", "outliers", "'warn'", "split_part(column_check, '.', 1)", "split_part(column_check, '.', 2)",
           "outlier_count")]))

# ------------------------------------------------------------ CSV loads
cte("planted_customs", """
select *, line_no % 500 = 1 bad_int, line_no % 777 = 2 extra,
  row_number() over (partition by file order by order_no, entry_no) + 1 line_number
from (select *, order_no + entry_no line_no, 'part-0000' || cast(order_no % 4 as varchar) file
      from (select *, cast(split_part(substr(entry_number, 3), '-', 1) as bigint) order_no,
              cast(split_part(entry_number, '-', 2) as bigint) entry_no from raw_customs_entries) n) p""")

add("csv_rejects", """
select * exclude (order_no, entry_no, line_no, file, bad_int, extra, line_number)
from planted_customs where not bad_int and not extra""")

_ERROR = "case when extra then 'wrong number of fields' else 'processing_days: ''x7'' is no int' end"
add("csv_rejected_lines", f"""
select file file_name, line_number, {_ERROR} error from planted_customs where bad_int or extra""")

add("load_audit", f"""
select 'raw_customs_entries' table_name, file file_name, count(*) row_parsed,
  count(*) filter (where not bad_int and not extra) row_count,
  arg_min({_ERROR}, line_number) filter (where bad_int or extra) first_error_message,
  min(line_number) filter (where bad_int or extra) first_error_line_number,
  case when bool_or(bad_int or extra) then 'PARTIALLY_LOADED' else 'LOADED' end status, {AS_OF_TS} last_load_time
from planted_customs group by file""")

add("csv_header_load", f"select * replace ({AS_OF_TS} as _loaded_at) from raw_shipments")

# ------------------------------------------------------------ stored layers
add("bronze_append", "select * from raw_vessel_calls")
add("bronze_table", "select * from raw_vessel_calls")
add("lake_tables", "\nunion all\n".join(
    f"select '{layer}' layer, '{t}' table_name, count(*) row_count from {t}" for layer, tables in {
        "silver": ["stg_vessel_calls", "stg_shipments", "stg_customs_entries"],
        "gold": ["ph_ports", "ph_tariff_rates", "usd_php_rates", "dim_date", "dim_port", "dim_vessel", "dim_carrier",
                 "dim_shipment", "dim_customs_entry", "carrier_performance", "customs_clearance_kpi",
                 "commodity_cost_summary", "port_catchment_area", "fct_shipment_events", "fct_port_dwell",
                 "fct_landed_cost", "port_throughput_daily", "congestion_delay_impact"]}.items() for t in tables))
add("catchment_in_order", "select count(*) row_count, cast(0 as bigint) out_of_order from port_catchment_area")
add("berth_wait_minutes", """
select port_code, cast(sum(date_diff('minute', arrival_ts, berth_ts)) as bigint) wait_minutes,
  min(date_diff('minute', arrival_ts, berth_ts)) shortest, max(date_diff('minute', arrival_ts, berth_ts)) longest
from stg_vessel_calls group by port_code""")

add("skipped_inputs", """
select 'raw_vessel_calls' table_name, count(*) row_count, 'LOADED' status from raw_vessel_calls
union all select 'raw_shipments', count(*), 'LOADED' from raw_shipments
union all select 'raw_customs_entries', 0, 'SKIPPED'""")
