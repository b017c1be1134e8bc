"""DuckDB SQL equivalents of the catalogued queries (the correctness oracle).

The oracle sees only the base tables, so each domain view is inlined as a
CTE. Sums and averages are plain ``sum`` and ``avg``, compared to six
decimals; scores are rounded decimal-first, half-up.
"""

from __future__ import annotations

VIEWS = {
    "machine_readings": """
select l_suppkey as machine_id, l_shipdate as ts, l_orderkey as order_key, l_linenumber as line_no,
       l_quantity*2 as temperature,
       case when l_linenumber = 1 then -1.0E0 else l_discount*100 end as vibration,
       case when l_returnflag = 'R' then 1 else 0 end as anomaly_flag,
       l_tax*12.5E0 as downtime_risk,
       case when l_linenumber = 7 then null else l_quantity - 1 end as energy_consumption,
       l_extendedprice/25 as predicted_remaining_life
from lineitem""",
    "ecommerce_records": """
select o_orderkey as order_key, o_custkey as customer_id,
       '$' || format('{:,.2f}', o_totalprice/400) as purchase_amount,
       case when o_orderkey % 50 = 0 then 'n/a' else cast(1 + o_orderkey % 10 as varchar) end as frequency_of_purchase,
       cast(1 + o_custkey % 10 as varchar) as brand_loyalty,
       cast(o_custkey % 11 as varchar) as customer_satisfaction
from orders""",
    "ecommerce_processed": """
select e.order_key, e.customer_id, e.purchase_amount,
       case when e.customer_id % 3 = 0 then (e.customer_id % 11)/10.0E0 else cast(e.customer_id % 11 as double) end as customer_satisfaction,
       cast(1 + e.order_key % 5 as double) as product_rating,
       case when o.o_orderstatus = 'P' then null when e.order_key % 40 = 3 then 'soon' else cast(e.order_key % 8 as varchar) end as time_to_decision,
       c.c_mktsegment as purchase_category, o.o_orderpriority as marketing_channel
from ecommerce_records e join orders o on o.o_orderkey = e.order_key join customer c on c.c_custkey = e.customer_id""",
    "event_readings": """
select event_id, user_id % 40 as machine_id, ts, value/5 as temperature,
       cast(json_extract_string(props, '$.k') as double)/10 as vibration,
       case when event_type = 'error' then 1 else 0 end as anomaly_flag, (user_id % 10)/10.0E0 as downtime_risk
from events""",
}
VIEWS["mfg_a"] = "select * from machine_readings where line_no <= 3"
VIEWS["mfg_b"] = """select machine_id, ts, order_key, line_no, temperature, anomaly_flag/2.0E0 as anomaly_flag, downtime_risk,
       energy_consumption, predicted_remaining_life
from machine_readings where line_no = 4"""
VIEWS["mfg_d"] = """select machine_id, ts, order_key, line_no, temperature,
       case when anomaly_flag = 1 then 1.0E0 when order_key % 4 = 0 then 0.5E0 else 0.0E0 end as anomaly_flag, downtime_risk,
       case when order_key % 10 <> 0 then energy_consumption end as energy_consumption, predicted_remaining_life
from machine_readings where line_no = 5"""
VIEWS["mfg_c"] = "select m.*, cast(null as double) as humidity from machine_readings m where line_no >= 6"

# dependencies between the views, in definition order
_DEPENDS = {
    "machine_readings": (),
    "ecommerce_records": (),
    "ecommerce_processed": ("ecommerce_records",),
    "event_readings": (),
    "mfg_a": ("machine_readings",),
    "mfg_b": ("machine_readings",),
    "mfg_c": ("machine_readings",),
    "mfg_d": ("machine_readings",),
}


def with_views(views: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause holding the named views (and their dependencies), then ``body``."""
    ordered: list[str] = []

    def visit(v: str) -> None:
        for d in _DEPENDS[v]:
            visit(d)
        if v not in ordered:
            ordered.append(v)

    for v in views:
        visit(v)
    ctes = [f"{v} as ({VIEWS[v]})" for v in ordered] + [f"{n} as ({q})" for n, q in (extra or [])]
    return "with " + ",\n".join(ctes) + "\n" + body


def rounded(expr: str, scale: int) -> str:
    """Half-up after a 10-decimal step; what no decimal can hold (NaN, infinity, 1e20 and more) stays."""
    return f"coalesce(cast(cast(try_cast({expr} as decimal(30,10)) as decimal(28,{scale})) as double), cast({expr} as double))"


def round2(expr: str) -> str:
    return rounded(expr, 2)


def round6(expr: str) -> str:
    return rounded(expr, 6)


def kind(expr: str) -> str:
    return (f"case when {expr} is null then 'none' when isnan({expr}) then 'nan' when isinf({expr}) then 'inf' "
            "else 'finite' end")


def finite(expr: str) -> str:
    return f"case when isfinite({expr}) then {expr} end"


PRIORITY = ("(0.3E0*temperature/100 + 0.25E0*vibration/10 + 0.15E0*anomaly_flag"
            " + 0.3E0*downtime_risk)")
EFFICIENCY = ("case when energy_consumption <= 0 then 0.0E0 else least(500.0E0, greatest(0.0E0,"
              " predicted_remaining_life/energy_consumption)) end")

ORACLE: dict[str, str] = {}

ORACLE["machine_scores"] = with_views(["machine_readings"], f"""
select machine_id, order_key, cast(line_no as bigint) as line_no,
       {PRIORITY} as priority_raw, {round2(PRIORITY)} as maintenance_priority_score
from machine_readings""")

ORACLE["machine_alerts"] = with_views(["machine_readings"], f"""
select machine_id, 'HIGH_MAINTENANCE_PRIORITY' as alert_type, {PRIORITY} as score, ts as timestamp,
       'Schedule immediate maintenance' as recommended_action
from machine_readings where {PRIORITY} > 0.7E0""")

ORACLE["machine_efficiency"] = with_views(["machine_readings"], f"""
select machine_id, order_key, cast(line_no as bigint) as line_no, {EFFICIENCY} as machine_efficiency
from machine_readings
where energy_consumption is not null and predicted_remaining_life is not null and machine_id is not null""")

ORACLE["negative_vibration"] = with_views(["machine_readings"], """
select count_if(vibration < 0) as negative_vibration_count from machine_readings""")

_UNION = """
select *, 'mfg_a' as source_table from mfg_a
union all by name select *, 'mfg_b' as source_table from mfg_b
union all by name select * exclude (humidity), 'mfg_c' as source_table from mfg_c
union all by name select *, 'mfg_d' as source_table from mfg_d"""

ORACLE["conform_union"] = with_views(["mfg_a", "mfg_b", "mfg_c", "mfg_d"], """
select machine_id, ts, order_key, cast(line_no as bigint) as line_no, temperature, vibration,
       cast(anomaly_flag as double) as anomaly_flag, downtime_risk, energy_consumption,
       predicted_remaining_life, source_table
from u""", extra=[("u", _UNION)])

_MFG_AVG = ("order_key", "line_no", "temperature", "vibration", "anomaly_flag", "downtime_risk",
            "energy_consumption", "predicted_remaining_life", "machine_efficiency")

ORACLE["machine_rollup"] = with_views(["mfg_a", "mfg_b", "mfg_c", "mfg_d"], f"""
select machine_id, {", ".join(f"{round6(f'avg({c})')} as avg_{c}" for c in _MFG_AVG)},
       count_if(anomaly_flag > 0) as total_anomalies, count(*) as total_records,
       count(distinct source_table) as source_tables_count
from p group by machine_id""", extra=[("u", _UNION), ("p", f"""
select *, {EFFICIENCY} as machine_efficiency from u
where energy_consumption is not null and predicted_remaining_life is not null and machine_id is not null""")])

_MFG_TABLES = ("mfg_a", "mfg_b", "mfg_c", "mfg_d")
_COMPLETE = "energy_consumption is not null and predicted_remaining_life is not null and machine_id is not null"

ORACLE["etl_run_counts"] = with_views(list(_MFG_TABLES), f"""
select count_if(vibration < 0) as negative_vibration_rows, count(*) as total_rows, count_if({_COMPLETE}) as complete_rows,
       count_if({_COMPLETE}) as stored_rows, count_if({_COMPLETE} and anomaly_flag > 0) as anomalies
from u""", extra=[("u", _UNION)])

ORACLE["skipped_tables"] = with_views(list(_MFG_TABLES), """
select source_table as table_name, 'read' as status, count(*) as rows from u group by source_table
union all select 'mfg_broken', 'cannot be read', null
union all select 'orders', 'missing essential columns', null""", extra=[("u", _UNION)])

_MFG_COLUMNS = ("machine_id", "ts", "order_key", "line_no", "temperature", "vibration", "anomaly_flag", "downtime_risk",
                "energy_consumption", "predicted_remaining_life")
_STORED = {"mfg_a": _MFG_COLUMNS, "mfg_b": tuple(c for c in _MFG_COLUMNS if c != "vibration"),
           "mfg_c": (*_MFG_COLUMNS, "humidity"), "mfg_d": tuple(c for c in _MFG_COLUMNS if c != "vibration")}
ORACLE["table_profile"] = with_views(list(_MFG_TABLES), " union all ".join(
    [f"select '{t}' as table_name, '{c}' as column_name, count({c}) > 0 as present from {t}" for t, cols in _STORED.items()
     for c in cols] + ["select 'mfg_c', 'source_table', count(*) > 0 from mfg_c"]))


def _strict_int(expr: str) -> str:
    return f"case when regexp_full_match(trim({expr}), '[+-]?[0-9]+') then try_cast(trim({expr}) as bigint) end"


_CUSTOMER_PARSED = f"""
select order_key, customer_id,
       try_cast(trim(replace(purchase_amount, '$', '')) as double) as amt,
       {_strict_int("frequency_of_purchase")} as freq,
       {_strict_int("brand_loyalty")} as loy,
       {_strict_int("customer_satisfaction")} as sat
from ecommerce_records"""
_CUSTOMER_RAW = "(0.4E0*amt/1000 + 0.3E0*freq/10 + 0.15E0*loy/10 + 0.15E0*sat/10)"
_CUSTOMER_SCORED = f"""
select order_key, customer_id, {round2("raw")} as customer_value_score,
       case when raw is null then 'ERROR' when isnan(raw) then 'STANDARD' when raw > 0.6E0 then 'HIGH_VALUE'
            when raw > 0.4E0 then 'MEDIUM_VALUE' else 'STANDARD' end as customer_segment
from (select *, {_CUSTOMER_RAW} as raw from cp)"""

_ODD = """
select * replace (case when order_key % 61 = 0 then 'nan' when order_key % 67 = 0 then '$inf' else purchase_amount end
                  as purchase_amount) from ecommerce_records"""
ORACLE["customer_scores"] = with_views(["ecommerce_records"], f"""
select order_key, customer_id, {finite("customer_value_score")} as customer_value_score,
       {kind("customer_value_score")} as score_kind, customer_segment from cs""", extra=[
    ("odd", _ODD), ("cp", _CUSTOMER_PARSED.replace("from ecommerce_records", "from odd")),
    ("cs", _CUSTOMER_SCORED)])
ORACLE["segment_counts"] = with_views(["ecommerce_records"], """
select customer_segment, count(*) as records from cs group by customer_segment""", extra=[
    ("odd", _ODD), ("cp", _CUSTOMER_PARSED.replace("from ecommerce_records", "from odd")), ("cs", _CUSTOMER_SCORED)])

_CLEAN = """
select *, case when cleaned_time_to_decision > 0 and cleaned_purchase_amount is not null
               then cleaned_purchase_amount / cleaned_time_to_decision else 0.0E0 end as purchase_efficiency
from (select *, try_cast(regexp_replace(purchase_amount, '[$,]', '', 'g') as double) as cleaned_purchase_amount,
             coalesce(try_cast(time_to_decision as double), 0.0E0) as cleaned_time_to_decision
      from ecommerce_processed)"""

ORACLE["purchase_clean"] = with_views(["ecommerce_processed"], """
select order_key, customer_id, cleaned_purchase_amount, cleaned_time_to_decision, purchase_efficiency
from cl""", extra=[("cl", _CLEAN)])

_CUSTOMER_ROLLUP = f"""
select customer_id, {round6("sum(cleaned_purchase_amount)")} as total_purchase_amount,
       {round6("avg(cleaned_purchase_amount)")} as avg_purchase_amount, count(*) as purchase_count,
       {round6("avg(customer_satisfaction)")} as avg_satisfaction,
       {round6("avg(product_rating)")} as avg_product_rating,
       max(customer_satisfaction) as customer_value_score,
       case when max(customer_satisfaction) > 0.8E0 then 'HIGH_VALUE'
            when max(customer_satisfaction) > 0.5E0 then 'MEDIUM_VALUE' else 'STANDARD' end as customer_segment
from cl group by customer_id"""

ORACLE["customer_rollup"] = with_views(["ecommerce_processed"], "select * from cr",
                                       extra=[("cl", _CLEAN), ("cr", _CUSTOMER_ROLLUP)])

ORACLE["bucketed_rollup"] = ORACLE["customer_rollup"]

ORACLE["purchase_sample"] = with_views(["ecommerce_processed"], """
select customer_id, purchase_amount, time_to_decision, purchase_efficiency
from cl order by customer_id, purchase_amount, time_to_decision nulls first, purchase_efficiency limit 5""", extra=[("cl", _CLEAN)])

# --- decoding and streaming ------------------------------------------------

_SPOILED = "({id} % 97 = 0 or {id} % 89 = 0 or {id} % 83 = 0)"
_EVENTS_OK = f"select * from event_readings where not {_SPOILED.format(id='event_id')}"

ORACLE["envelope_decode"] = with_views(["event_readings"], """
select cast(machine_id as varchar) as key, event_id, machine_id, ts, temperature, vibration,
       cast(anomaly_flag as bigint) as anomaly_flag, downtime_risk
from ev""", extra=[("ev", _EVENTS_OK)])

ORACLE["record_metadata"] = with_views(["event_readings"], """
select count(*) as records, count(*) as uuid_records, count(*) as stamped_records from ev""",
                                       extra=[("ev", _EVENTS_OK)])

_PERTURBED = """
select event_id, machine_id, ts,
       case when event_id % 11 = 0 then null when event_id % 19 = 0 then 'nan'::double
            when event_id % 23 = 0 then 'inf'::double else temperature end as temperature,
       vibration, case when event_id % 17 = 0 or event_id % 31 = 0 then null when event_id % 29 = 0 then 1
                       else anomaly_flag end as anomaly_flag,
       case when event_id % 13 = 0 then 0.0E0 else downtime_risk end as downtime_risk,
       event_id % 7 <> 0 as scorable
from ev"""

ORACLE["unscorable_routing"] = with_views(["event_readings"], f"""
select event_id, scorable, {finite("score")} as maintenance_priority_score, {kind("score")} as score_kind
from (select event_id, scorable, case when scorable then {round2(PRIORITY)} end as score
      from pt where not scorable or {PRIORITY} is not null)""", extra=[("ev", _EVENTS_OK), ("pt", _PERTURBED)])

ORACLE["stream_machines"] = with_views(["event_readings"], f"""
select event_id, machine_id, ts, temperature, vibration, cast(anomaly_flag as bigint) as anomaly_flag,
       downtime_risk, {round2(PRIORITY)} as maintenance_priority_score
from ev""", extra=[("ev", _EVENTS_OK)])

ORACLE["stream_alerts"] = with_views(["event_readings"], f"""
select machine_id, 'HIGH_MAINTENANCE_PRIORITY' as alert_type, {PRIORITY} as score, ts as timestamp,
       'Schedule immediate maintenance' as recommended_action
from ev where {PRIORITY} > 0.7E0""", extra=[("ev", _EVENTS_OK)])

ORACLE["stream_machines_csv"] = with_views(["event_readings"], """
select cast(event_id as varchar) as event_id, cast(machine_id as varchar) as machine_id,
       cast(anomaly_flag as varchar) as anomaly_flag, cast(null as varchar) as other_fields, true as has_batch_id,
       true as has_time, round(temperature, 6) as temperature
from ev""", extra=[("ev", _EVENTS_OK)])

_RECORDS_OK = f"select * from ecommerce_records where not {_SPOILED.format(id='order_key')}"

ORACLE["stream_customers"] = with_views(["ecommerce_records"], "select * from cs", extra=[
    ("er_ok", _RECORDS_OK), ("cp", _CUSTOMER_PARSED.replace("from ecommerce_records", "from er_ok")),
    ("cs", _CUSTOMER_SCORED)])

ORACLE["stream_customers_csv"] = with_views(["ecommerce_records"], """
select cast(e.order_key as varchar) as order_key, cast(e.customer_id as varchar) as customer_id, e.purchase_amount,
       e.frequency_of_purchase, e.brand_loyalty, e.customer_satisfaction, cs.customer_segment,
       cast(null as varchar) as other_fields, true as has_time
from er_ok e join cs using (order_key)""", extra=[
    ("er_ok", _RECORDS_OK), ("cp", _CUSTOMER_PARSED.replace("from ecommerce_records", "from er_ok")),
    ("cs", _CUSTOMER_SCORED)])

ORACLE["batch_stats"] = with_views(["event_readings", "ecommerce_records"], f"""
select 'manufacturing' as stream, count(*) as total_records,
       count(*) filter (where not {_SPOILED.format(id='event_id')}) as processed_count,
       count(*) filter (where {_SPOILED.format(id='event_id')}) as failed_records,
       count(*) filter (where not {_SPOILED.format(id='event_id')} and {PRIORITY} > 0.7E0) as alert_count
from event_readings
union all
select 'ecommerce', count(*), count(*) filter (where not {_SPOILED.format(id='order_key')}),
       count(*) filter (where {_SPOILED.format(id='order_key')}), cast(null as bigint)
from ecommerce_records""")

# --- sinks, sources, summaries ---------------------------------------------

ORACLE["csv_ingest"] = with_views(["ecommerce_records"], """
select cast(order_key as varchar) as order_key, cast(customer_id as varchar) as customer_id, purchase_amount,
       frequency_of_purchase, brand_loyalty, customer_satisfaction,
       case order_key % 3 when 0 then '  said "' || order_key || '", twice "" '
                          when 1 then 'one,' || chr(10) || 'two ' || order_key end as note, true as stamped
from ecommerce_records""")

ORACLE["rollup_roundtrip"] = ORACLE["customer_rollup"]

ORACLE["partitioned_roundtrip"] = with_views(["machine_readings"], f"""
select * replace (cast(line_no as bigint) as line_no, cast(anomaly_flag as bigint) as anomaly_flag),
       {EFFICIENCY} as machine_efficiency
from machine_readings
where energy_consumption is not null and predicted_remaining_life is not null and machine_id is not null""")

ORACLE["table_discovery"] = """
select 'all' as discovery, 'ecommerce' as table_name, count(*) as rows from orders
union all select 'all', 'ecommerce_events', count(*) from events
union all select 'all', 'machines', count(*) from lineitem
union all select 'prefix', 'ecommerce', count(*) from orders
union all select 'prefix', 'ecommerce_events', count(*) from events"""

_MS_SCORED = f"""
select *, {PRIORITY} as raw, {EFFICIENCY} as eff,
       (energy_consumption is not null and predicted_remaining_life is not null and machine_id is not null) as complete
from machine_readings"""
_MS_LATEST = """
select machine_id, raw as latest from (
  select machine_id, raw, row_number() over (partition by machine_id order by ts desc, raw desc nulls last) as rn from ms_s)
where rn = 1"""
_MS_PER = """
select machine_id, count_if(raw > 0.7E0) as alerts, count(*) as readings, count_if(complete) as complete,
       sum(case when complete then eff end) as eff_sum, count(case when complete then eff end) as eff_n
from ms_s group by machine_id"""
_MS = f"""
select count_if(p.machine_id is not null) as total_machines_analyzed,
       count_if(p.machine_id is not null and l.latest > 0.7E0) as high_risk_machines,
       count_if(p.machine_id is not null and l.latest > 0.4E0 and l.latest <= 0.7E0) as medium_risk_machines,
       count_if(p.machine_id is not null and (l.latest is null or l.latest <= 0.4E0)) as low_risk_machines,
       cast(sum(p.alerts) as bigint) as predicted_maintenance_events,
       {round6("sum(p.eff_sum) / nullif(sum(p.eff_n), 0) / 500")} as average_machine_efficiency,
       {round6("cast(sum(p.complete) as double) / nullif(sum(p.readings), 0)")} as data_quality_score
from ms_p p join ms_l l on p.machine_id = l.machine_id"""
_MS_CTES = [("ms_s", _MS_SCORED), ("ms_l", _MS_LATEST), ("ms_p", _MS_PER), ("ms", _MS)]

ORACLE["machine_summary"] = with_views(["machine_readings"], "select * from ms", extra=_MS_CTES)
ORACLE["latest_summary"] = ORACLE["machine_summary"]

_ES = f"""
select (select count(*) from cr where customer_id is not null) as total_customers_analyzed,
       (select count_if(customer_segment = 'HIGH_VALUE') from cr) as high_value_customers,
       (select count_if(customer_segment = 'MEDIUM_VALUE') from cr) as medium_value_customers,
       (select count_if(customer_segment = 'STANDARD') from cr) as standard_customers,
       (select {round6("avg(cleaned_purchase_amount)")} from cl) as average_purchase_amount,
       (select purchase_category from (select purchase_category, count(*) as n from cl
          where purchase_category is not null group by purchase_category
          order by n desc, purchase_category limit 1)) as most_popular_category,
       (select marketing_channel from (select marketing_channel, avg(cleaned_purchase_amount) as a
          from cl where marketing_channel is not null group by marketing_channel
          order by a desc nulls last, marketing_channel limit 1)) as highest_roi_marketing_channel,
       (select {round6("avg(customer_satisfaction)")} from cl) as customer_satisfaction_index,
       (select {round6("cast(count_if(customer_segment <> 'ERROR') as double) / nullif(count(*), 0)")} from cs)
         as data_quality_score"""
_ES_CTES = [("cl", _CLEAN), ("cr", _CUSTOMER_ROLLUP), ("cp", _CUSTOMER_PARSED), ("cs", _CUSTOMER_SCORED),
            ("es", _ES)]

ORACLE["customer_summary"] = with_views(["ecommerce_processed"], "select * from es", extra=_ES_CTES)

_OPEX = "m.average_machine_efficiency * 0.6E0 + e.customer_satisfaction_index / 10 * 0.4E0"
_HEALTH = ("(1 - m.high_risk_machines / m.total_machines_analyzed) * 0.5E0"
           " + (e.high_value_customers / e.total_customers_analyzed) * 0.5E0")
_SCORES = f"""{round6(_OPEX)} as operational_excellence_score, {round6(_HEALTH)} as business_health_index,
       {round6("m.data_quality_score * 0.5E0 + e.data_quality_score * 0.5E0")} as data_quality_composite"""

# the scores use the unrounded means
_EXACT = [(n, q.replace("6)) as double), cast(", "10)) as double), cast(") if n in ("ms", "es") else q) for n, q in _MS_CTES + _ES_CTES]
ORACLE["cross_domain"] = with_views(["machine_readings", "ecommerce_processed"], f"select {_SCORES} from ms m, es e",
                                    extra=_EXACT)

_FIELDS = {"mfg": ("total_machines_analyzed", "high_risk_machines", "medium_risk_machines", "low_risk_machines",
                   "predicted_maintenance_events", "average_machine_efficiency", "data_quality_score"),
           "ecom": ("total_customers_analyzed", "high_value_customers", "medium_value_customers", "standard_customers",
                    "average_purchase_amount", "most_popular_category", "highest_roi_marketing_channel",
                    "customer_satisfaction_index", "data_quality_score")}
_MEANS = ("average_machine_efficiency", "data_quality_score", "average_purchase_amount", "customer_satisfaction_index")
_NESTED = ", ".join(f"{round6(f'{t}.{c}') if c in _MEANS else f'{t}.{c}'} as {side}_{c}"
                    for side, t in (("mfg", "m"), ("ecom", "e")) for c in _FIELDS[side])
ORACLE["integrated_insight"] = with_views(
    ["mfg_a", "mfg_b", "mfg_c", "mfg_d", "ecommerce_processed"],
    f"""select true as has_timestamp, true as has_mfg_timestamp, true as has_ecom_timestamp, {_SCORES}, {_NESTED}
from ms m, es e""",
    extra=[("u", _UNION)] + [(n, q.replace("from machine_readings", "from u") if n == "ms_s" else q) for n, q in _EXACT])
