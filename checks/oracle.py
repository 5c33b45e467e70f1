"""The same results as plain SQL for DuckDB, written from the rules and not from the operators."""

from __future__ import annotations

from checks.fixture import BASE_YEAR, COLUMNS, INCIDENTS_SQL, SCENARIO_YEAR
from trilayer import fixed_values as fixed

RAW = "raw as (" + INCIDENTS_SQL.format(dow="isodow(o_orderdate)", orders="orders") + ")"
ALL = ", ".join(COLUMNS)
INT_COLUMNS = [c for c in COLUMNS if c not in ("incident_id", "km")]


def _double(c: str) -> str:
    d = f"try_cast(replace(trim({c}), ',', '.') as double)"
    return f"case when isfinite({d}) then {d} end"


def _whole(c: str, kind: str = "int") -> str:
    return f"try_cast(round({_double(c)}) as {kind})"


def _case(column: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"when {code} then '{text}'" for code, text in mapping.items())
    return f"case {column} {whens} end"


TYPED = (
    "typed as (select "
    + ", ".join(
        [f"{_whole('incident_id', 'bigint')} as incident_id"]
        + [f"{_whole(c)} as {c}" for c in INT_COLUMNS]
        + [f"{_double('km')} as km"]
    )
    + " from raw)"
)

MISSING = "concat_ws(',', case when yr is null then 'yr' end, case when casualties is null then 'casualties' end, case when weather is null then 'weather' end, case when light is null then 'light' end, case when zone is null then 'zone' end)"
DOMAIN = "concat_ws(',', case when weather not between 1 and 9 then 'weather' end, case when light not in (1, 2, 3, 4, 5, 9) then 'light' end)"
RANGE = "concat_ws(',', case when mon not between 1 and 12 then 'mon' end, case when wday not between 1 and 7 then 'wday' end, case when hr not between 0 and 23 then 'hr' end, case when casualties < 0 then 'casualties' end)"

#: Lines of the broken landing that lost or gained fields.
CORRUPT = "case when incident_id % 101 = 0 or incident_id % 103 = 0 then '_corrupt_record' else '' end"

CHECKED = f"""checked as (
  select *, dq_missing = '' and dq_domain = '' and dq_range = '' as dq_valid
  from (select *, {MISSING} as dq_missing, {DOMAIN} as dq_domain, {RANGE} as dq_range, '' as dq_corrupt from typed))"""

STRATEGIC = "coalesce(zone = 1 and (weather = 6 or light in (4, 5)), false)"
GOLD = f"""gold as (
  select {ALL}, {STRATEGIC} as strategic, {_case('light', fixed.LIGHT_LABELS)} as light_desc
  from checked where dq_valid)"""

BASE = f"with {RAW}, {TYPED}, {CHECKED}, {GOLD} "

DAY = f"case when light = 1 then '{fixed.DAY_LABEL}' else '{fixed.NOT_DAY_LABEL}' end"
LIGHT = f"coalesce(light_desc, '{fixed.UNKNOWN_LABEL}')"
SEGMENT = f"case when strategic then '{fixed.SEGMENT_LABEL}' else '{fixed.NOT_SEGMENT_LABEL}' end"
FIGURES = "count(*) as incidents, sum(coalesce(casualties, 0))::double as casualties_total, sum(coalesce(casualties, 0))::double / count(*) as casualties_mean"
BOTH_YEARS = f"yr in ({BASE_YEAR}, {SCENARIO_YEAR})"


def _mart(category: str, name: str) -> str:
    return BASE + f"select yr, {category} as {name}, {FIGURES} from gold where {BOTH_YEARS} group by 1, 2"


def _long(mart: str, ids: str) -> str:
    return " union all ".join(
        f"select {ids}, '{m}' as metric, {m}::double as value from {mart}"
        for m in ("incidents", "casualties_total", "casualties_mean")
    )


def _sides(long: str, by: str = "") -> str:
    return (
        f"select {by} metric, base_value, scenario_value, scenario_value - base_value as delta from ("
        f"select {by} metric, max(value) filter (where yr = {BASE_YEAR}) as base_value, "
        f"max(value) filter (where yr = {SCENARIO_YEAR}) as scenario_value from {long} group by all)"
    )


YEARLY = f"yearly as (select yr, {FIGURES} from gold where yr is not null group by yr)"
DAILY = f"daily as (select yr, {DAY} as day_label, {FIGURES} from gold where {BOTH_YEARS} group by 1, 2)"


def _hash(stream: str, row_id: str, digits: int) -> str:
    text = f"'{fixed.SCENARIO_SEED}:{stream}:' || {row_id}"
    return f"('0x' || substring(md5({text}), 1, {digits}))::bigint"


def _uniform(stream: str, row_id: str) -> str:
    return f"({_hash(stream, row_id, 8)} / 4294967296.0::double)"


def _clamped(growth: str) -> str:
    return f"(1.0::double + greatest(-0.05::double, least(0.05::double, {growth})))"


CHANCE = """case
  when coalesce(zone = 1 and (weather = 6 or light in (4, 5)), false) and coalesce(light = 1, false)
    then case when before <= 0 then 0.035::double else 0.090::double end
  when coalesce(zone = 1 and (weather = 6 or light in (4, 5)), false)
    then case when before <= 0 then 0.015::double else 0.040::double end
  else case when before <= 0 then 0.004::double else 0.010::double end end"""

PARTS = "raw_parts as (select *, cast(casualties::int - fatal::int - serious::int as varchar) as minor from raw)"
TYPED_PARTS = "typed_parts as (select t.*, t.casualties - t.fatal - t.serious as minor from typed t)"

# The scenario table: landing text of the base year, drawn again and uplifted.
SCENARIO = f"""
numbered as (select *, row_number() over (order by incident_id) - 1 as row_no from raw_parts where yr = '{BASE_YEAR}'),
sized as (select count(*) as n, cast(round(count(*) * {_clamped('0.01::double')}) as bigint) as n_out, max(incident_id::bigint) as top from numbered),
draws as (select range as draw_id from range((select n_out from sized))),
drawn as (
  select d.draw_id, b.* from draws d, sized s, numbered b where b.row_no = {_hash('pick', 'd.draw_id', 15)} % s.n),
keyed as (
  select d.draw_id, {_whole('d.zone')} as zone, {_whole('d.weather')} as weather, {_whole('d.light')} as light,
    greatest(0, {_whole('d.fatal')} + {_whole('d.serious')} + {_whole('d.minor')}) as before,
    {_whole('d.fatal')} + {_whole('d.serious')} + {_whole('d.minor')} + 1 as after, d.minor as old_minor
  from drawn d),
gains as (select draw_id, after, old_minor, {_uniform('uplift', 'draw_id')} < {CHANCE} as gain from keyed),
scenario as (
  select cast(s.top + 1 + d.draw_id as varchar) as incident_id, '{SCENARIO_YEAR}' as yr,
    d.mon, d.wday, d.hr, d.weather, d.light, d.zone, d.incident_type,
    case when g.gain then cast(greatest(0, g.after) as varchar) else d.casualties end as casualties,
    d.fatal, d.serious, d.km,
    case when g.gain then cast(d.minor::int + 1 as varchar) else d.minor end as minor
  from drawn d join gains g using (draw_id), sized s)"""

# The pipeline's two landing years through the same typing, checks and rules.
LANDED = f"landed as (select {ALL} from raw_parts where yr = '{BASE_YEAR}' union all select {ALL} from scenario)"
PIPELINE = f"with {RAW}, {PARTS}, {SCENARIO}, {LANDED}, {TYPED.replace(' from raw)', ' from landed)')}, {CHECKED}, {GOLD} "

KPIS = "select yr, strategic, weather, light, count(*) as incidents, sum(casualties)::bigint as casualties_total, avg(casualties) as casualties_avg from gold group by all"

LANDED_YEARS = f"select * from raw where yr = '{BASE_YEAR}' union all select * replace (null as km) from raw where yr <> '{BASE_YEAR}'"

ORACLE_SQL: dict[str, str] = {
    "typed_incidents": BASE + "select * from typed",
    "csv_round_trip": BASE + "select * from raw",
    "sources_union": BASE + LANDED_YEARS,
    "scenario_marker": BASE
    + f"select case yr when '{BASE_YEAR}' then 'base' else 'scenario' end as scenario, yr, count(*) as n from raw group by all",
    "partitioned_round_trip": BASE + "select * from typed",
    "replace_partition": BASE
    + f"select * replace (case when yr = {SCENARIO_YEAR} then casualties + 1 else casualties end as casualties) from typed",
    "parse_bool": """with words as (select o_orderkey, case o_orderkey % 9 when 0 then ' TRUE ' when 1 then 'Sí' when 2 then 'si' when 3 then '1' when 4 then 'T' when 5 then 'no' when 6 then '' when 7 then 'YES' end as word from orders)
      select *, coalesce(lower(trim(word)) in ('true', '1', 't', 'yes', 'y', 'si', 'sí'), false) as flag from words""",
    "zero_fill": BASE
    + f"select incident_id, {_double('weather')} as parsed, coalesce({_double('weather')}, 0.0::double) as filled from raw",
    "restrict_years": BASE + f"select * from typed where {BOTH_YEARS}",
    "fallback_label": BASE
    + f"select incident_id, coalesce({_whole('light')}::varchar, '{fixed.UNKNOWN_LABEL}') as light_desc, coalesce({_whole('weather')}::varchar, '{fixed.UNKNOWN_LABEL}') as weather_desc from raw",
    "dq_missing": BASE + "select incident_id, dq_missing from checked",
    "dq_domain": BASE + "select incident_id, dq_domain from checked",
    "dq_range": BASE + "select incident_id, dq_range from checked",
    "dq_profile": BASE
    + "select dq_missing, dq_domain, dq_range, dq_corrupt, dq_valid, count(*) as n from checked group by all",
    "dq_totals": BASE
    + "select count(*) as total, count(*) filter (where dq_valid) as good, count(*) filter (where not dq_valid) as bad from checked",
    "valid_rows": BASE + f"select {ALL} from checked where dq_valid",
    "invalid_rows": BASE + f"select {ALL} from checked where not dq_valid",
    "split_valid_rows": BASE
    + f"select {ALL}, dq_missing, dq_domain, dq_range from checked where dq_valid",
    "quarantine_rows": BASE
    + f"select {ALL}, dq_missing, dq_domain, dq_range from checked where not dq_valid",
    "zero_valid_policy": BASE
    + "select side, count(*) as n, sum(incident_id)::bigint as id_sum from typed, (values ('valid'), ('quarantine')) s(side) group by side",
    "pipeline_warnings": BASE + "select incident_id, 'late file,rule failed' as pipe_warnings from typed",
    "lookup_map": BASE
    + f"select incident_id, {_case('weather', fixed.WEATHER_LABELS)} as weather_desc, {_case('light', fixed.LIGHT_LABELS)} as light_desc, {_case('incident_type', fixed.INCIDENT_TYPE_LABELS)} as incident_type_desc from typed",
    "lookup_broadcast": "select c_custkey, n_name as nation_name from customer left join nation on c_nationkey = n_nationkey",
    "lookup_large": "select coalesce(p_name, 'other') as part_name, count(*) as n from (select case when l_linenumber = 7 then -l_partkey else l_partkey end as code from lineitem) left join part on code = p_partkey group by 1",
    "lookup_salted": "select coalesce(p_name, 'other') as part_name, count(*) as n from (select case when l_orderkey % 3 = 0 then 1 else l_partkey end as code from lineitem) left join part on code = p_partkey group by 1",
    "codes_matching": "select distinct p_partkey from part where lower(p_name) like '%ring%' or lower(p_name) like '%bolt%'",
    "segment_flag": BASE
    + f"select incident_id, strategic, {SEGMENT} as segment_label from (select *, {STRATEGIC} as strategic from typed)",
    "day_flag": BASE
    + f"select incident_id, coalesce(light = 1, false) as is_day, {DAY} as day_label from typed",
    "kpi_mart": BASE + KPIS,
    "by_year": BASE + f"select yr, {FIGURES} from gold where yr is not null group by yr",
    "by_year_day": _mart(DAY, "day_label"),
    "by_year_light": _mart(LIGHT, "light_label"),
    "by_year_segment": _mart(SEGMENT, "segment_label"),
    "safe_ratio": BASE
    + "select hr, bad, good, case when good <> 0 then bad::double / good end as ratio from (select hr, count(*) filter (where not dq_valid) as bad, count(*) filter (where dq_valid) as good from checked group by hr)",
    "compare_years": BASE + f", {YEARLY}, long as ({_long('yearly', 'yr')}) " + _sides("long"),
    "compare_days": BASE
    + f", {DAILY}, long as ({_long('daily', 'yr, day_label')}) "
    + _sides("long", "day_label,"),
    "to_long": BASE + f", {YEARLY} " + _long("yearly", "yr"),
    "mode_of": BASE
    + "select weather, count(*) as n from typed where weather is not null group by weather order by n desc, weather limit 1",
    "max_key": BASE + f"select coalesce(max({_whole('incident_id', 'bigint')}), 0) as max_key from raw",
    "hash_uniform": f"select o_orderkey, {_uniform('uplift', 'o_orderkey')} as u from orders",
    "scenario_size": BASE
    + f"select yr, n, cast(round(n * {_clamped('(yr - 1998) * 0.03::double')}) as bigint) as n_out from (select yr, count(*) as n from typed group by yr)",
    "number_rows": "select o_orderkey, o_totalprice, row_number() over (order by o_totalprice, o_orderkey) - 1 as row_no from orders",
    "running_total": "select l_orderkey, l_linenumber, quantity, (sum(quantity) over (order by l_orderkey, l_linenumber, quantity rows unbounded preceding))::bigint as running_total from (select l_orderkey, l_linenumber, l_quantity::bigint as quantity from lineitem)",
    "bootstrap": f"""with {RAW},
      numbered as (select incident_id, casualties, row_number() over (order by incident_id) - 1 as row_no from raw),
      sized as (select count(*) as n from numbered),
      draws as (select range as draw_id from range((select 2 * n from sized)))
      select d.draw_id, b.incident_id, b.casualties from draws d, sized s, numbered b where b.row_no = {_hash('pick', 'd.draw_id', 15)} % s.n""",
    "sum_components": f"with {RAW}, {PARTS} select incident_id, greatest(0, fatal::int + serious::int + minor::int) as casualties from raw_parts",
    "uplift": f"""with {RAW}, {TYPED}, {TYPED_PARTS},
      gains as (select *, {_uniform('uplift', 'incident_id')} < {CHANCE} as gain from (select *, greatest(0, fatal + serious + minor) as before from typed_parts))
      select incident_id, case when gain then greatest(0, fatal + serious + minor + 1) else casualties end as casualties, fatal, serious, case when gain then minor + 1 else minor end as minor from gains""",
    "uplift_total_only": f"""with {RAW}, {TYPED},
      gains as (select *, {_uniform('uplift', 'incident_id')} < {CHANCE} as gain from (select *, coalesce(casualties, 0) as before from typed))
      select incident_id, case when gain then greatest(0, before + 1) else casualties end as casualties from gains""",
    "scenario_full": f"with {RAW}, {PARTS}, {SCENARIO} select * from scenario",
    "lineage": f"with {RAW} select incident_id, case when yr = '{BASE_YEAR}' then 'base' else 'scenario' end as folder, 1768372200::bigint as ingest_seconds from raw",
    "dq_corrupt": BASE + f"select incident_id, {CORRUPT} as dq_corrupt, false as passed from checked",
    "corrupt_sides": BASE
    + f"select case when dq_valid and {CORRUPT} = '' then 'valid' else 'quarantine' end as side, count(*) as n, count_if({CORRUPT} <> '') as n_corrupt from checked group by 1",
    "clustered_files": BASE
    + "select yr, count(*) as n, least(count(*), 100) as largest_file, case when count(*) % 100 > 0 then 1 else 0 end as short_files from typed group by yr",
    "exact_whole_numbers": "select o_orderkey, 9007199254740993 + o_orderkey as marked, 9007199254740993 + o_orderkey as plain, try_cast(9223372036854775807::hugeint + 3 - o_orderkey % 7 as bigint) as near_limit, o_orderkey % 1000 + 1 as half, null::bigint as word from orders",
    "run_metadata": BASE
    + f"""select {fixed.SCENARIO_SEED}::bigint as seed, 0.01::double as growth, count(*) as n_base,
      cast(round(count(*) * (1 + 0.01::double)) as bigint) as n_generated,
      (select count(*) from checked where yr = {BASE_YEAR} and {CORRUPT} <> '') as n_corrupt,
      '1' as day_codes, '6' as target_weather, '4,5' as target_light, '1' as target_zone
      from checked where yr = {BASE_YEAR} and {CORRUPT} = ''""",
    "percentiles": BASE
    + "select yr, quantile_cont(casualties, 0.25) as p25, quantile_cont(casualties, 0.5) as p50, quantile_cont(casualties, 0.9) as p90, quantile_cont(casualties, 0.99) as p99 from typed group by yr",
    "percentiles_by_rank": BASE
    + "select yr, round(quantile_cont(km, 0.25), 4) as p25, round(quantile_cont(km, 0.5), 4) as p50, round(quantile_cont(km, 0.9), 4) as p90, round(quantile_cont(km, 0.99), 4) as p99 from typed group by yr",
    "value_distribution": BASE + "select yr, casualties, count(*) as n from typed group by all",
    "zero_share": BASE
    + "select yr, avg(case when casualties = 0 then 1 else 0 end) as zero_share from typed group by yr",
    "calendar_labels": BASE
    + f"select {_case('mon', fixed.MONTH_LABELS)} as month_name, {_case('wday', fixed.WEEKDAY_LABELS)} as weekday_name, count(*) as n from typed group by all",
    "reduction_what_if": BASE
    + "select yr, strategic, sum(casualties)::bigint as casualties_total, round(sum(case when strategic then casualties * 0.7::double else casualties end), 4) as reduced_total from gold group by all",
    "pipeline_kpis": PIPELINE + KPIS,
    "pipeline_comparison": PIPELINE
    + f", {YEARLY}, long as ({_long('yearly', 'yr')}) "
    + _sides("long"),
}
