"""DuckDB twins of the registered queries (the correctness oracle).

country's day and a day's hours are lists or structs, where Spark uses windows and conditional aggregates.
Conventions shared with the Spark side:

* rounding: ``R(x, n)`` rounds the shortest decimal representation half away from zero,
  which is what Spark's ``round`` on DOUBLE does;
* averages of 2-decimal values are exact (integer cents);
* every integer column is BIGINT, timestamps are naive UTC.
"""

from __future__ import annotations

from gridmix import dims
from gridmix.sources import fixtures as fx


def R(expr: str, n: int) -> str:
    return f"cast(round(cast(cast(({expr}) as varchar) as decimal(38,18)), {n}) as double)"


def exact_avg_sql(expr: str, scale: int = 2, digits: int | None = None) -> str:
    """Average of ``scale``-decimal values rounded half away from zero to ``digits`` decimals,
    in integer arithmetic (the Spark side sums decimals)."""
    digits = scale + 4 if digits is None else digits
    units = f"sum(cast(round(({expr}) * {10 ** scale}) as bigint))"
    if digits >= scale:
        q = f"{units} * {10 ** (digits - scale)}.0 / count({expr})"
    else:
        q = f"{units} / ({10 ** (scale - digits)}.0 * count({expr}))"
    return f"(round({q}) / {10 ** digits}.0)"


def exact_avg_round_sql(expr: str, digits: int, scale: int = 2) -> str:
    return exact_avg_sql(expr, scale, digits)


def _case_map(col: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in sorted(mapping.items()))
    return f"case {col} {whens} else {default} end"


def _sql_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def country_name_sql(col: str) -> str:
    return _case_map(col, dims.COUNTRY_NAME, col)


def psr_name_sql(col: str) -> str:
    return _case_map(col, dims.PSR_TO_SOURCE, f"'Unknown (' || {col} || ')'")


DIM_ES = "dim_es(energy_source, psr_code, fuel_category, is_renewable, emission_factor_gco2_kwh) as (values " + \
    ", ".join(f"('{n}', '{c}', '{f}', {str(r).lower()}, {e})" for n, c, f, r, e in dims.ENERGY_SOURCES) + ")"

DIM_COUNTRY = ("dim_country(country_code, country_name, entsoe_code, region, grid_operator, installed_wind_mw, "
               "installed_solar_mw, eu_member, target_pct) as (values " +
               ", ".join(f"('{a}', '{b}', '{c}', '{d}', '{e}', {f}, {g}, {str(h).lower()}, {i})"
                         for a, b, c, d, e, f, g, h, i in dims.COUNTRIES) + ")")

GEN_BASE = f"""gen_base as (
  select {fx.EPOCH_START_NS} + (event_id % 168) * {fx.HOUR_NS}
       + cast(floor(event_id / 10000) as bigint) * {fx.WEEK_NS}
       + (cast(floor(event_id / 168) as bigint) % 4) * {fx.QUARTER_NS} as ts_ns,
    substr('{fx.GEN_COUNTRIES}', cast(1 + 2 * (user_id % 9) as int), 2) as country,
    'B' || lpad(cast(1 + (cast(floor(event_id / 336) as bigint) + event_id) % 21 as varchar), 2, '0') as psr_type,
    case when event_id % 11 = 0 then null when event_id % 13 = 0 then cast(-1 as double)
         else floor(value * 4) / 4 end as actual_MW,
    case when event_id % 11 = 0 or event_id % 17 = 0 then floor(value * 8) / 8 end as forecast_MW,
    case when event_id % 11 = 0 then 'forecast' else 'generation' end as domain
  from events)"""

GEN_RAW = f"""gen_raw as (
  select ts_ns as "timestamp", country, {psr_name_sql('psr_type')} as energy_source, psr_type,
         actual_MW, forecast_MW, domain
  from gen_base)"""

# A key's best row comes out of an ordered aggregate over its rows as structs.
STG = f"""hour_keys as (
  select date_trunc('hour', make_timestamp("timestamp" // 1000)) as ts_hour, country as country_code, energy_source,
         first({{'psr': psr_type, 'a': nullif(actual_MW, 'nan'::double), 'f': nullif(forecast_MW, 'nan'::double)}}
               order by nullif(actual_MW, 'nan'::double) desc nulls last,
                        nullif(forecast_MW, 'nan'::double) desc nulls last, psr_type nulls last) as best
  from gen_raw
  where "timestamp" is not null
    and greatest(nullif(actual_MW, 'nan'::double), nullif(forecast_MW, 'nan'::double)) >= 0
  group by all),
stg as (
  select ts_hour, country_code, {country_name_sql('country_code')} as country_name, ts_hour::date as date_key,
         hour(ts_hour) as hour_of_day, month(ts_hour) as month_of_year, energy_source, best.psr as psr_code,
         best.a as actual_mw, best.f as forecast_mw, coalesce(best.a, best.f) as generation_mw,
         if(best.a is null or best.f is null, null, abs(best.a - best.f) / greatest(best.f, 0.01))
           as forecast_error_pct
  from hour_keys)"""

# A country's day is one list of its sources; the day's total is the list's sum.
IDG = f"""source_days as (
  select date_key, country_code, any_value(country_name) as country_name,
         {{'source': energy_source, 'mean': {R('avg(actual_mw)', 2)}, 'most': {R('max(actual_mw)', 2)},
           'least': {R('min(actual_mw)', 2)}, 'mwh': {R('sum(actual_mw)', 2)}, 'hours': count(*)}} as part
  from stg group by date_key, country_code, energy_source),
country_days as (
  select date_key, country_code, any_value(country_name) as country_name, list(part) as parts,
         sum(part.mwh) as mwh from source_days group by all),
idg as (
  select date_key, country_code, country_name, p.source as energy_source, p.mean as avg_hourly_mw,
         p.most as max_hourly_mw, p.least as min_hourly_mw, p.mwh as total_mwh, p.hours as hours_reported,
         mwh as total_mwh_all_sources, {R('p.mwh * 100.0 / greatest(mwh, 0.001)', 2)} as pct_of_total
  from (select * exclude (parts), unnest(parts) as p from country_days))"""

_GREEN = f"energy_source in ({_sql_list(dims.KPI_RENEWABLE_NAMES)})"
KPI = f"""kpi as (
  select date_key, country_code, any_value(country_name) as country_name,
         if(sum(total_mwh) is null, null, {R(f"""coalesce(sum(total_mwh) filter ({_GREEN}), 0) * 100.0
            / greatest(sum(total_mwh), 0.001)""", 2)}) as renewable_pct,
         {R(f"coalesce(sum(total_mwh) filter ({_GREEN}), 0)", 2)} as renewable_mwh,
         {R('sum(total_mwh)', 2)} as total_mwh,
         count(*) filter ({_GREEN}) as renewable_sources_active, count(*) as total_sources_active
  from idg group by date_key, country_code)"""

# Factors come from a map by source name; a source that it lacks counts with 0 and as not renewable.
CI = f"""{DIM_ES},
factors as (
  select map(list(energy_source), list(emission_factor_gco2_kwh)) as of_source,
         list(energy_source) filter (is_renewable) as green from dim_es),
loads as (
  select ts_hour, date_key, hour_of_day, country_code, country_name, actual_mw as mw, coalesce(of_source[energy_source], 0) as factor,
         list_contains(green, energy_source) as is_green
  from stg, factors where actual_mw > 0),
ci as (
  select ts_hour, date_key, hour_of_day, country_code, country_name,
         {R('sum(mw * factor) / greatest(sum(mw), 0.001)', 2)} as carbon_intensity_gco2_kwh,
         {R('sum(mw)', 2)} as total_mw, {R('coalesce(sum(mw) filter (is_green), 0)', 2)} as renewable_mw,
         {R('coalesce(sum(mw * factor) filter (not is_green), 0)', 2)} as total_co2_grams_per_hour
  from loads group by ts_hour, date_key, hour_of_day, country_code, country_name)"""

# A day's hours form one list by rising intensity: its ends are the extreme hours.
FCT_CI = f"""ci_days as (
  select date_key, country_code, any_value(country_name) as country_name, count(*) as hours_reported,
         {exact_avg_round_sql('carbon_intensity_gco2_kwh', 2)} as mean_intensity,
         {R('avg(renewable_mw * 100.0 / greatest(total_mw, 0.001))', 2)} as avg_renewable_pct,
         list({{'i': carbon_intensity_gco2_kwh, 'h': hour_of_day}}
              order by carbon_intensity_gco2_kwh, hour_of_day) as rising
  from ci group by date_key, country_code),
ci_ends as (
  select * exclude (rising), rising[1] as low,
         list_filter(rising, lambda r: r.i = rising[-1].i)[1] as high from ci_days),
habits as (
  select country_code, arg_max(h, days * 100 - h) as typical_cleanest_hour
  from (select country_code, low.h as h, count(*) as days from ci_ends group by all) group by country_code),
fct_ci as (
  select date_key, country_code, country_name, mean_intensity as avg_carbon_intensity_gco2_kwh,
         low.i as min_carbon_intensity_gco2_kwh, high.i as max_carbon_intensity_gco2_kwh, avg_renewable_pct,
         hours_reported, low.h as cleanest_hour_of_day, low.i as cleanest_hour_intensity,
         high.h as dirtiest_hour_of_day, high.i as dirtiest_hour_intensity,
         {R('high.i - low.i', 2)} as daily_intensity_range_gco2_kwh, typical_cleanest_hour
  from (select * rename (country_code as home) from habits) join ci_ends on home is not distinct from country_code)"""

# --- weather ---------------------------------------------------------------------------------

WEATHER_RAW = f"""weather_base as (
  select {fx.EPOCH_START_NS} + cast(floor(vec_id / 4) as bigint) * {fx.HOUR_NS} as ts_ns,
         cast(40 + 0.25 * ((p - 1) // 8) as double) as lat, cast(20 + 0.25 * ((p - 1) % 8) as double) as lon,
         list_extract(['u100', 'v100', 'ssrd', 't2m'], cast(1 + vec_id % 4 as int)) as variable,
         floor(cast(embedding[p] as double) * 1024) / 1024 as v,
         substr('{fx.GRID_COUNTRIES}', cast(1 + 2 * ((p - 1) % 8) as int), 2) as country
  from embeddings, unnest(range(1, len(embedding) + 1)) t(p)),
weather_raw as (
  select ts_ns as "timestamp", lat, lon, variable,
         case when variable in ('u100', 'v100') then v * 16 when variable = 'ssrd' then abs(v) * 4194304
              else 283.15 + v * 16 end as value,
         country
  from weather_base)"""

# One row per cell with all variables by name; wind and solar read it.
CELLS = f"""cells as (
  select make_timestamp("timestamp" // 1000) as ts_hour, lat, lon, country as country_code,
         {country_name_sql('country')} as country_name,
         {", ".join(f"max(value) filter (variable = '{v}') as {v}" for v in ('u100', 'v100', 'ssrd', 'tcc', 't2m'))},
         bool_or(variable in ('u100', 'v100')) as windy, bool_or(variable in ('ssrd', 'tcc', 't2m')) as sunny
  from weather_raw where "timestamp" is not null and value is not null and not isnan(value)
  group by "timestamp", lat, lon, country)"""

_CELL = "ts_hour, ts_hour::date as date_key, hour(ts_hour) as hour_of_day, lat, lon, country_code, country_name"
WIND = f"""wind as (
  select {_CELL}, u100 as wind_100m_u, v100 as wind_100m_v, sqrt(u100 * u100 + v100 * v100) as wind_speed_100m,
         atan2(v100, u100) * 180 / 3.14159265 as wind_direction_degrees
  from cells where windy)"""

SOLAR = f"""solar as (
  select {_CELL}, ssrd as solar_radiation_jm2, tcc as cloud_cover_fraction, t2m as temp_2m_kelvin,
         {R('t2m - 273.15', 2)} as temp_2m_celsius, {R('coalesce(ssrd / 3600.0, 0)', 2)} as solar_radiation_wm2
  from cells where sunny)"""

GW = f"""country_hours as (
  select ts_hour, country_code, max(w) as avg_wind_speed, max(r) as avg_solar_radiation, max(t) as avg_temp
  from (select ts_hour, country_code, avg(wind_speed_100m) as w, null::double as r, null::double as t
        from wind group by all
        union all
        select ts_hour, country_code, null, {exact_avg_sql('solar_radiation_wm2')},
               {exact_avg_sql('temp_2m_celsius')} from solar group by all)
  group by all),
gw as (
  select ts_hour, date_key, hour_of_day, country_code, country_name, energy_source, actual_mw, avg_wind_speed,
         avg_solar_radiation, avg_temp
  from stg left join country_hours using (ts_hour, country_code))"""


def with_ctes(*ctes: str, select: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + select


# Chains: each model's CTE list (dependencies first).
STG_CHAIN = [GEN_BASE, GEN_RAW, STG]
IDG_CHAIN = STG_CHAIN + [IDG]
KPI_CHAIN = IDG_CHAIN + [KPI]
CI_CHAIN = STG_CHAIN + [CI]
FCT_CI_CHAIN = CI_CHAIN + [FCT_CI]
WEATHER_CHAIN = [WEATHER_RAW, CELLS]
GW_CHAIN = STG_CHAIN + [WEATHER_RAW, CELLS, WIND, SOLAR, GW]
