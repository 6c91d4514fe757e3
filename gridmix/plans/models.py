"""The warehouse models as named queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix import dims, session, sinks
from gridmix import operators as ops
from gridmix.plans.catalog import query
from gridmix.sources import load_gen_raw, load_weather_raw
from gridmix.verify import oracle as o


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.stg_generation(load_gen_raw(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.int_daily_generation(staged(spark, sf_dir))


def kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.fct_renewable_kpi(daily(spark, sf_dir))


def hourly_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.int_carbon_intensity(staged(spark, sf_dir), dims.dim_energy_source(spark))


def grid_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.fct_grid_carbon_intensity(hourly_ci(spark, sf_dir))


def gen_weather(spark: SparkSession, sf_dir: str, stg: DataFrame | None = None) -> DataFrame:
    cells = ops.weather_cells(load_weather_raw(spark, sf_dir))
    return ops.int_generation_weather(staged(spark, sf_dir) if stg is None else stg, ops.hourly_weather(cells))


@query("stg_generation", o.with_ctes(*o.STG_CHAIN, select="select * from stg"))
def q_stg_generation(spark, sf_dir):
    """Staged generation: typed, filtered, de-duplicated per (hour, country, source)."""
    return staged(spark, sf_dir)


@query("int_daily_generation", o.with_ctes(*o.IDG_CHAIN, select="select * from idg"))
def q_int_daily_generation(spark, sf_dir):
    """Daily generation statistics per country and source with the share of the day's total."""
    return daily(spark, sf_dir)


@query("fct_renewable_kpi", o.with_ctes(*o.KPI_CHAIN, select="select * from kpi"))
def q_fct_renewable_kpi(spark, sf_dir):
    """How green was each country each day: renewable share of generation."""
    return kpi(spark, sf_dir)


@query("int_carbon_intensity", o.with_ctes(*o.CI_CHAIN, select="select * from ci"))
def q_int_carbon_intensity(spark, sf_dir):
    """Hourly generation-weighted carbon intensity per country."""
    return hourly_ci(spark, sf_dir)


@query("fct_grid_carbon_intensity", o.with_ctes(*o.FCT_CI_CHAIN, select="select * from fct_ci"))
def q_fct_grid_carbon_intensity(spark, sf_dir):
    """Daily carbon intensity with cleanest / dirtiest hours per country."""
    return grid_ci(spark, sf_dir)


@query("typical_cleanest_hour", o.with_ctes(*o.FCT_CI_CHAIN, select="select * from habits"))
def q_typical_cleanest_hour(spark, sf_dir):
    """Per country, the hour of day that is most often the cleanest."""
    return ops.typical_cleanest_hour(ops.daily_intensity(hourly_ci(spark, sf_dir)))


@query("stg_wind", o.with_ctes(*o.WEATHER_CHAIN, o.WIND, select=f"""select * replace
  ({o.R('wind_direction_degrees', 6)} as wind_direction_degrees) from wind"""))
def q_stg_wind(spark, sf_dir):
    """Weather cells with wind components, speed and direction (compared to 1e-6 degree: atan2 differs in
    the last digit between libraries)."""
    return ops.stg_wind(load_weather_raw(spark, sf_dir)).withColumn(
        "wind_direction_degrees", F.round("wind_direction_degrees", 6))


@query("stg_solar", o.with_ctes(*o.WEATHER_CHAIN, o.SOLAR, select="select * from solar"))
def q_stg_solar(spark, sf_dir):
    """Weather cells with radiation, cloud cover and temperature."""
    return ops.stg_solar(load_weather_raw(spark, sf_dir))


@query("int_generation_weather", o.with_ctes(*o.GW_CHAIN, select=f"""select * replace
  ({o.R('avg_wind_speed', 6)} as avg_wind_speed) from gw"""))
def q_int_generation_weather(spark, sf_dir):
    """Hourly generation rows joined with country-hour wind and solar weather (wind speed compared to 1e-6:
    float means depend on the order of their rows)."""
    return gen_weather(spark, sf_dir).withColumn("avg_wind_speed", F.round("avg_wind_speed", 6))


#: Buckets of the co-located tables; at scale about the staged bytes / 128 MB.
BUCKETS = 8


@query("colocated_weather", o.with_ctes(*o.GW_CHAIN, select=f"""select * replace
  ({o.R('avg_wind_speed', 6)} as avg_wind_speed) from gw"""))
def q_colocated_weather(spark, sf_dir):
    """The generation-weather join over tables kept in the same buckets by country and hour: neither is shuffled again, in
    this join or in any later one on these keys."""
    keys = ["country_code", "ts_hour"]
    base = session.work_dir(spark, "buckets")
    stg = sinks.write_bucketed(spark, staged(spark, sf_dir), f"{base}/stg", keys, BUCKETS)
    hourly = ops.hourly_weather(ops.weather_cells(load_weather_raw(spark, sf_dir)))
    hourly = sinks.write_bucketed(spark, hourly, f"{base}/weather", keys, BUCKETS)
    joined = ops.int_generation_weather(stg, hourly.hint("merge"))
    return joined.withColumn("avg_wind_speed", F.round("avg_wind_speed", 6))


def int_daily_from(stg: DataFrame) -> DataFrame:
    return ops.int_daily_generation(stg)


def hourly_ci_from(stg: DataFrame, spark: SparkSession) -> DataFrame:
    return ops.int_carbon_intensity(stg, dims.dim_energy_source(spark))


ALIGNED_CTES = ["""al_src as (
    select date_trunc('hour', make_timestamp("timestamp" // 1000)) as ts_hour, country as country_code, energy_source,
           case when isnan(actual_MW) then null else actual_MW end as a,
           case when isnan(forecast_MW) then null else forecast_MW end as f, domain
    from gen_raw where "timestamp" is not null)""",
    """al_act as (select ts_hour, country_code, energy_source, max(a) as actual_mw from al_src
          where domain <> 'forecast' and a >= 0 group by 1, 2, 3)""",
    """al_fc as (select ts_hour, country_code, energy_source, max(f) as forecast_mw from al_src
         where domain = 'forecast' and f >= 0 group by 1, 2, 3)""",
    """al_j as (select coalesce(a.ts_hour, f.ts_hour) as ts_hour, coalesce(a.country_code, f.country_code) as country_code,
               coalesce(a.energy_source, f.energy_source) as energy_source, a.actual_mw, f.forecast_mw
        from al_act a full outer join al_fc f on a.ts_hour = f.ts_hour and a.country_code = f.country_code
                                          and a.energy_source = f.energy_source)"""]


@query("stg_generation_aligned", o.with_ctes(*o.STG_CHAIN[:2], *ALIGNED_CTES, select=f"""
  select ts_hour, country_code, {o.country_name_sql('country_code')} as country_name, cast(ts_hour as date) as date_key,
         cast(hour(ts_hour) as bigint) as hour_of_day, energy_source, actual_mw, forecast_mw,
         coalesce(actual_mw, forecast_mw) as generation_mw,
         case when actual_mw is not null and forecast_mw is not null
              then abs(actual_mw - forecast_mw) / greatest(forecast_mw, 0.01) end as forecast_error_pct
  from al_j"""))
def q_stg_generation_aligned(spark, sf_dir):
    """Staging with actual and forecast aligned on one row per (hour, country, source)."""
    return ops.align_forecast(load_gen_raw(spark, sf_dir))
