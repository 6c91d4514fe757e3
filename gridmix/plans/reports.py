"""End-user report queries (dashboard SQL, dashboard chart specs, README checks).

Every report reads a model DataFrame and returns a small result; the heavy lifting is in the
models.  Scalars such as "the latest date" are Spark scalar subqueries (evaluated once, then
used as a filter), never driver collects.  Averages of fixed-precision values use exact
decimal arithmetic (``functions.exact_avg``) so results do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix import dims
from gridmix import functions as gf
from gridmix.plans import models as m
from gridmix.session import materialize
from gridmix.plans.catalog import query
from gridmix.verify import oracle as o
from gridmix.verify.oracle import R, exact_avg_sql as XA


def _ym(c: str = "date_key"):
    return F.date_format(F.col(c), "yyyy-MM")


# --------------------------------------------------------------------------------------------
# Report transforms (DataFrame -> DataFrame)
# --------------------------------------------------------------------------------------------

def overview_kpis(kpi: DataFrame) -> DataFrame:
    """Latest day: mean renewable %, renewable / total GWh, countries reporting and the top
    country (ties: name).

    One pass: the KPIs are aggregated per date (the top country as a min over a
    (null-last, -pct, name) struct) and the newest date's row is kept with a top-1 — a
    map-side partial top-k, so neither a scalar subquery (a second run of the pipeline) nor a
    join nor a single-partition window is needed."""
    pct = F.col("renewable_pct")
    top = F.min(F.struct(pct.isNull().alias("n"), (-pct).alias("neg"), F.col("country_name").alias("name"),
                         pct.alias("pct")))
    per_day = kpi.groupBy("date_key").agg(
        gf.exact_avg(pct, 2, 1).alias("avg_renewable_pct_all_countries"),
        F.round(F.sum("renewable_mwh") / 1000, 1).alias("total_renewable_gwh"),
        F.round(F.sum("total_mwh") / 1000, 1).alias("total_gwh"),
        F.count(F.lit(1)).alias("countries_reporting"),
        top.alias("_top"),
    )
    return per_day.orderBy(F.col("date_key").desc()).limit(1).select(
        "avg_renewable_pct_all_countries", "total_renewable_gwh", "total_gwh", "countries_reporting",
        F.col("_top.name").alias("top_country"), F.round(F.col("_top.pct"), 1).alias("top_country_pct"),
    )


def renewable_ranking(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        "country_name", "date_key", F.round("renewable_pct", 1).alias("renewable_pct"),
        F.round("renewable_mwh", 0).alias("renewable_mwh"), F.round("total_mwh", 0).alias("total_mwh"),
        "renewable_sources_active", "total_sources_active",
    ).orderBy(F.col("renewable_pct").desc(), "country_name", "date_key")


def country_comparison(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        "country_name", "date_key", F.round("renewable_pct", 1).alias("renewable_pct"),
        gf.to_gwh("renewable_mwh").alias("renewable_gwh"), gf.to_gwh("total_mwh").alias("total_gwh"),
    ).orderBy(F.col("date_key").desc(), F.col("renewable_pct").desc(), "country_name")


def fuel_breakdown(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("total_mwh") > 0).select(
        "date_key", "country_name", "energy_source", gf.to_gwh("total_mwh").alias("total_gwh"),
        F.round("pct_of_total", 1).alias("pct_of_total"),
    ).orderBy(F.col("date_key").desc(), F.col("pct_of_total").desc(), "country_name", "energy_source")


def renewable_trends(kpi: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Trailing window of ``days`` days up to ``as_of`` (default: the latest date in the data,
    a scalar subquery — reports never depend on the wall clock)."""
    anchor = F.lit(as_of).cast("date") if as_of is not None else kpi.select(F.max("date_key")).scalar()
    recent = kpi.where(F.col("date_key") >= F.date_sub(anchor, days))
    return recent.select(
        "country_name", "date_key", F.round("renewable_pct", 1).alias("renewable_pct"),
        gf.to_gwh("renewable_mwh").alias("renewable_gwh"), gf.to_gwh("total_mwh").alias("total_gwh"),
    ).orderBy("country_name", "date_key")


def weather_correlation(gw: DataFrame) -> DataFrame:
    """Daily generation vs weather per country.  Each hour's weather is counted once (the
    hourly rows are first collapsed per country-hour, where the weather is constant).  One
    repartition by (date, country) — bounded groups after de-duplication — serves both
    aggregations."""
    ren = gf.is_renewable_name("energy_source")
    hourly = gw.repartition("date_key", "country_code").groupBy("date_key", "country_code", "country_name", "ts_hour").agg(
        F.sum("actual_mw").alias("mwh"),
        F.sum(F.when(ren, F.col("actual_mw"))).alias("ren_mwh"),
        F.max("avg_wind_speed").alias("wind"), F.max("avg_solar_radiation").alias("solar"),
        F.max("avg_temp").alias("temp"),
    )
    day = hourly.groupBy("date_key", "country_code", "country_name").agg(
        F.sum("mwh").alias("total_mwh"), F.sum("ren_mwh").alias("renewable_mwh"),
        gf.exact_avg("wind", 6, 1).alias("avg_wind_speed_ms"),
        gf.exact_avg("solar", 6, 0).alias("avg_solar_radiation_wm2"),
        gf.exact_avg("temp", 6, 1).alias("avg_temp_celsius"),
    )
    return day.where(F.col("total_mwh") > 0).select(
        "date_key", "country_name", gf.to_gwh("total_mwh").alias("total_gwh"),
        gf.to_gwh("renewable_mwh").alias("renewable_gwh"), "avg_wind_speed_ms", "avg_solar_radiation_wm2",
        "avg_temp_celsius",
    ).orderBy(F.col("date_key").desc(), "country_name")


def carbon_intensity_heatmap(fct: DataFrame) -> DataFrame:
    return fct.groupBy("country_name", _ym().alias("year_month")).agg(
        gf.exact_avg("avg_carbon_intensity_gco2_kwh", 2, 1).alias("avg_carbon_intensity_gco2_kwh"),
        gf.exact_avg("avg_renewable_pct", 2, 1).alias("avg_renewable_pct"),
    ).orderBy("country_name", "year_month")


def carbon_heatmap_wide(fct: DataFrame, months: list[str]) -> DataFrame:
    """Country x month matrix (one column per listed month, explicit so no extra job)."""
    long = carbon_intensity_heatmap(fct)
    return long.groupBy("country_name").pivot("year_month", months).agg(F.first("avg_carbon_intensity_gco2_kwh"))


def kpi_scorecards(kpi: DataFrame) -> DataFrame:
    return kpi.agg(
        gf.exact_avg("renewable_pct", 2, 2).alias("avg_renewable_pct"),
        F.sum("total_mwh").alias("total_mwh"),
        F.count_distinct("country_code").alias("countries_reporting"),
    )


def fossil_renewable_split(kpi: DataFrame) -> DataFrame:
    ren = gf.exact_avg("renewable_pct", 2, 2)
    return kpi.groupBy("country_name").agg(ren.alias("renewable_pct")).select(
        "country_name", "renewable_pct", F.round(F.lit(100.0) - F.col("renewable_pct"), 2).alias("fossil_nuclear_pct"),
    ).orderBy(F.col("renewable_pct").desc(), "country_name")


def top_energy_sources(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("energy_source").rlike(".+")).groupBy("country_name", "energy_source").agg(
        F.sum("total_mwh").alias("total_mwh"), gf.exact_avg("pct_of_total", 2, 2).alias("pct_of_total"),
    ).orderBy(F.col("total_mwh").desc(), "country_name", "energy_source")


def fuel_mix(daily: DataFrame) -> DataFrame:
    """Generation per country and source with the source's share of the country total."""
    by_source = daily.groupBy("country_name", "energy_source").agg(F.sum("total_mwh").alias("total_mwh"))
    country_total = F.sum("total_mwh").over(Window.partitionBy("country_name"))
    return by_source.select(
        "country_name", "energy_source", "total_mwh",
        gf.safe_share_pct(F.col("total_mwh"), country_total).alias("share_pct"),
    )


def fuel_comparison(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("energy_source").isin(dims.DASHBOARD_COMPARISON_SOURCES)) \
        .groupBy("country_name", "energy_source") \
        .agg(gf.exact_avg("pct_of_total", 2, 2).alias("pct_of_total")) \
        .orderBy("country_name", "energy_source")


def fuel_category_by_month(daily: DataFrame, dim_energy_source: DataFrame) -> DataFrame:
    dim = F.broadcast(dim_energy_source.select("energy_source", "fuel_category"))
    return daily.join(dim, "energy_source", "left").groupBy(
        _ym().alias("year_month"), "country_name", "fuel_category",
    ).agg(F.sum("total_mwh").alias("total_mwh"))


def fuel_group_by_month(daily: DataFrame) -> DataFrame:
    return daily.groupBy(_ym().alias("year_month"), "country_name", gf.fuel_group("energy_source").alias("fuel_group")) \
        .agg(F.sum("total_mwh").alias("total_mwh"))


def trendline(gw: DataFrame, sources: list[str], x: str, y: str = "actual_mw") -> DataFrame:
    """Per-country linear fit of generation on a weather variable over the hourly rows."""
    rows = gw.where(F.col("energy_source").isin(sources))
    X, Y = F.col(x), F.col(y)
    return rows.groupBy("country_name").agg(
        F.regr_count(Y, X).alias("n_points"),
        gf.exact_avg(x, 6, 6).alias("avg_x"),
        F.avg(Y).alias("avg_y"),
        F.round(F.regr_slope(Y, X), 6).alias("slope"),
        F.round(F.regr_intercept(Y, X), 6).alias("intercept"),
        F.round(F.regr_r2(Y, X), 6).alias("r2"),
        F.round(F.corr(X, Y), 6).alias("corr"),
    )


def weather_by_month(gw: DataFrame) -> DataFrame:
    return gw.groupBy(_ym().alias("year_month"), "country_name").agg(
        gf.exact_avg("avg_wind_speed", 6, 6).alias("avg_wind_speed"),
        gf.exact_avg("avg_solar_radiation", 6, 6).alias("avg_solar_radiation"),
    ).orderBy("year_month", "country_name")


def renewable_vs_wind(kpi: DataFrame, gw: DataFrame) -> DataFrame:
    """Blend: daily renewable % (left) with daily onshore-wind speed (right), both aggregated
    to (date, country) first, left outer join, then averaged per month."""
    left = kpi.select("date_key", "country_code", "renewable_pct")
    right = gw.where(F.col("energy_source") == "Wind Onshore").groupBy("date_key", "country_code").agg(
        gf.exact_avg("avg_wind_speed", 6, 6).alias("avg_wind_speed"))
    blend = left.join(right, ["date_key", "country_code"], "left")
    return blend.groupBy(_ym().alias("year_month")).agg(
        gf.exact_avg("renewable_pct", 2, 2).alias("renewable_pct"),
        gf.exact_avg("avg_wind_speed", 6, 6).alias("avg_wind_speed"),
    ).orderBy("year_month")


def weather_efficiency(gw: DataFrame) -> DataFrame:
    """MW generated per m/s of wind, as the ratio of the averages (zero wind -> NULL)."""
    rows = gw.where(F.col("energy_source").isin(dims.WEATHER_EFFICIENCY_SOURCES))
    agg = rows.groupBy("country_name", "energy_source").agg(
        gf.exact_avg("avg_wind_speed", 6, 6).alias("avg_wind_speed"),
        gf.exact_avg("avg_solar_radiation", 6, 6).alias("avg_solar_radiation"),
        F.avg("actual_mw").alias("avg_actual_mw"),
    )
    return agg.withColumn("mw_per_ms", F.try_divide(F.col("avg_actual_mw"), F.col("avg_wind_speed"))) \
        .orderBy(F.col("mw_per_ms").desc_nulls_last(), "country_name", "energy_source")


def carbon_by_country(fct: DataFrame) -> DataFrame:
    return fct.groupBy("country_name").agg(
        gf.exact_avg("avg_carbon_intensity_gco2_kwh", 2, 2).alias("avg_carbon_intensity_gco2_kwh"),
    ).orderBy(F.col("avg_carbon_intensity_gco2_kwh").desc(), "country_name")


def carbon_by_month(fct: DataFrame) -> DataFrame:
    return fct.groupBy(_ym().alias("year_month"), "country_name").agg(
        gf.exact_avg("avg_carbon_intensity_gco2_kwh", 2, 2).alias("avg_carbon_intensity_gco2_kwh"),
    ).orderBy("year_month", "country_name")


def cleanest_hour_table(fct: DataFrame) -> DataFrame:
    return fct.groupBy("country_name").agg(
        gf.exact_avg("avg_carbon_intensity_gco2_kwh", 2, 2).alias("avg_carbon_intensity_gco2_kwh"),
        F.max("typical_cleanest_hour").alias("typical_cleanest_hour"),
        gf.exact_avg("min_carbon_intensity_gco2_kwh", 2, 2).alias("best_carbon_intensity_gco2_kwh"),
        gf.exact_avg("daily_intensity_range_gco2_kwh", 2, 2).alias("avg_daily_range_gco2_kwh"),
    ).orderBy("avg_carbon_intensity_gco2_kwh", "country_name")


def sanity_check(kpi: DataFrame) -> DataFrame:
    return kpi.agg(F.max("date_key").alias("latest_date"), F.sum("total_mwh").alias("total_mwh"),
                   F.sum("renewable_mwh").alias("renewable_mwh"))


def target_gap(kpi: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Distance to the 2030 renewable target: target minus the mean daily renewable share."""
    per_country = kpi.groupBy("country_code", "country_name").agg(
        gf.exact_avg("renewable_pct", 2, 2).alias("avg_renewable_pct"), F.count(F.lit(1)).alias("days"))
    dim = F.broadcast(dim_country.select("country_code", F.col("`2030_renewable_target_pct`").alias("target_pct")))
    return per_country.join(dim, "country_code", "left").select(
        "country_code", "country_name", "days", "avg_renewable_pct", "target_pct",
        F.round(F.col("target_pct") - F.col("avg_renewable_pct"), 2).alias("gap_pct"),
    )


# --------------------------------------------------------------------------------------------
# Registration (Spark query + DuckDB twin)
# --------------------------------------------------------------------------------------------

def chain(*parts: list[str]) -> list[str]:
    out: list[str] = []
    for p in parts:
        for cte in p:
            if cte not in out:
                out.append(cte)
    return out


KPI, IDG, FCT, GW = o.KPI_CHAIN, o.IDG_CHAIN, o.FCT_CI_CHAIN, o.GW_CHAIN
YM = "strftime(date_key, '%Y-%m')"
REN = o._sql_list(dims.RENEWABLE_SOURCES)


def Q(parts, select):
    return o.with_ctes(*parts, select=select)


@query("overview_kpis", Q(KPI, f"""
  select k.*, t.top_country, t.top_country_pct from
  (select {XA('renewable_pct', 2, 1)} as avg_renewable_pct_all_countries,
          {R('sum(renewable_mwh) / 1000', 1)} as total_renewable_gwh, {R('sum(total_mwh) / 1000', 1)} as total_gwh,
          count(*) as countries_reporting
   from kpi where date_key = (select max(date_key) from kpi)) k,
  (select country_name as top_country, {R('renewable_pct', 1)} as top_country_pct
   from kpi where date_key = (select max(date_key) from kpi)
   order by renewable_pct desc nulls last, country_name limit 1) t"""))
def q_overview_kpis(spark, sf_dir):
    """Latest-day summary KPIs and the greenest country."""
    return overview_kpis(m.kpi(spark, sf_dir))


@query("renewable_ranking", Q(KPI, f"""
  select country_name, date_key, {R('renewable_pct', 1)} as renewable_pct, {R('renewable_mwh', 0)} as renewable_mwh,
         {R('total_mwh', 0)} as total_mwh, renewable_sources_active, total_sources_active from kpi"""))
def q_renewable_ranking(spark, sf_dir):
    """Country-days ranked by renewable share (full history)."""
    return renewable_ranking(m.kpi(spark, sf_dir))


@query("country_comparison", Q(KPI, f"""
  select country_name, date_key, {R('renewable_pct', 1)} as renewable_pct,
         {R('renewable_mwh / 1000', 1)} as renewable_gwh, {R('total_mwh / 1000', 1)} as total_gwh from kpi"""))
def q_country_comparison(spark, sf_dir):
    """Renewable share by country over time."""
    return country_comparison(m.kpi(spark, sf_dir))


@query("fuel_breakdown", Q(IDG, f"""
  select date_key, country_name, energy_source, {R('total_mwh / 1000', 1)} as total_gwh,
         {R('pct_of_total', 1)} as pct_of_total from idg where total_mwh > 0"""))
def q_fuel_breakdown(spark, sf_dir):
    """Daily generation by energy source per country."""
    return fuel_breakdown(m.daily(spark, sf_dir))


@query("renewable_trends", Q(KPI, f"""
  select country_name, date_key, {R('renewable_pct', 1)} as renewable_pct,
         {R('renewable_mwh / 1000', 1)} as renewable_gwh, {R('total_mwh / 1000', 1)} as total_gwh
  from kpi where date_key >= (select max(date_key) from kpi) - interval 30 day"""))
def q_renewable_trends(spark, sf_dir):
    """Renewable share over the trailing 30 days (anchored at the latest date)."""
    return renewable_trends(materialize(m.kpi(spark, sf_dir)))


@query("weather_correlation", Q(GW, f"""
  select date_key, country_name, {R('total_mwh / 1000', 1)} as total_gwh, {R('renewable_mwh / 1000', 1)} as renewable_gwh,
         avg_wind_speed_ms, avg_solar_radiation_wm2, avg_temp_celsius from (
    select date_key, country_code, country_name, sum(mwh) as total_mwh, sum(ren_mwh) as renewable_mwh,
           {XA('wind', 6, 1)} as avg_wind_speed_ms, {XA('solar', 6, 0)} as avg_solar_radiation_wm2,
           {XA('temp', 6, 1)} as avg_temp_celsius
    from (select date_key, country_code, country_name, ts_hour, sum(actual_mw) as mwh,
                 sum(case when energy_source in ({REN}) then actual_mw end) as ren_mwh,
                 max(avg_wind_speed) as wind, max(avg_solar_radiation) as solar, max(avg_temp) as temp
          from gw group by 1, 2, 3, 4)
    group by 1, 2, 3) where total_mwh > 0"""))
def q_weather_correlation(spark, sf_dir):
    """Daily generation vs mean weather per country."""
    return weather_correlation(m.gen_weather(spark, sf_dir))


@query("carbon_intensity_heatmap", Q(FCT, f"""
  select country_name, {YM} as year_month,
         {XA('avg_carbon_intensity_gco2_kwh', 2, 1)} as avg_carbon_intensity_gco2_kwh,
         {XA('avg_renewable_pct', 2, 1)} as avg_renewable_pct
  from fct_ci group by 1, 2"""))
def q_carbon_intensity_heatmap(spark, sf_dir):
    """Country x month mean carbon intensity (long form)."""
    return carbon_intensity_heatmap(m.grid_ci(spark, sf_dir))


@query("kpi_scorecards", Q(KPI, f"""
  select {XA('renewable_pct', 2, 2)} as avg_renewable_pct, sum(total_mwh) as total_mwh,
         count(distinct country_code) as countries_reporting from kpi"""))
def q_kpi_scorecards(spark, sf_dir):
    """Dashboard scorecards: mean renewable %, total MWh, countries reporting."""
    return kpi_scorecards(m.kpi(spark, sf_dir))


@query("fossil_renewable_split", Q(KPI, f"""
  select country_name, renewable_pct, {R('100.0 - renewable_pct', 2)} as fossil_nuclear_pct from (
    select country_name, {XA('renewable_pct', 2, 2)} as renewable_pct from kpi group by 1)"""))
def q_fossil_renewable_split(spark, sf_dir):
    """Renewable vs fossil+nuclear share per country."""
    return fossil_renewable_split(m.kpi(spark, sf_dir))


@query("top_energy_sources", Q(IDG, f"""
  select country_name, energy_source, sum(total_mwh) as total_mwh, {XA('pct_of_total', 2, 2)} as pct_of_total
  from idg where regexp_full_match(energy_source, '.+') group by 1, 2"""))
def q_top_energy_sources(spark, sf_dir):
    """Generation and mean share per country and source."""
    return top_energy_sources(m.daily(spark, sf_dir))


@query("fuel_mix", Q(IDG, f"""
  select country_name, energy_source, total_mwh,
         case when sum(total_mwh) over (partition by country_name) is null then null else
           {R('total_mwh * 100.0 / greatest(sum(total_mwh) over (partition by country_name), 0.001)', 2)} end
           as share_pct
  from (select country_name, energy_source, sum(total_mwh) as total_mwh from idg group by 1, 2)"""))
def q_fuel_mix(spark, sf_dir):
    """Fuel mix per country (100 % stacked)."""
    return fuel_mix(m.daily(spark, sf_dir))


@query("fuel_comparison", Q(IDG, f"""
  select country_name, energy_source, {XA('pct_of_total', 2, 2)} as pct_of_total from idg
  where energy_source in ({o._sql_list(dims.DASHBOARD_COMPARISON_SOURCES)}) group by 1, 2"""))
def q_fuel_comparison(spark, sf_dir):
    """Mean share of six headline sources per country."""
    return fuel_comparison(m.daily(spark, sf_dir))


@query("fuel_category_by_month", Q(IDG + [o.DIM_ES], f"""
  select {YM} as year_month, country_name, d.fuel_category, sum(total_mwh) as total_mwh
  from idg left join dim_es d using (energy_source) group by 1, 2, 3"""))
def q_fuel_category_by_month(spark, sf_dir):
    """Monthly generation by fuel category (seed dimension)."""
    from gridmix import dims as _d
    return fuel_category_by_month(m.daily(spark, sf_dir), _d.dim_energy_source(spark))


@query("fuel_group_by_month", Q(IDG, f"""
  select {YM} as year_month, country_name,
         case when energy_source in ({o._sql_list(dims.DASHBOARD_RENEWABLE_GROUP)}) then 'Renewable'
              else 'Fossil/Nuclear' end as fuel_group, sum(total_mwh) as total_mwh
  from idg group by 1, 2, 3"""))
def q_fuel_group_by_month(spark, sf_dir):
    """Monthly generation, renewable vs fossil/nuclear by the dashboard's literal list."""
    return fuel_group_by_month(m.daily(spark, sf_dir))


def _nan_null(e: str) -> str:
    # DuckDB yields NaN for a zero-variance fit where Spark yields NULL
    return f"case when isnan({e}) then null else {e} end"


def _trend_sql(sources: list[str], x: str) -> str:
    return Q(GW, f"""
  select country_name, cast(regr_count(actual_mw, {x}) as bigint) as n_points, {XA(x, 6, 6)} as avg_x,
         avg(actual_mw) as avg_y, {R(_nan_null(f'regr_slope(actual_mw, {x})'), 6)} as slope,
         {R(_nan_null(f'regr_intercept(actual_mw, {x})'), 6)} as intercept, {R(_nan_null(f'regr_r2(actual_mw, {x})'), 6)} as r2,
         {R(_nan_null(f'corr({x}, actual_mw)'), 6)} as corr
  from gw where energy_source in ({o._sql_list(sources)}) group by 1""")


@query("wind_trendline", _trend_sql(dims.WIND_SOURCES, "avg_wind_speed"))
def q_wind_trendline(spark, sf_dir):
    """Wind generation vs wind speed: per-country linear fit."""
    return trendline(m.gen_weather(spark, sf_dir), dims.WIND_SOURCES, "avg_wind_speed")


@query("solar_trendline", _trend_sql(["Solar"], "avg_solar_radiation"))
def q_solar_trendline(spark, sf_dir):
    """Solar generation vs radiation: per-country linear fit."""
    return trendline(m.gen_weather(spark, sf_dir), ["Solar"], "avg_solar_radiation")


@query("weather_by_month", Q(GW, f"""
  select {YM} as year_month, country_name, {XA('avg_wind_speed', 6, 6)} as avg_wind_speed,
         {XA('avg_solar_radiation', 6, 6)} as avg_solar_radiation from gw group by 1, 2"""))
def q_weather_by_month(spark, sf_dir):
    """Monthly mean wind speed and radiation per country."""
    return weather_by_month(m.gen_weather(spark, sf_dir))


@query("renewable_vs_wind", Q(chain(KPI, GW), f"""
  select {YM} as year_month, {XA('renewable_pct', 2, 2)} as renewable_pct,
         {XA('avg_wind_speed', 6, 6)} as avg_wind_speed
  from (select k.date_key, k.country_code, k.renewable_pct, w.avg_wind_speed from kpi k
        left join (select date_key, country_code, {XA('avg_wind_speed', 6, 6)} as avg_wind_speed from gw
                   where energy_source = 'Wind Onshore' group by 1, 2) w
        on k.date_key = w.date_key and k.country_code = w.country_code)
  group by 1"""))
def q_renewable_vs_wind(spark, sf_dir):
    """Monthly renewable % beside onshore wind speed (blend of two aggregates).  Both sides
    derive from staging, which is materialised once instead of being scanned and
    de-duplicated by each branch."""
    stg = materialize(m.staged(spark, sf_dir), "stg")
    kpi = m.ops.fct_renewable_kpi(m.int_daily_from(stg))
    return renewable_vs_wind(kpi, m.gen_weather(spark, sf_dir, stg))


@query("weather_efficiency", Q(GW, f"""
  select *, case when avg_wind_speed = 0 then null else avg_actual_mw / avg_wind_speed end as mw_per_ms from (
    select country_name, energy_source, {XA('avg_wind_speed', 6, 6)} as avg_wind_speed,
           {XA('avg_solar_radiation', 6, 6)} as avg_solar_radiation, avg(actual_mw) as avg_actual_mw
    from gw where energy_source in ({o._sql_list(dims.WEATHER_EFFICIENCY_SOURCES)}) group by 1, 2)"""))
def q_weather_efficiency(spark, sf_dir):
    """MW per m/s of wind per country and renewable source."""
    return weather_efficiency(m.gen_weather(spark, sf_dir))


@query("carbon_by_country", Q(FCT, f"""
  select country_name, {XA('avg_carbon_intensity_gco2_kwh', 2, 2)} as avg_carbon_intensity_gco2_kwh
  from fct_ci group by 1"""))
def q_carbon_by_country(spark, sf_dir):
    """Mean carbon intensity per country."""
    return carbon_by_country(m.grid_ci(spark, sf_dir))


@query("carbon_by_month", Q(FCT, f"""
  select {YM} as year_month, country_name,
         {XA('avg_carbon_intensity_gco2_kwh', 2, 2)} as avg_carbon_intensity_gco2_kwh from fct_ci group by 1, 2"""))
def q_carbon_by_month(spark, sf_dir):
    """Monthly mean carbon intensity per country."""
    return carbon_by_month(m.grid_ci(spark, sf_dir))


@query("cleanest_hour_table", Q(FCT, f"""
  select country_name, {XA('avg_carbon_intensity_gco2_kwh', 2, 2)} as avg_carbon_intensity_gco2_kwh,
         max(typical_cleanest_hour) as typical_cleanest_hour,
         {XA('min_carbon_intensity_gco2_kwh', 2, 2)} as best_carbon_intensity_gco2_kwh,
         {XA('daily_intensity_range_gco2_kwh', 2, 2)} as avg_daily_range_gco2_kwh
  from fct_ci group by 1"""))
def q_cleanest_hour_table(spark, sf_dir):
    """Per country: mean intensity, typical cleanest hour, best intensity, daily range."""
    return cleanest_hour_table(m.grid_ci(spark, sf_dir))


@query("sanity_check", Q(KPI, """
  select max(date_key) as latest_date, sum(total_mwh) as total_mwh, sum(renewable_mwh) as renewable_mwh from kpi"""))
def q_sanity_check(spark, sf_dir):
    """Warehouse sanity check: latest date and total / renewable MWh."""
    return sanity_check(m.kpi(spark, sf_dir))


@query("target_gap", Q(KPI + [o.DIM_COUNTRY], f"""
  select k.country_code, k.country_name, k.days, k.avg_renewable_pct, d.target_pct,
         {R('d.target_pct - k.avg_renewable_pct', 2)} as gap_pct
  from (select country_code, country_name, {XA('renewable_pct', 2, 2)} as avg_renewable_pct, count(*) as days
        from kpi group by 1, 2) k
  left join dim_country d on k.country_code = d.country_code"""))
def q_target_gap(spark, sf_dir):
    """Distance of each country's mean renewable share to its 2030 target."""
    from gridmix import dims as _d
    return target_gap(m.kpi(spark, sf_dir), _d.dim_country(spark))
