"""The local exploration queries as named queries (row counts, per-source totals, weather
rows per variable, hourly generation x weather pivot, top hours, relabel, legacy codes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmix import dims
from gridmix import functions as gf
from gridmix.operators import notebook_ops as nb
from gridmix.plans.catalog import query
from gridmix.sources import load_gen_raw, load_weather_raw
from gridmix.verify import oracle as o
from gridmix.verify.oracle import R, exact_avg_sql as XA

GEN = """nb_gen as (
  select make_timestamp("timestamp" // 1000) as "timestamp", country, energy_source, psr_type,
         case when isnan(actual_MW) then null else actual_MW end as actual_MW
  from gen_raw where domain = 'generation' and "timestamp" is not null)"""
WEA = """nb_weather as (
  select make_timestamp("timestamp" // 1000) as "timestamp", lat, lon, variable, value, country
  from weather_raw where "timestamp" is not null and value is not null)"""
VARS = sorted(dims.WIND_VARIABLES + ["ssrd", "t2m"])
PIVOT = f"""nb_hourly as (
  select "timestamp", country, sum(actual_MW) as generation_mw from nb_gen group by 1, 2),
nb_var as (
  select "timestamp", country, variable, {XA('value', 6, 6)} as avg_value from nb_weather
  where variable in ({o._sql_list(VARS)}) group by 1, 2, 3),
nb_wide as (
  select "timestamp", country, {", ".join(f"max(case when variable = '{v}' then avg_value end) as {v}" for v in VARS)}
  from nb_var group by 1, 2),
nb_join as (
  select h.*, {", ".join(f"w.{v}" for v in VARS)} from nb_hourly h
  left join nb_wide w on h."timestamp" = w."timestamp" and h.country = w.country)"""

GEN_CHAIN = [o.GEN_BASE, o.GEN_RAW, GEN]
JOIN_CHAIN = GEN_CHAIN + [o.WEATHER_RAW, WEA, PIVOT]


def _gen(spark, sf_dir):
    return nb.generation_frame(load_gen_raw(spark, sf_dir))


def _weather(spark, sf_dir):
    return nb.weather_frame(load_weather_raw(spark, sf_dir))


@query("generation_row_count", o.with_ctes(*GEN_CHAIN, select="select count(*) as row_count from nb_gen"))
def q_generation_row_count(spark, sf_dir):
    """Q1: number of parsed actual-generation rows."""
    return _gen(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))


@query("source_totals", o.with_ctes(*GEN_CHAIN, select=f"""select energy_source, count(*) as rows,
  sum(actual_MW) as total_mw, {R('sum(actual_MW)', 2)} as total_generation_mw from nb_gen group by 1"""))
def q_source_totals(spark, sf_dir):
    """Q2: rows and total generation per energy source."""
    return nb.source_totals(_gen(spark, sf_dir))


@query("weather_rows_per_variable", o.with_ctes(o.WEATHER_RAW, WEA, select="""select variable,
  count(*) as row_count from nb_weather group by 1"""))
def q_weather_rows_per_variable(spark, sf_dir):
    """Q3: weather rows per variable."""
    return nb.rows_per_variable(_weather(spark, sf_dir))


@query("pivot_join", o.with_ctes(*JOIN_CHAIN, select="select * from nb_join"))
def q_pivot_join(spark, sf_dir):
    """Hourly generation per country with the pivoted country-mean weather variables."""
    return nb.hourly_generation_with_weather(_gen(spark, sf_dir), _weather(spark, sf_dir))


@query("top_hours", o.with_ctes(*JOIN_CHAIN, select="""select "timestamp", country, generation_mw from nb_join
  order by generation_mw desc nulls last, "timestamp", country limit 10"""))
def q_top_hours(spark, sf_dir):
    """Q4: the ten highest-generation country-hours."""
    return nb.top_hours(nb.hourly_generation_with_weather(_gen(spark, sf_dir), _weather(spark, sf_dir)))


@query("relabel_sources", o.with_ctes(o.GEN_BASE, select=f"""select psr_type,
  {o._case_map('psr_type', dims.PSR_TO_SOURCE, "'unknown_' || psr_type")} as energy_source, count(*) as rows
  from gen_base group by 1, 2"""))
def q_relabel_sources(spark, sf_dir):
    """Snake-case source labels (local writer variant) relabelled to the seed names."""
    raw = load_gen_raw(spark, sf_dir).withColumn("energy_source", gf.psr_name_snake("psr_type"))
    return nb.relabel_psr_sources(raw).groupBy("psr_type", "energy_source").agg(F.count(F.lit(1)).alias("rows"))


@query("legacy_psr_labels", o.with_ctes(o.GEN_BASE, select=f"""select psr_type,
  {o.psr_name_sql('psr_type')} as energy_source,
  {o._case_map('psr_type', dims.LEGACY_PSR, "'Unknown (' || psr_type || ')'")} as legacy_name,
  coalesce(psr_type in ({o._sql_list(dims.LEGACY_RENEWABLE_CODES)}), false) as legacy_renewable,
  count(*) as rows from gen_base group by 1, 2, 3, 4"""))
def q_legacy_psr_labels(spark, sf_dir):
    """Each PSR code under the current table and under the legacy table."""
    raw = load_gen_raw(spark, sf_dir)
    return raw.groupBy(
        "psr_type", "energy_source", gf.legacy_psr_name("psr_type").alias("legacy_name"),
        gf.is_legacy_renewable_code("psr_type").alias("legacy_renewable"),
    ).agg(F.count(F.lit(1)).alias("rows"))


@query("sql_source_totals", o.with_ctes(*GEN_CHAIN, select="""select psr_type, count(actual_MW) as readings,
  max(actual_MW) as peak_mw, count(distinct country) as countries from nb_gen group by psr_type"""))
def q_sql_source_totals(spark, sf_dir):
    """Readings, peak and countries of each code through the SQL entry point (a frame given to spark.sql)."""
    return spark.sql("""select psr_type, count(actual_MW) as readings, max(actual_MW) as peak_mw,
                               count(distinct country) as countries
                        from {readings} group by psr_type""", readings=_gen(spark, sf_dir))


@query("sql_top_hours", o.with_ctes(*JOIN_CHAIN, select="""select country, arg_max("timestamp", {'mw': generation_mw,
  'early': -epoch("timestamp")}) as peak_hour, max(generation_mw) as peak_mw from nb_join
  where generation_mw is not null group by country"""))
def q_sql_top_hours(spark, sf_dir):
    """Each country's peak hour (the earlier of equal ones) through a temporary view and SQL."""
    joined = nb.hourly_generation_with_weather(_gen(spark, sf_dir), _weather(spark, sf_dir))
    joined.createOrReplaceTempView("country_hour_load")
    return spark.sql("""select country, max_by(timestamp, struct(generation_mw, -unix_micros(timestamp))) as peak_hour,
                               max(generation_mw) as peak_mw
                        from country_hour_load where generation_mw is not null group by country""")


@query("silver_date_label", o.with_ctes(o.GEN_BASE, select=f"""select country,
  strftime(min({'make_timestamp(ts_ns // 1000)'}), '%Y%m%d') || '_' || strftime(max(make_timestamp(ts_ns // 1000)), '%Y%m%d')
  as label, count(*) as rows from gen_base group by 1"""))
def q_silver_date_label(spark, sf_dir):
    """Per country, the min-max date label of its silver file and its row count."""
    g = load_gen_raw(spark, sf_dir).select("country", gf.epoch_ns_to_ts("timestamp").alias("ts"))
    return g.groupBy("country").agg(
        F.concat(F.date_format(F.min("ts"), "yyyyMMdd"), F.lit("_"), F.date_format(F.max("ts"), "yyyyMMdd"))
        .alias("label"), F.count(F.lit(1)).alias("rows"))
