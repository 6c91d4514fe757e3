"""Readers, writers and filters as named queries over the driver's tables: seeds and configuration read from
files and joined with the data, tables saved and read back, skip-if-exists, report controls."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from gridmix import dims, session, sinks
from gridmix import functions as gf
from gridmix.plans import models as m
from gridmix.plans.catalog import query
from gridmix.sources import config, cube, load_gen_raw, load_weather_raw
from gridmix.verify import oracle as o


@query("seed_source_use", o.with_ctes(*o.STG_CHAIN, o.DIM_ES, select="""
  select d.energy_source, d.psr_code, d.fuel_category, count(s.ts_hour) as staged_hours
  from dim_es d left join stg s using (energy_source) group by all"""))
def q_seed_source_use(spark, sf_dir):
    """The energy-source seed written as CSV, read back by its schema, with the staged hours of each source."""
    path = session.work_dir(spark, "seed")
    dims.dim_energy_source(spark).write.option("header", True).csv(path)
    seed = config.read_energy_source_seed(spark, path).select("energy_source", "psr_code", "fuel_category")
    hours = m.staged(spark, sf_dir).groupBy("energy_source").agg(F.count("ts_hour").alias("n"))
    return seed.join(hours, "energy_source", "left").select(
        "energy_source", "psr_code", "fuel_category", F.coalesce("n", F.lit(0)).alias("staged_hours"))


@query("seed_country_use", o.with_ctes(*o.KPI_CHAIN, o.DIM_COUNTRY, select="""
  select d.country_code, d.region, d.target_pct, count(k.date_key) as days,
         count(*) filter (k.renewable_pct >= d.target_pct) as days_on_target
  from dim_country d left join kpi k using (country_code) group by all"""))
def q_seed_country_use(spark, sf_dir):
    """The country seed written as CSV, read back by its schema, with each country's days on target."""
    path = session.work_dir(spark, "seed")
    dims.dim_country(spark).write.option("header", True).csv(path)
    seed = config.read_country_seed(spark, path)
    target = seed.columns[-1]
    days = m.kpi(spark, sf_dir).join(seed.select("country_code", F.col(target).alias("goal")), "country_code") \
        .groupBy("country_code").agg(F.count("date_key").alias("d"), F.count_if(F.col("renewable_pct") >= F.col("goal")).alias("t"))
    return seed.join(days, "country_code", "left").select(
        "country_code", "region", F.col(target).alias("target_pct"),
        F.coalesce("d", F.lit(0)).alias("days"), F.coalesce("t", F.lit(0)).alias("days_on_target"))


AREAS = "areas(country_code, label, north, west, south, east) as (values " + ", ".join(
    f"('{c}', '{label}', {n}, {w}, {s}, {e})"
    for c, (_, label, (n, w, s, e)) in sorted(dims.COUNTRY_CONFIG.items())) + ")"


@query("country_areas", o.with_ctes(o.WEATHER_RAW, AREAS, select="""
  select a.country_code, a.label, count(g.lat) as cells
  from areas a left join (select distinct lat, lon from weather_raw) g
    on g.lat between a.south and a.north and g.lon between a.west and a.east group by all"""))
def q_country_areas(spark, sf_dir):
    """The JSON configuration read back: bidding zones with the grid cells inside their country's box."""
    path = session.work_dir(spark, "config")
    text = json.dumps({c: {"country_name": dims.COUNTRY_NAME[c], "entsoe_areas": [{"code": zone, "label": label}],
                           "era5_area": list(box)} for c, (zone, label, box) in dims.COUNTRY_CONFIG.items()})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    setup = config.read_country_config(spark, path)
    cells = cube.grid_to_country(load_weather_raw(spark, sf_dir).select("lat", "lon").distinct(), setup)
    n = cells.groupBy("country_code").agg(F.count("lat").alias("n"))
    return config.country_areas(setup).join(n, "country_code", "left").select(
        "country_code", "label", F.coalesce("n", F.lit(0)).alias("cells"))


@query("append_missing", o.with_ctes(o.GEN_BASE, o.GEN_RAW, select="""select country, domain, count(*) as rows
  from gen_raw group by all"""))
def q_append_missing(spark, sf_dir):
    """Countries appended in overlapping steps: those present are skipped, so no row comes twice."""
    raw = load_gen_raw(spark, sf_dir)
    path = session.work_dir(spark, "appended")
    for part in (F.col("country").isin("DE", "FR"), F.col("country").isin("FR", "GR", "DE"), F.lit(True)):
        sinks.append_missing(spark, raw.where(part), path, ["country"])
    return spark.read.parquet(path).groupBy("country", "domain").agg(F.count(F.lit(1)).alias("rows"))


@query("partitioned_write", o.with_ctes(*o.IDG_CHAIN, select="select * from idg where country_code = 'FR' and energy_source like 'Wind%'"))
def q_partitioned_write(spark, sf_dir):
    """Daily generation written in folders by country and source, overwritten by the same, and read for one country's wind: the
    folders of others aren't opened."""
    path = session.work_dir(spark, "partitioned")
    df = session.materialize(m.daily(spark, sf_dir), "daily")
    for _ in range(2):
        sinks.write_partitioned(df, path, ["country_code", "energy_source"])
    wind = (F.col("country_code") == "FR") & F.col("energy_source").startswith("Wind")
    return spark.read.schema(df.schema).parquet(path).where(wind)


@query("saved_table", o.with_ctes(*o.KPI_CHAIN, select="""select country_code, max(renewable_pct) as best_pct,
  arg_max(date_key, {'pct': renewable_pct, 'early': -epoch(date_key)}) as best_day from kpi
  where renewable_pct is not null group by country_code"""))
def q_saved_table(spark, sf_dir):
    """The KPI saved as a partitioned table and asked by SQL for each country's best day."""
    path = session.work_dir(spark, "saved")
    name = "saved_kpi_" + path[-12:]
    sinks.save_table(spark, m.kpi(spark, sf_dir), name, path, ["country_code"])
    best = spark.sql(f"""select country_code, max(renewable_pct) as best_pct,
        max_by(date_key, struct(renewable_pct, -unix_date(date_key))) as best_day
        from {name} where renewable_pct is not null group by country_code""")
    best = session.materialize(best, "best")  # a partitioned table is listed by its name when it is read
    spark.sql(f"DROP TABLE {name}")
    return best


@query("report_filter", o.with_ctes(*o.KPI_CHAIN, select="""select * from kpi where year(date_key) = 2025
  and date_key between date '2025-02-27' and date '2025-03-02' and country_name in ('Germany', 'France', 'Greece')"""))
def q_report_filter(spark, sf_dir):
    """The dashboard's controls on the KPI: year, days, countries."""
    return gf.report_filter(m.kpi(spark, sf_dir), 2025, "2025-02-27", "2025-03-02", ["Germany", "France", "Greece"])


@query("wind_compass", o.with_ctes(*o.WEATHER_CHAIN, o.WIND, select=f"""select country_code,
  cast(floor({o.R('(degrees(atan2(wind_100m_v, wind_100m_u)) + 360) % 360', 6)} / 45) as bigint) % 8 as octant, count(*) as cells
  from wind where wind_100m_u is not null and wind_100m_v is not null group by all"""))
def q_wind_compass(spark, sf_dir):
    """Cells by octant of the wind's compass angle."""
    wind = m.ops.stg_wind(load_weather_raw(spark, sf_dir)).where("wind_100m_u is not null and wind_100m_v is not null")
    angle = F.round(gf.wind_direction_compass("wind_100m_u", "wind_100m_v"), 6)
    return wind.groupBy("country_code", (F.floor(angle / 45) % 8).alias("octant")).agg(F.count(F.lit(1)).alias("cells"))
