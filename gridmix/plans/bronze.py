"""Bronze decoding as named queries: XML documents, triage, file pruning, work grid, weather
cubes, wide / long weather, bounding-box means and grid-to-country assignment.

The documents, cubes and file listings are built by Spark from the driver's tables, so every
query's work grows with them; the oracle computes the expected rows from the same source rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmix import functions as gf
from gridmix import dims
from gridmix.operators import notebook_ops as nb
from gridmix.operators import work_grid
from gridmix.plans.catalog import query
from gridmix.sources import cube, files, load_gen_raw, load_weather_raw
from gridmix.sources import xml as bx
from gridmix.verify import oracle as o
from gridmix.verify.oracle import exact_avg_sql as XA

# Fixed values — fixture conventions for the bronze tree and the acknowledgement documents.
ACK_CODE, ACK_TEXT = "999", "No matching data found"
PRUNE_OFFSET_DAYS, PRUNE_SPAN_DAYS = 3, 7
WEATHER_CATEGORIES = ["wind", "solar"]
WEATHER_VARS = ["ssrd", "t2m", "u100", "v100"]

GEN_TS = "make_timestamp(ts_ns // 1000)"


def Q(parts, select):
    return o.with_ctes(*parts, select=select)


# --- XML -----------------------------------------------------------------------------------

@query("xml_generation_flatten", Q([o.GEN_BASE], f"""select {GEN_TS} as "timestamp", country,
  {o.psr_name_sql('psr_type')} as energy_source, psr_type, actual_MW, cast(null as double) as forecast_MW,
  'generation' as domain from gen_base where domain = 'generation'"""))
def q_xml_generation_flatten(spark, sf_dir):
    """Actual-generation documents (PT15M) decoded back to silver rows."""
    docs = bx.generation_documents(load_gen_raw(spark, sf_dir))
    return bx.flatten_series(bx.decode_documents(docs), "generation")


@query("xml_forecast_flatten", Q([o.GEN_BASE], f"""select date_trunc('hour', {GEN_TS}) as "timestamp", country,
  {o.psr_name_sql('psr_type')} as energy_source, psr_type, cast(null as double) as actual_MW, forecast_MW,
  'forecast' as domain from gen_base where domain = 'forecast'"""))
def q_xml_forecast_flatten(spark, sf_dir):
    """Day-ahead forecast documents (hourly step) decoded back to silver rows."""
    docs = bx.forecast_documents(load_gen_raw(spark, sf_dir))
    return bx.flatten_series(bx.decode_documents(docs), "forecast")


def triage_input(spark, sf_dir):
    """Generation documents plus an acknowledgement ("no data") document on the country-days
    divisible by 3.  The ack days come from the documents themselves, so the raw table is
    scanned once (Spark reuses the documents' exchange for both union branches)."""
    gen_docs = bx.generation_documents(load_gen_raw(spark, sf_dir)).select("country", "date", "xml")
    days = gen_docs.select("country", "date").distinct().where(F.dayofmonth("date") % 3 == 0)
    acks = days.select("country", "date", bx.acknowledgement_document(F.lit(ACK_CODE), F.lit(ACK_TEXT)).alias("xml"))
    return gen_docs.unionByName(acks)


@query("doc_triage", Q([o.GEN_BASE], f"""
  select country, "date", 'ok' as status, cast(null as varchar) as reason_code, cast(null as varchar) as reason_text
  from (select distinct country, cast({GEN_TS} as date) as "date" from gen_base where domain = 'generation')
  union all
  select country, "date", 'ack', '{ACK_CODE}', '{ACK_TEXT}'
  from (select distinct country, cast({GEN_TS} as date) as "date" from gen_base where domain = 'generation')
  where dayofmonth("date") % 3 = 0"""))
def q_doc_triage(spark, sf_dir):
    """Fetched documents classified as generation / acknowledgement (with reason) / other,
    one row per (country, day, outcome)."""
    return bx.triage(triage_input(spark, sf_dir)).distinct()


# --- bronze file tree ------------------------------------------------------------------------

def data_days(spark, sf_dir):
    """Distinct (country, day) of the raw rows, materialised: a small table that the listing
    and the date bounds all read, so the raw table is scanned once."""
    from gridmix.session import materialize

    raw = load_gen_raw(spark, sf_dir)
    return materialize(raw.select("country", F.to_date(gf.epoch_ns_to_ts("timestamp")).alias("d")).distinct(), "days")


def bronze_listing(spark, sf_dir, days=None):
    """Paths of the bronze tree implied by the data: a generation file per country-day (days
    divisible by 3 missing), monthly wind / solar cubes per country-month, and daily wind
    cubes on days divisible by 5."""
    days = data_days(spark, sf_dir) if days is None else days
    gen = days.where(F.dayofmonth("d") % 3 != 0).select(F.concat_ws(
        "/", F.lit("bronze/entsoe"), "country", F.lit("generation"), F.date_format("d", "yyyy-MM-dd"),
        F.lit("generation.xml")).alias("path"))
    months = days.select("country", F.trunc("d", "month").alias("m")).distinct()
    monthly = months.select("country", "m", F.explode(F.array(*[F.lit(c) for c in WEATHER_CATEGORIES])).alias("cat")) \
        .select(F.concat(F.lit("bronze/era5/"), F.col("country"), F.lit("/"), F.date_format("m", "yyyy/MM"),
                         F.lit("/"), F.date_format("m", "yyyy-MM"), F.lit("_"), F.col("cat"), F.lit(".nc")).alias("path"))
    daily = days.where(F.dayofmonth("d") % 5 == 0).select(
        F.concat(F.lit("bronze/era5/"), F.col("country"), F.lit("/"), F.date_format("d", "yyyy/MM"), F.lit("/"),
                 F.date_format("d", "yyyy-MM-dd"), F.lit("_wind.nc")).alias("path"))
    return gen.unionByName(monthly).unionByName(daily)


LISTING = f"""bz_days as (select distinct country, cast({GEN_TS} as date) as d from gen_base),
bz_files as (
  select 'bronze/entsoe/' || country || '/generation/' || strftime(d, '%Y-%m-%d') || '/generation.xml' as path,
         country, 'generation' as domain, d as file_date, cast(null as varchar) as category,
         d as file_min, d as file_max
  from bz_days where dayofmonth(d) % 3 <> 0
  union all
  select 'bronze/era5/' || country || '/' || strftime(m, '%Y/%m') || '/' || strftime(m, '%Y-%m') || '_' || cat || '.nc',
         country, null, null, cat, m, cast(last_day(m) as date)
  from (select distinct country, cast(date_trunc('month', d) as date) as m from bz_days),
       (select unnest([{o._sql_list(WEATHER_CATEGORIES)}]) as cat)
  union all
  select 'bronze/era5/' || country || '/' || strftime(d, '%Y/%m') || '/' || strftime(d, '%Y-%m-%d') || '_wind.nc',
         country, null, null, 'wind', d, d
  from bz_days where dayofmonth(d) % 5 = 0),
bz_window as (select min(d) + {PRUNE_OFFSET_DAYS} as s, min(d) + {PRUNE_OFFSET_DAYS + PRUNE_SPAN_DAYS} as e
              from bz_days)"""


@query("file_overlap_prune", Q([o.GEN_BASE, LISTING], """
  select f.* from bz_files f, bz_window w
  where (f.file_date is not null and f.file_date between w.s and w.e)
     or (f.file_date is null and f.file_min is not null and f.file_max >= w.s and f.file_min <= w.e)"""))
def q_file_overlap_prune(spark, sf_dir):
    """Bronze files selected for a 7-day window: generation files by folder date, weather
    files (daily or monthly) by interval overlap."""
    days = data_days(spark, sf_dir)
    listing = files.path_columns(bronze_listing(spark, sf_dir, days))
    first = days.select(F.min("d")).scalar()
    start, end = F.date_add(first, PRUNE_OFFSET_DAYS), F.date_add(first, PRUNE_OFFSET_DAYS + PRUNE_SPAN_DAYS)
    gen = files.prune_by_date(listing.where(F.col("file_date").isNotNull()), start, end)
    wea = files.prune_by_overlap(listing.where(F.col("file_date").isNull()), start, end)
    return gen.unionByName(wea).select("path", "country", "domain", "file_date", "category", "file_min", "file_max")


@query("missing_partitions", Q([o.GEN_BASE, LISTING, o.DIM_COUNTRY], """
  select c.country_code as country, g.d as "date", 'generation' as category
  from dim_country c,
       (select unnest(range(min(d), max(d) + interval 1 day, interval 1 day))::date as d from bz_days) g
  where not exists (select 1 from bz_files f where f.domain = 'generation' and f.country = c.country_code
                    and f.file_date = g.d)"""))
def q_missing_partitions(spark, sf_dir):
    """Work grid (every configured country x every day in range) minus the generation files
    that exist — the days a backfill has to fetch."""
    days = data_days(spark, sf_dir)
    listing = files.path_columns(bronze_listing(spark, sf_dir, days)).where(F.col("domain") == "generation")
    lo, hi = days.select(F.min("d")).scalar(), days.select(F.max("d")).scalar()
    grid = dims.dim_country(spark).select(F.col("country_code").alias("country"),
                                          F.explode(F.sequence(lo, hi)).alias("date"))
    have = listing.select("country", F.col("file_date").alias("date"))
    return grid.join(have, ["country", "date"], "left_anti").withColumn("category", F.lit("generation"))


def weather_listing(spark, sf_dir, days=None):
    """Weather files that the data imply: ``solar`` monthly for all months, ``wind`` daily on days divisible by 5, ``temp``
    daily but on the first two days of a week of the month."""
    days = data_days(spark, sf_dir) if days is None else days
    day = F.dayofmonth("d")

    def path(stem, cat):
        return F.concat(F.lit("bronze/era5/"), F.col("country"), F.lit("/"), F.date_format("d", "yyyy/MM"), F.lit("/"),
                        F.date_format("d", stem), F.lit(f"_{cat}.nc")).alias("path")

    return (days.select("country", F.trunc("d", "month").alias("d")).distinct().select(path("yyyy-MM", "solar"))
            .unionByName(days.where(day % 5 == 0).select(path("yyyy-MM-dd", "wind")))
            .unionByName(days.where(~(day % 7).isin(0, 1)).select(path("yyyy-MM-dd", "temp"))))


@query("weather_work_grid", Q([o.GEN_BASE, LISTING, o.DIM_COUNTRY], f"""
  select country, category, mode, first_day, last_day, days from (
    with have as (
      select distinct country, 'solar' as category, unnest(generate_series(date_trunc('month', d), last_day(d), interval 1 day))::date as d
      from bz_days
      union select country, 'wind', d from bz_days where dayofmonth(d) % 5 = 0
      union select country, 'temp', d from bz_days where dayofmonth(d) % 7 not in (0, 1)),
    lacking as (
      select c.country_code as country, k.category, g.d
      from dim_country c, (select unnest([{o._sql_list(list(dims.WEATHER_CATEGORIES))}]) as category) k,
           (select unnest(range(min(d), max(d), interval 1 day))::date as d from bz_days) g
      where (c.country_code, k.category, g.d) not in (select country, category, d from have)),
    months as (
      select country, category, date_trunc('month', d)::date as m, list(d order by d) as ds from lacking group by all),
    runs as (
      select country, category, m, unnest(ds) as d, len(ds) as n, unnest(ds) - cast(unnest(range(1, len(ds) + 1)) as int) as island
      from months)
    select country, category, 'monthly' as mode, m as first_day, last_day(m) as last_day, count(*) as days
    from runs where n * 2 > dayofmonth(last_day(m)) group by country, category, m
    union all
    select country, category, 'daily', min(d), max(d), count(*)
    from runs where n * 2 <= dayofmonth(last_day(m)) group by country, category, m, island)"""))
def q_weather_work_grid(spark, sf_dir):
    """Requests for the weather that is missing in [first day, last day): monthly ones where most of a month is, else
    ranges of days; files of a month cover their days."""
    days = data_days(spark, sf_dir)
    files_ = files.path_columns(weather_listing(spark, sf_dir, days)).select("country", "category", "file_min", "file_max")
    lo, hi = days.select(F.min("d")).scalar(), days.select(F.max("d")).scalar()
    keys = dims.dim_country(spark).select(F.col("country_code").alias("country"), F.explode(F.array(
        *[F.lit(c) for c in dims.WEATHER_CATEGORIES])).alias("category"))
    return work_grid.requests(work_grid.missing_days(work_grid.wanted_days(keys, lo, hi), files_))


# --- weather cubes, wide / long, boxes -------------------------------------------------------

WEATHER_TS = """weather_ts as (select make_timestamp("timestamp" // 1000) as "timestamp", lat, lon, variable, value,
  country from weather_raw)"""
WIDE = f"""weather_wide as (select "timestamp", lat, lon, country,
  {", ".join(f"max(case when variable = '{v}' then value{' - 273.15' if v == 't2m' else ''} end) as {v}"
             for v in WEATHER_VARS)}
  from weather_ts group by 1, 2, 3, 4)"""


def _weather_long(spark, sf_dir):
    return nb.weather_frame(load_weather_raw(spark, sf_dir))


@query("cube_flatten", Q([o.WEATHER_RAW, WEATHER_TS], "select * from weather_ts"))
def q_cube_flatten(spark, sf_dir):
    """Weather cubes (time x lat x lon per country, variable, day) flattened to long rows."""
    cubes = cube.build_cubes(load_weather_raw(spark, sf_dir))
    return cube.flatten_cube(cubes)


@query("weather_wide", Q([o.WEATHER_RAW, WEATHER_TS, WIDE], "select * from weather_wide"))
def q_weather_wide(spark, sf_dir):
    """One column per weather variable, temperature in deg C."""
    return cube.wide(_weather_long(spark, sf_dir), WEATHER_VARS)


@query("melt_weather", Q([o.WEATHER_RAW, WEATHER_TS], """select "timestamp", lat, lon, country, variable,
  case when variable = 't2m' then value - 273.15 else value end as value from weather_ts"""))
def q_melt_weather(spark, sf_dir):
    """Wide weather melted back to (variable, value) rows, NULLs dropped."""
    return cube.melt(cube.wide(_weather_long(spark, sf_dir), WEATHER_VARS))


@query("bbox_country_mean", Q([o.WEATHER_RAW, WEATHER_TS, WIDE], f"""select "timestamp",
  {", ".join(f"{XA(c, 6, 6)} as {c}" for c in ["lat", "lon"] + WEATHER_VARS)}
  from weather_wide where lat between {dims.DEFAULT_BBOX['lat_min']} and {dims.DEFAULT_BBOX['lat_max']}
   and lon between {dims.DEFAULT_BBOX['lon_min']} and {dims.DEFAULT_BBOX['lon_max']} group by 1"""))
def q_bbox_country_mean(spark, sf_dir):
    """Mean of every numeric column per time step inside the default country box."""
    w = cube.bbox_filter(cube.wide(_weather_long(spark, sf_dir), WEATHER_VARS), dims.DEFAULT_BBOX)
    return cube.mean_numeric_per_time(w.drop("country"))


BOXES = "boxes(country_code, north, west, south, east) as (values " + ", ".join(
    f"('{c}', {n}, {w}, {s}, {e})" for c, (_, _, (n, w, s, e)) in sorted(dims.COUNTRY_CONFIG.items())) + ")"


@query("grid_to_country", Q([o.WEATHER_RAW, BOXES], """select g.lat, g.lon, b.country_code
  from (select distinct lat, lon from weather_raw) g join boxes b
  on g.lat between b.south and b.north and g.lon between b.west and b.east"""))
def q_grid_to_country(spark, sf_dir):
    """Grid points assigned to every configured country box containing them."""
    cells = load_weather_raw(spark, sf_dir).select("lat", "lon").distinct()
    return cube.grid_to_country(cells, dims.country_config(spark))


@query("grid_to_country_tiles", Q([o.WEATHER_RAW, BOXES], """select w."timestamp", w.lat, w.lon, w.variable, w.value, b.country_code
  from weather_raw w join boxes b on w.lat between b.south and b.north and w.lon between b.west and b.east"""))
def q_grid_to_country_tiles(spark, sf_dir):
    """Weather delivered without a country gets those of the boxes around each cell, through tiles of the grid."""
    rows = load_weather_raw(spark, sf_dir).drop("country")
    return cube.grid_to_country_tiles(rows, dims.country_config(spark))


@query("xml_file_scan", Q([o.GEN_BASE], f"""select {GEN_TS} as "timestamp", country,
  {o.psr_name_sql('psr_type')} as energy_source, psr_type, actual_MW, cast(null as double) as forecast_MW,
  'generation' as domain from gen_base where domain = 'generation'"""))
def q_xml_file_scan(spark, sf_dir):
    """Generation documents landed as files (country / month folders) and read back with the
    XML file source, then flattened."""
    from gridmix import session

    root = session.work_dir(spark, "bronze-xml")
    bx.write_documents(bx.generation_documents(load_gen_raw(spark, sf_dir)), root)
    return bx.flatten_series(bx.read_document_tree(spark, root), "generation")


@query("xml_union_flatten", Q([o.GEN_BASE], f"""
  select {GEN_TS} as "timestamp", country, {o.psr_name_sql('psr_type')} as energy_source, psr_type, actual_MW,
         cast(null as double) as forecast_MW, 'generation' as domain from gen_base where domain = 'generation'
  union all
  select date_trunc('hour', {GEN_TS}), country, {o.psr_name_sql('psr_type')}, psr_type, cast(null as double),
         forecast_MW, 'forecast' from gen_base where domain = 'forecast'"""))
def q_xml_union_flatten(spark, sf_dir):
    """Actual and day-ahead documents flattened and unioned into one silver frame."""
    raw = load_gen_raw(spark, sf_dir)
    gen = bx.flatten_series(bx.decode_documents(bx.generation_documents(raw)), "generation")
    fc = bx.flatten_series(bx.decode_documents(bx.forecast_documents(raw)), "forecast")
    return bx.union_generation(gen, fc)
