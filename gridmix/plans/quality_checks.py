"""Data-quality checks as named queries (offending rows), plus the gate summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmix import dims
from gridmix.operators import quality as dq
from gridmix.plans import models as m
from gridmix.plans.catalog import query
from gridmix.sources import load_gen_raw, load_weather_raw
from gridmix.session import materialize, together
from gridmix.verify import oracle as o


def Q(parts, select):
    return o.with_ctes(*parts, select=select)


STG, IDG, KPI, CI, FCT = o.STG_CHAIN, o.IDG_CHAIN, o.KPI_CHAIN, o.CI_CHAIN, o.FCT_CI_CHAIN


def source_checks(gen_raw, weather_raw):
    """Declared tests of the raw sources: every row has a timestamp."""
    return [
        dq.row_check("not_null_timestamp", "raw_entsoe_generation", gen_raw, F.col("timestamp").isNull()),
        dq.row_check("not_null_timestamp", "raw_era5_weather", weather_raw, F.col("timestamp").isNull()),
    ]


def recency_checks(stg, kpi, as_of):
    """Warn-only freshness: staging within 4 hours, the KPI mart within 2 days of ``as_of``."""
    stale = F.col("is_stale")
    return [
        dq.Check("recency_4_hours", "stg_generation",
                 dq.recency(stg, "ts_hour", "hour", 4, as_of=as_of).where(stale), severity="warn"),
        dq.Check("recency_2_days", "fct_renewable_kpi",
                 dq.recency(kpi, "date_key", "day", 2, as_of=as_of, ignore_time_component=True).where(stale),
                 severity="warn"),
    ]


#: Declared row tests: model -> (check, SQL condition that a row must not meet).  Both engines run the same conditions.
TS_OUT = f"ts_hour < timestamp '{dq.TS_MIN}' or ts_hour > timestamp '{dq.TS_MAX}'"
ROW_TESTS = {
    "stg_generation": [
        ("not_null_ts_hour", "ts_hour is null"), ("not_null_country_code", "country_code is null"),
        ("not_null_energy_source", "energy_source is null"), ("not_null_date_key", "date_key is null"),
        ("mw_positive", "actual_mw < 0"), ("timestamp_range", TS_OUT)],
    "int_daily_generation": [
        ("not_null_date_key", "date_key is null"), ("not_null_country_code", "country_code is null"),
        ("not_null_energy_source", "energy_source is null"), ("total_mwh_range", "total_mwh < 0"),
        ("total_mwh_all_sources_range", "total_mwh_all_sources < 0"),
        ("hours_reported_range", "hours_reported < 0 or hours_reported > 24"),
        ("pct_of_total_range", "pct_of_total < 0 or pct_of_total > 100")],
    "int_carbon_intensity": [
        ("not_null_ts_hour", "ts_hour is null"), ("not_null_country_code", "country_code is null"),
        ("not_null_carbon_intensity", "carbon_intensity_gco2_kwh is null"),
        ("intensity_range", "carbon_intensity_gco2_kwh < 0 or carbon_intensity_gco2_kwh > 1200")],
    "int_generation_weather": [
        ("not_null_ts_hour", "ts_hour is null"), ("not_null_country_code", "country_code is null"),
        ("not_null_energy_source", "energy_source is null")],
    "fct_renewable_kpi": [
        ("not_null_date_key", "date_key is null"), ("not_null_country_code", "country_code is null"),
        ("not_null_renewable_pct", "renewable_pct is null"),
        ("renewable_pct_range", "renewable_pct < 0 or renewable_pct > 100"),
        ("renewable_mwh_range", "renewable_mwh < 0"), ("total_mwh_range", "total_mwh < 0")],
    "fct_grid_carbon_intensity": [
        ("not_null_date_key", "date_key is null"), ("not_null_country_code", "country_code is null"),
        ("daily_intensity_range", "avg_carbon_intensity_gco2_kwh < 0 or avg_carbon_intensity_gco2_kwh > 1200")],
    "stg_wind": [("not_null_ts_hour", "ts_hour is null"), ("not_null_country_code", "country_code is null")],
    "stg_solar": [("not_null_ts_hour", "ts_hour is null"), ("not_null_country_code", "country_code is null")],
}
#: Declared keys: model -> columns whose combination is unique.
KEYS = {
    "stg_generation": ["country_code", "ts_hour", "energy_source"],
    "int_daily_generation": ["country_code", "date_key", "energy_source"],
    "int_carbon_intensity": ["country_code", "ts_hour"],
    "int_generation_weather": ["country_code", "ts_hour", "energy_source"],
    "fct_renewable_kpi": ["country_code", "date_key"],
    "fct_grid_carbon_intensity": ["country_code", "date_key"],
}


def row_checks(name: str, df) -> list:
    """The declared row tests of a model."""
    return [dq.row_check(check, name, df, F.expr(test)) for check, test in ROW_TESTS[name]]


def key_checks(models: dict, dim_country) -> list:
    """The declared checks that look at more than one row."""
    checks = [dq.Check("unique_key", name, dq.unique_combination(df, KEYS[name])) for name, df in models.items() if name in KEYS]
    if "stg_generation" in models:
        checks.append(dq.Check("minimum_row_coverage", "stg_generation", dq.row_coverage(models["stg_generation"])))
    if "fct_renewable_kpi" in models:
        kpi = models["fct_renewable_kpi"]
        unknown = kpi.join(F.broadcast(dim_country.select("country_code")), "country_code", "left_anti")
        checks.append(dq.Check("country_code_valid", "fct_renewable_kpi", dq.country_code_valid(kpi, dim_country),
                               sliced=unknown.select("date_key", "country_code")))
    return checks


def declared(models: dict, dim_country) -> list:
    """The declared checks of the models at hand (row tests are fused per model by ``quality.summary``)."""
    return [c for name, df in models.items() for c in row_checks(name, df)] + key_checks(models, dim_country)


def model_checks(m) -> list:
    """The declared checks of a run (``increments.Models``): of its models, of weather staging and of its sources."""
    named = {"stg_generation": m.stg, "int_daily_generation": m.daily, "int_carbon_intensity": m.hourly,
             "int_generation_weather": m.weather, "fct_renewable_kpi": m.kpi, "fct_grid_carbon_intensity": m.intensity,
             "stg_wind": m.wind, "stg_solar": m.solar}
    return declared({k: v for k, v in named.items() if v is not None}, dims.dim_country(m.stg.sparkSession)) + [
        dq.Check("not_null_timestamp", source, undated) for source, undated in m.undated.items()]


# --- staging rows with violations of every check, derived from the staged rows ----------------

#: Spark and DuckDB run the same statements; {stg} is the staged table.
VIOLATIONS = """
  select case when country_code = 'IT' and hour_of_day = 7 then timestamp '1999-12-31 23:00:00'
              when country_code = 'IT' and hour_of_day = 8 then cast(null as timestamp) else ts_hour end as ts_hour,
         case when country_code = 'ES' and hour_of_day = 11 then cast(null as {text}) else country_code end as country_code,
         country_name, date_key, hour_of_day, month_of_year, energy_source, psr_code,
         case when country_code = 'GR' and psr_code = 'B04' then -10 * actual_mw else actual_mw end as actual_mw,
         forecast_mw, generation_mw, forecast_error_pct
  from {stg}
  where not (country_code = 'SE' and hour_of_day > 2)
  union all
  select * from {stg} where country_code = 'DE' and hour_of_day = 5"""
VIO = ["vio as (" + VIOLATIONS.format(stg="stg", text="varchar") + ")"]
VIO_STG = STG + VIO


def _on_violations(*models: str) -> list[str]:
    """Chains of the models over the rows with violations."""
    out = list(VIO_STG)
    for sql in models:
        out.append(sql.replace("from stg,", "from vio,").replace("from stg ", "from vio "))
    return out


VIO_IDG, VIO_CI = _on_violations(o.IDG), _on_violations(o.CI)
VIO_KPI, VIO_FCT = VIO_IDG + [o.KPI], VIO_CI + [o.FCT_CI]


def violating(spark, sf_dir):
    """Staged rows with a null time, a null country, an hour out of range, repeated keys, negative readings and a
    country with few hours."""
    return spark.sql(VIOLATIONS.format(stg="{stg}", text="string"), stg=materialize(m.staged(spark, sf_dir)))


@query("dq_not_null", Q(VIO_STG, "select * from vio where ts_hour is null or country_code is null"))
def q_dq_not_null(spark, sf_dir):
    """Staging rows with a NULL key."""
    stg = violating(spark, sf_dir)
    return stg.where(F.col("ts_hour").isNull() | F.col("country_code").isNull())


@query("dq_unique", Q(VIO_STG, """select country_code, ts_hour, energy_source, count(*) as n_records from vio
  group by 1, 2, 3 having count(*) > 1"""))
def q_dq_unique(spark, sf_dir):
    """Duplicate (country, hour, source) keys in staging."""
    return dq.unique_combination(violating(spark, sf_dir), ["country_code", "ts_hour", "energy_source"])


@query("dq_range", Q(VIO_IDG, "select * from idg where pct_of_total < 0 or pct_of_total > 100"))
def q_dq_range(spark, sf_dir):
    """Daily rows whose share is outside [0, 100] (negative actuals make it fire)."""
    return dq.accepted_range(m.int_daily_from(violating(spark, sf_dir)), "pct_of_total", 0, 100)


#: Hours after the newest staged hour at which freshness is asked: staging is stale then, the KPI isn't.
AS_OF_HOURS = 30


@query("dq_recency", Q(KPI + [f"asked as (select max(ts_hour) + interval {AS_OF_HOURS} hour as asked_at from stg)"], """
  select 'stg_generation' as model, max(ts_hour) as newest, any_value(asked_at) - interval 4 hour as threshold,
         max(ts_hour) < any_value(asked_at) - interval 4 hour as is_stale from stg, asked
  union all
  select 'fct_renewable_kpi', cast(max(date_key) as timestamp), cast(cast(any_value(asked_at) as date) - interval 2 day as timestamp),
         cast(max(date_key) as timestamp) < cast(any_value(asked_at) as date) - interval 2 day from kpi, asked"""))
def q_dq_recency(spark, sf_dir):
    """Freshness some hours after the newest staged hour: staging (4 hours) is stale, the KPI (2 days) is not."""
    stg = materialize(m.staged(spark, sf_dir))
    kpi = m.ops.fct_renewable_kpi(m.int_daily_from(stg))
    as_of = stg.select(F.timestamp_add("HOUR", F.lit(AS_OF_HOURS), F.max("ts_hour"))).scalar()
    rows = [dq.recency(stg, "ts_hour", "hour", 4, as_of=as_of).withColumn("model", F.lit("stg_generation")),
            dq.recency(kpi, "date_key", "day", 2, as_of=as_of, ignore_time_component=True)
            .withColumn("model", F.lit("fct_renewable_kpi")).withColumn("newest", F.col("newest").cast("timestamp"))]
    return rows[0].unionByName(rows[1])


@query("dq_negative_mw", Q(STG, "select ts_hour, country_code, energy_source, actual_mw from stg where actual_mw < 0"))
def q_dq_negative_mw(spark, sf_dir):
    """Staged rows with negative actual generation."""
    return dq.negative_mw(m.staged(spark, sf_dir))


@query("dq_ts_range", Q(VIO_STG, f"""select ts_hour from vio
  where ts_hour < timestamp '{dq.TS_MIN}' or ts_hour > timestamp '{dq.TS_MAX}'"""))
def q_dq_ts_range(spark, sf_dir):
    """Staged hours outside the accepted timestamp window."""
    return dq.timestamp_range(violating(spark, sf_dir))


@query("dq_coverage", Q(VIO_STG, f"""select date_key, country_code, count(*) as hour_count from vio
  where actual_mw is not null or forecast_mw is not null group by 1, 2 having count(*) < {dq.MIN_ROWS_PER_DAY}"""))
def q_dq_coverage(spark, sf_dir):
    """Country-days with fewer than 18 reported rows."""
    return dq.row_coverage(violating(spark, sf_dir))


@query("dq_coverage_hours", Q(VIO_STG, f"""select date_key, country_code, count(distinct hour_of_day) as hour_count
  from vio where actual_mw is not null or forecast_mw is not null group by 1, 2
  having count(distinct hour_of_day) < {dq.MIN_ROWS_PER_DAY}"""))
def q_dq_coverage_hours(spark, sf_dir):
    """Strict coverage: country-days with fewer than 18 distinct reported hours."""
    return dq.row_coverage(violating(spark, sf_dir), distinct_hours=True)


@query("dq_country", Q(KPI + [o.DIM_COUNTRY], """select distinct k.country_code from kpi k
  left join dim_country d on k.country_code = d.country_code where d.country_code is null"""))
def q_dq_country(spark, sf_dir):
    """KPI country codes missing from the country dimension."""
    return dq.country_code_valid(m.kpi(spark, sf_dir), dims.dim_country(spark))


_TWINS = {"stg_generation": "vio", "int_daily_generation": "idg", "int_carbon_intensity": "ci",
          "fct_renewable_kpi": "kpi", "fct_grid_carbon_intensity": "fct_ci"}


def _summary_sql() -> str:
    """Failure counts by definition: rows that meet a test's condition, keys that occur twice."""
    parts = [(check, model, "error", f"select 1 from {table} where {test}")
             for model, table in _TWINS.items() for check, test in ROW_TESTS[model]]
    parts += [("unique_key", model, "error", f"select 1 from {table} group by {', '.join(KEYS[model])} having count(*) > 1")
              for model, table in _TWINS.items()]
    parts += [
        ("minimum_row_coverage", "stg_generation", "error", f"""select 1 from vio
           where actual_mw is not null or forecast_mw is not null group by date_key, country_code
           having count(*) < {dq.MIN_ROWS_PER_DAY}"""),
        ("country_code_valid", "fct_renewable_kpi", "error", """select distinct country_code from kpi
           where country_code is null or country_code not in (select country_code from dim_country)"""),
        ("not_null_timestamp", "raw_entsoe_generation", "error", 'select 1 from gen_raw where "timestamp" is null'),
        ("not_null_timestamp", "raw_era5_weather", "error", 'select 1 from weather_raw where "timestamp" is null'),
        ("recency_4_hours", "stg_generation", "warn",
         f"select 1 from vio having max(ts_hour) < (select max(ts_hour) + interval {AS_OF_HOURS - 4} hour from vio)"),
        ("recency_2_days", "fct_renewable_kpi", "warn", f"""select 1 from kpi
           having max(date_key) < cast((select max(ts_hour) + interval {AS_OF_HOURS} hour from vio) as date) - interval 2 day"""),
    ]
    body = "\n  union all\n  ".join(
        f"select '{c}' as \"check\", '{mdl}' as model, '{sev}' as severity, count(*) as failures from ({sql})"
        for c, mdl, sev, sql in parts)
    chain = []
    for p in (VIO_KPI, VIO_FCT, [o.DIM_COUNTRY, o.WEATHER_RAW]):
        chain += [cte for cte in p if cte not in chain]
    return o.with_ctes(*chain, select=body)


@query("dq_summary", _summary_sql())
def q_dq_summary(spark, sf_dir):
    """Failure counts of every declared check (the quality gate's input) over rows with violations."""
    # models are materialised once (as the warehouse builds tables before testing them);
    # every check then reads a model instead of re-deriving it from the raw rows
    # Row tests are counted while a model is written: they cost no scan.
    seen = dq.Observed()

    def written(name, df):
        return materialize(seen.watch(df, row_checks(name, df)))

    stg = written("stg_generation", violating(spark, sf_dir))

    def shares():
        daily = written("int_daily_generation", m.int_daily_from(stg))
        return daily, written("fct_renewable_kpi", m.ops.fct_renewable_kpi(daily))

    def emissions():
        hourly = written("int_carbon_intensity", m.hourly_ci_from(stg, spark))
        return hourly, written("fct_grid_carbon_intensity", m.ops.fct_grid_carbon_intensity(hourly))

    (daily, kpi), (hourly, fct) = together(spark, shares, emissions)
    checks = key_checks({"stg_generation": stg, "int_daily_generation": daily, "int_carbon_intensity": hourly,
                         "fct_renewable_kpi": kpi, "fct_grid_carbon_intensity": fct}, dims.dim_country(spark))
    checks += source_checks(load_gen_raw(spark, sf_dir), load_weather_raw(spark, sf_dir))
    as_of = stg.select(F.timestamp_add("HOUR", F.lit(AS_OF_HOURS), F.max("ts_hour"))).scalar()
    checks += recency_checks(stg, kpi, as_of)
    return dq.summary(checks).unionByName(spark.createDataFrame(seen.counts(), dq.SUMMARY))
