"""Staging models: typed, filtered, de-duplicated silver rows.

``stg_generation``  one row per (ts_hour, country_code, energy_source)
``stg_wind``        one row per weather cell (ts, lat, lon, country) with u/v, speed, direction
``stg_solar``       one row per weather cell with radiation, cloud cover, temperature
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix import dims
from gridmix import functions as gf

STG_GENERATION_COLUMNS = [
    "ts_hour", "country_code", "country_name", "date_key", "hour_of_day", "month_of_year",
    "energy_source", "psr_code", "actual_mw", "forecast_mw", "generation_mw", "forecast_error_pct",
]


def stg_generation(gen_raw: DataFrame) -> DataFrame:
    """Silver generation -> staging.

    * epoch-ns -> timestamp, NaN -> NULL, keep rows with a timestamp and (actual >= 0 OR
      forecast >= 0) under three-valued logic (a negative actual beside a valid forecast stays);
    * truncate to the hour and keep, per (hour, country, source), the row with the largest
      actual (NULLs last), ties broken by forecast desc (NULLs last) then PSR code;
    * unified generation (actual else forecast) and the forecast error ratio.

    The top-1 runs as ``row_number() = 1``; Catalyst plans it as a WindowGroupLimit that also
    runs *before* the shuffle, so a hot (hour, country, source) key is cut to one row per map
    task and never concentrates in one reducer.
    """
    ts = gf.epoch_ns_to_ts("timestamp")
    actual, forecast = gf.nan_to_null("actual_MW"), gf.nan_to_null("forecast_MW")
    # filter on the raw columns, then one projection (each DataFrame step costs an analysis)
    filtered = gen_raw.where(ts.isNotNull() & ((actual >= 0) | (forecast >= 0))).select(
        F.date_trunc("hour", ts).alias("ts_hour"),
        F.col("country").alias("country_code"),
        F.col("energy_source"),
        F.col("psr_type").alias("psr_code"),
        actual.alias("actual_mw"), forecast.alias("forecast_mw"),
        gf.country_name("country").alias("country_name"),
        F.to_date(ts).alias("date_key"),
        F.hour(ts).alias("hour_of_day"),
        F.month(ts).alias("month_of_year"),
    )
    w = Window.partitionBy("ts_hour", "country_code", "energy_source").orderBy(
        F.col("actual_mw").desc_nulls_last(), F.col("forecast_mw").desc_nulls_last(), F.col("psr_code").asc_nulls_last()
    )
    deduped = filtered.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return deduped.select(
        *STG_GENERATION_COLUMNS[:10],
        gf.unified_generation("actual_mw", "forecast_mw").alias("generation_mw"),
        gf.forecast_error_ratio("actual_mw", "forecast_mw").alias("forecast_error_pct"),
    )


def weather_cells(weather_raw: DataFrame) -> DataFrame:
    """One pivot for both weather staging models: per (ts, lat, lon, country) the max value of
    each of the five variables plus flags saying whether the cell had any wind / solar row.

    Wind and solar read the same silver table.  ``intermediate.hourly_weather`` aggregates both
    from this one pivot in a single pass (one scan, two shuffles).  Read separately as
    ``stg_wind`` and ``stg_solar``, each side prunes different columns and Spark plans its own
    scan.
    """
    wanted = dims.WIND_VARIABLES + dims.SOLAR_VARIABLES
    src = weather_raw.select(
        gf.epoch_ns_to_ts("timestamp").alias("ts_hour"), "lat", "lon", "country", "variable",
        gf.nan_to_null("value").alias("value"),
    ).where(F.col("variable").isin(wanted) & F.col("ts_hour").isNotNull() & F.col("value").isNotNull())
    var = F.col("variable")
    return src.groupBy(
        "ts_hour", F.to_date("ts_hour").alias("date_key"), F.hour("ts_hour").alias("hour_of_day"),
        "lat", "lon", "country",
    ).agg(
        F.max(F.when(var == "u100", F.col("value"))).alias("wind_100m_u"),
        F.max(F.when(var == "v100", F.col("value"))).alias("wind_100m_v"),
        F.max(F.when(var == "ssrd", F.col("value"))).alias("solar_radiation_jm2"),
        F.max(F.when(var == "tcc", F.col("value"))).alias("cloud_cover_fraction"),
        F.max(F.when(var == "t2m", F.col("value"))).alias("temp_2m_kelvin"),
        F.max(var.isin(dims.WIND_VARIABLES)).alias("has_wind"),
        F.max(var.isin(dims.SOLAR_VARIABLES)).alias("has_solar"),
    )


def _wind_columns(cells: DataFrame) -> DataFrame:
    u, v = F.col("wind_100m_u"), F.col("wind_100m_v")
    return cells.select(
        "ts_hour", "date_key", "hour_of_day", "lat", "lon",
        F.col("country").alias("country_code"), gf.country_name("country").alias("country_name"),
        "wind_100m_u", "wind_100m_v",
        gf.wind_speed(u, v).alias("wind_speed_100m"),
        gf.wind_direction_math(u, v).alias("wind_direction_degrees"),
    )


def _solar_columns(cells: DataFrame) -> DataFrame:
    return cells.select(
        "ts_hour", "date_key", "hour_of_day", "lat", "lon",
        F.col("country").alias("country_code"), gf.country_name("country").alias("country_name"),
        "solar_radiation_jm2", "cloud_cover_fraction", "temp_2m_kelvin",
        gf.kelvin_to_celsius("temp_2m_kelvin").alias("temp_2m_celsius"),
        gf.radiation_wm2("solar_radiation_jm2").alias("solar_radiation_wm2"),
    )


def stg_wind(weather_raw: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    cells = weather_cells(weather_raw) if cells is None else cells
    return _wind_columns(cells.where("has_wind"))


def stg_solar(weather_raw: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    cells = weather_cells(weather_raw) if cells is None else cells
    return _solar_columns(cells.where("has_solar"))


def align_forecast(gen_raw: DataFrame) -> DataFrame:
    """Optional staging variant: the actual and the day-ahead forecast of a (hour, country,
    source) on ONE row, so the forecast error is defined (the default staging keeps one
    source row and drops the forecast row whenever an actual exists).

    Equivalent to a full outer join of the per-key actual and forecast aggregates, written as
    one conditional aggregation (one shuffle, no join): the largest valid actual of the
    generation rows and the largest valid forecast of the forecast rows."""
    ts = gf.epoch_ns_to_ts("timestamp")
    actual, forecast = gf.nan_to_null("actual_MW"), gf.nan_to_null("forecast_MW")
    rows = gen_raw.where(ts.isNotNull()).select(
        F.date_trunc("hour", ts).alias("ts_hour"), F.col("country").alias("country_code"), F.col("energy_source"),
        F.when(F.col("domain") != "forecast", F.when(actual >= 0, actual)).alias("a"),
        F.when(F.col("domain") == "forecast", F.when(forecast >= 0, forecast)).alias("f"),
    )
    agg = rows.groupBy("ts_hour", "country_code", "energy_source").agg(
        F.max("a").alias("actual_mw"), F.max("f").alias("forecast_mw"))
    return agg.where(F.col("actual_mw").isNotNull() | F.col("forecast_mw").isNotNull()).select(
        "ts_hour", "country_code", gf.country_name("country_code").alias("country_name"),
        F.to_date("ts_hour").alias("date_key"), F.hour("ts_hour").alias("hour_of_day"), "energy_source",
        "actual_mw", "forecast_mw",
        gf.unified_generation("actual_mw", "forecast_mw").alias("generation_mw"),
        gf.forecast_error_ratio("actual_mw", "forecast_mw").alias("forecast_error_pct"),
    )
