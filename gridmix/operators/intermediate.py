"""Intermediate models: daily generation, hourly carbon intensity, generation x weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix import functions as gf


def int_daily_generation(stg: DataFrame) -> DataFrame:
    """Per (date, country, source): avg/max/min/sum of hourly MW (rounded 2), hours reported,
    the country-day total over the *rounded* source sums and the source's share of it.

    The country-day total is a window sum over the daily aggregate instead of a self-join.
    Staged rows are unique per (hour, country, source), so a (date, country) group holds at
    most 24 x sources rows: one repartition by (date, country) is skew-safe and serves the
    daily aggregate, the share window and a KPI aggregate on top without further exchanges.
    """
    daily = stg.repartition("date_key", "country_code").groupBy(
        "date_key", "energy_source", "country_code", "country_name").agg(
        F.round(F.avg("actual_mw"), 2).alias("avg_hourly_mw"),
        F.round(F.max("actual_mw"), 2).alias("max_hourly_mw"),
        F.round(F.min("actual_mw"), 2).alias("min_hourly_mw"),
        F.round(F.sum("actual_mw"), 2).alias("total_mwh"),
        F.count(F.lit(1)).alias("hours_reported"),
    )
    total = F.sum("total_mwh").over(Window.partitionBy("date_key", "country_code"))
    return daily.withColumn("total_mwh_all_sources", total).select(
        "date_key", "country_code", "country_name", "energy_source", "avg_hourly_mw", "max_hourly_mw",
        "min_hourly_mw", "total_mwh", "hours_reported", "total_mwh_all_sources",
        F.round(F.col("total_mwh") * F.lit(100.0) / F.greatest(F.col("total_mwh_all_sources"), F.lit(0.001)), 2)
        .alias("pct_of_total"),
    )


def int_carbon_intensity(stg: DataFrame, dim_energy_source: DataFrame) -> DataFrame:
    """Hourly carbon intensity per country: generation-weighted mean emission factor over the
    positive-generation sources (unknown sources count with factor 0), total / renewable MW and
    the non-renewable emission mass (MW x g/kWh = kg/h, kept under its historical name).

    The energy-source dimension has one row per PSR code (20 rows), so it is broadcast.
    Rows are repartitioned by (date, country) — bounded groups after de-duplication — so the
    daily carbon mart aggregates on top without another exchange.
    """
    gen = stg.where(F.col("actual_mw") > 0).select(
        "ts_hour", "date_key", "hour_of_day", "country_code", "country_name", "energy_source", "actual_mw")
    dim = F.broadcast(dim_energy_source.select("energy_source", "emission_factor_gco2_kwh", "is_renewable"))
    j = gen.join(dim, "energy_source", "left").repartition("date_key", "country_code")
    mw = F.col("actual_mw")
    ef = F.coalesce(F.col("emission_factor_gco2_kwh"), F.lit(0.0))
    ren = F.col("is_renewable")
    return j.groupBy("ts_hour", "date_key", "hour_of_day", "country_code", "country_name").agg(
        F.round(F.sum(mw * ef) / F.greatest(F.sum(mw), F.lit(0.001)), 2).alias("carbon_intensity_gco2_kwh"),
        F.round(F.sum(mw), 2).alias("total_mw"),
        F.round(F.sum(F.when(ren, mw).otherwise(F.lit(0.0))), 2).alias("renewable_mw"),
        F.round(F.sum(F.when(~F.coalesce(ren, F.lit(False)), mw * ef).otherwise(F.lit(0.0))), 2)
        .alias("total_co2_grams_per_hour"),
    )


def hourly_weather(cells: DataFrame) -> DataFrame:
    """Country-hour wind speed, radiation and temperature means in ONE aggregation over the
    pivoted weather cells (wind means over cells with a wind variable, solar means over cells
    with a solar variable — the same rows the two staging models hold).  Separate wind and
    solar aggregates would scan and pivot the weather twice: their column pruning differs,
    so Spark cannot reuse one exchange for both."""
    u, v = F.col("wind_100m_u"), F.col("wind_100m_v")
    wind = F.when(F.col("has_wind"), gf.wind_speed(u, v))
    rad = F.when(F.col("has_solar"), gf.radiation_wm2("solar_radiation_jm2"))
    temp = F.when(F.col("has_solar"), gf.kelvin_to_celsius("temp_2m_kelvin"))
    return cells.groupBy("ts_hour", F.col("country").alias("country_code")).agg(
        F.avg(wind).alias("avg_wind_speed"),
        gf.exact_avg(rad).alias("avg_solar_radiation"),
        gf.exact_avg(temp).alias("avg_temp"),
    )


def int_generation_weather(stg: DataFrame, hourly: DataFrame) -> DataFrame:
    """Each staged generation row with its country-hour weather (``hourly_weather``); a left
    join, so hours without weather keep NULLs.  The weather side is an aggregate (one row per
    country-hour): AQE broadcasts it when its measured size is small and falls back to a
    shuffle join when it is not."""
    gen = stg.select("ts_hour", "date_key", "hour_of_day", "country_code", "country_name", "energy_source", "actual_mw")
    return gen.join(hourly, ["ts_hour", "country_code"], "left").select(
        "ts_hour", "date_key", "hour_of_day", "country_code", "country_name", "energy_source",
        "actual_mw", "avg_wind_speed", "avg_solar_radiation", "avg_temp")
