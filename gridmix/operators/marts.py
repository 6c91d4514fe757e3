"""Mart models: daily renewable KPI and daily grid carbon intensity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix import functions as gf


def fct_renewable_kpi(daily: DataFrame) -> DataFrame:
    """Per (date, country): renewable share of the day's MWh, renewable and total MWh, and the
    number of (renewable) sources reporting.

    ``daily`` is unique per (date, country, source) (checked by ``quality.unique_combination``), so the
    distinct source counts are plain conditional counts — no Expand/double aggregation.
    """
    ren = gf.is_renewable_name("energy_source")
    mwh = F.col("total_mwh")
    ren_mwh = F.sum(F.when(ren, mwh).otherwise(F.lit(0.0)))
    total = F.sum(mwh)
    return daily.groupBy("date_key", "country_code", "country_name").agg(
        gf.safe_share_pct(ren_mwh, total).alias("renewable_pct"),
        F.round(ren_mwh, 2).alias("renewable_mwh"),
        F.round(total, 2).alias("total_mwh"),
        F.count(F.when(ren, F.col("energy_source"))).alias("renewable_sources_active"),
        F.count("energy_source").alias("total_sources_active"),
    )


# An (intensity, hour) pair packed into one LONG: intensity in hundredths (the model rounds
# to 2 decimals, so this is exact) times 32, plus the hour (< 32).  min / max over the packed
# key picks the extreme intensity and, among ties, the hour the packing favours — and a LONG
# keeps the aggregation in a code-generated hash aggregate (a struct buffer forces a sort).
_HOURS = 32


def _pack(value_cents, hour):
    return value_cents * F.lit(_HOURS) + hour


def _unpack_hour(key):
    return F.pmod(key, F.lit(_HOURS)).cast("int")


def _unpack_value(key):
    return (F.floor(key / F.lit(_HOURS)) / F.lit(100.0)).cast("double")


def _daily_intensity(hourly: DataFrame) -> DataFrame:
    """Daily stats plus cleanest / dirtiest hour in ONE hash aggregation (ties: earlier hour)."""
    ci, hour = F.col("carbon_intensity_gco2_kwh"), F.col("hour_of_day")
    cents = F.round(ci * F.lit(100.0)).cast("long")
    cleanest = F.min(_pack(cents, hour))                            # low intensity, then early hour
    dirtiest = F.max(_pack(cents, F.lit(_HOURS - 1) - hour))        # high intensity, then early hour
    return hourly.groupBy("date_key", "country_code", "country_name").agg(
        gf.exact_avg(ci, 2, 2).alias("avg_carbon_intensity_gco2_kwh"),
        F.round(F.min(ci), 2).alias("min_carbon_intensity_gco2_kwh"),
        F.round(F.max(ci), 2).alias("max_carbon_intensity_gco2_kwh"),
        F.round(F.avg(F.col("renewable_mw") * F.lit(100.0) / F.greatest(F.col("total_mw"), F.lit(0.001))), 2)
        .alias("avg_renewable_pct"),
        F.count(F.lit(1)).alias("hours_reported"),
        cleanest.alias("_clean"), dirtiest.alias("_dirty"),
    ).select(
        "date_key", "country_code", "country_name", "avg_carbon_intensity_gco2_kwh",
        "min_carbon_intensity_gco2_kwh", "max_carbon_intensity_gco2_kwh", "avg_renewable_pct", "hours_reported",
        _unpack_hour(F.col("_clean")).alias("cleanest_hour_of_day"),
        _unpack_value(F.col("_clean")).alias("cleanest_hour_intensity"),
        (F.lit(_HOURS - 1) - _unpack_hour(F.col("_dirty"))).alias("dirtiest_hour_of_day"),
        _unpack_value(F.col("_dirty")).alias("dirtiest_hour_intensity"),
    )


def typical_cleanest_hour(daily_intensity: DataFrame) -> DataFrame:
    """Per country, the hour that was most often the day's cleanest (ties: earlier hour).
    Computed from the small daily table, so it is always over the whole history."""
    return typical_hour_of_counts(
        daily_intensity.groupBy("country_code", "cleanest_hour_of_day").agg(F.count(F.lit(1)).alias("day_count")))


def typical_hour_of_counts(counts: DataFrame) -> DataFrame:
    """The same from (country_code, cleanest_hour_of_day, day_count), 24 rows a country at most."""
    best = counts.groupBy("country_code").agg(
        F.max(_pack(F.col("day_count"), F.lit(_HOURS - 1) - F.col("cleanest_hour_of_day"))).alias("_b"))
    return best.select("country_code", (F.lit(_HOURS - 1) - _unpack_hour(F.col("_b"))).cast("int").alias("typical_cleanest_hour"))


def fct_grid_carbon_intensity(hourly: DataFrame) -> DataFrame:
    """Per (date, country): avg/min/max intensity, mean hourly renewable %, hours, cleanest and
    dirtiest hour with their intensities, the daily range and the country's typical cleanest
    hour.

    One aggregation gives the daily stats and both extreme hours.  The typical hour is a mode
    over the *daily* rows of a country, computed with two windows after one repartition by
    country (the (country, hour) window is satisfied by that partitioning too), so the hourly
    pipeline runs once — a self-join on the daily table would plan it twice.  A country's
    daily rows are one per day, so even a dominant country is a small window partition.
    """
    return with_typical_hour(_daily_intensity(hourly))


def daily_intensity(hourly: DataFrame) -> DataFrame:
    """The per-day part of the carbon mart (no typical hour): incremental by day."""
    return _daily_intensity(hourly)


def join_typical_hour(daily_intensity_rows: DataFrame, typical: DataFrame) -> DataFrame:
    """Daily intensity rows with their country's typical cleanest hour (one row per country) and the daily range."""
    typical = typical.withColumnRenamed("country_code", "home")
    return daily_intensity_rows.join(typical, F.col("country_code").eqNullSafe(F.col("home"))).select(
        "date_key", "country_code", "country_name", "avg_carbon_intensity_gco2_kwh",
        "min_carbon_intensity_gco2_kwh", "max_carbon_intensity_gco2_kwh", "avg_renewable_pct", "hours_reported",
        "cleanest_hour_of_day", "cleanest_hour_intensity", "dirtiest_hour_of_day", "dirtiest_hour_intensity",
        F.round(F.col("dirtiest_hour_intensity") - F.col("cleanest_hour_intensity"), 2)
        .alias("daily_intensity_range_gco2_kwh"), "typical_cleanest_hour")


def with_typical_hour(daily_intensity_rows: DataFrame) -> DataFrame:
    """Add each country's typical cleanest hour (mode over all the given days) to the daily
    intensity rows, and the daily intensity range."""
    daily = daily_intensity_rows.repartition("country_code")
    hour = F.col("cleanest_hour_of_day")
    n = F.count(F.lit(1)).over(Window.partitionBy("country_code", "cleanest_hour_of_day"))
    best = F.max(_pack(F.col("_n"), F.lit(_HOURS - 1) - hour)).over(Window.partitionBy("country_code"))
    return daily.withColumn("_n", n).select(
        "date_key", "country_code", "country_name", "avg_carbon_intensity_gco2_kwh",
        "min_carbon_intensity_gco2_kwh", "max_carbon_intensity_gco2_kwh", "avg_renewable_pct", "hours_reported",
        "cleanest_hour_of_day", "cleanest_hour_intensity", "dirtiest_hour_of_day", "dirtiest_hour_intensity",
        F.round(F.col("dirtiest_hour_intensity") - F.col("cleanest_hour_intensity"), 2)
        .alias("daily_intensity_range_gco2_kwh"),
        (F.lit(_HOURS - 1) - _unpack_hour(best)).alias("typical_cleanest_hour"),
    )
