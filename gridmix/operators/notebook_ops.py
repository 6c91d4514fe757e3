"""Exploration-style operators: per-source totals, per-variable counts, hourly generation x
pivoted weather, top generation hours, and the PSR relabel guard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix import dims
from gridmix import functions as gf


def generation_frame(gen_raw: DataFrame) -> DataFrame:
    """Actual-generation rows with a real timestamp (forecast rows and bad stamps dropped)."""
    return gen_raw.where(F.col("domain") == "generation").select(
        gf.epoch_ns_to_ts("timestamp").alias("timestamp"), "country", "energy_source", "psr_type",
        gf.nan_to_null("actual_MW").alias("actual_MW"),
    ).where(F.col("timestamp").isNotNull())


def weather_frame(weather_raw: DataFrame) -> DataFrame:
    return weather_raw.select(
        gf.epoch_ns_to_ts("timestamp").alias("timestamp"), "lat", "lon", "variable", gf.nan_to_null("value").alias("value"), "country",
    ).where(F.col("timestamp").isNotNull() & F.col("value").isNotNull())


def source_totals(gen: DataFrame) -> DataFrame:
    return gen.groupBy("energy_source").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("actual_MW").alias("total_mw"),
        F.round(F.sum("actual_MW"), 2).alias("total_generation_mw"),
    )


def rows_per_variable(weather: DataFrame) -> DataFrame:
    return weather.groupBy("variable").agg(F.count(F.lit(1)).alias("row_count"))


def hourly_generation_with_weather(gen: DataFrame, weather: DataFrame,
                                   variables: list[str] | None = None) -> DataFrame:
    """Hourly total generation per country, left-joined with the country-mean of each weather
    variable pivoted to columns.  The pivot values are listed, so Spark needs no extra job to
    discover them; the grid mean is exact at 1e-6."""
    variables = variables or sorted(dims.WIND_VARIABLES + ["ssrd", "t2m"])
    hourly = gen.groupBy("timestamp", "country").agg(F.sum("actual_MW").alias("generation_mw"))
    per_var = weather.where(F.col("variable").isin(variables)) \
        .groupBy("timestamp", "country", "variable").agg(gf.exact_avg("value", 6, 6).alias("avg_value"))
    wide = per_var.groupBy("timestamp", "country").pivot("variable", variables).agg(F.first("avg_value"))
    return hourly.join(wide, ["timestamp", "country"], "left")


def top_hours(joined: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest-generation country-hours (ties: earlier hour, then country)."""
    return joined.orderBy(F.col("generation_mw").desc_nulls_last(), "timestamp", "country") \
        .select("timestamp", "country", "generation_mw").limit(n)


def relabel_psr_sources(df: DataFrame) -> DataFrame:
    """Rename ``energy_source`` from ``psr_type`` when both columns exist; otherwise pass through."""
    if "psr_type" not in df.columns or "energy_source" not in df.columns:
        return df
    return df.withColumn("energy_source",
                         F.coalesce(F.try_element_at(dims.map_literal(dims.PSR_TO_SOURCE), F.col("psr_type")),
                                    F.col("energy_source")))
