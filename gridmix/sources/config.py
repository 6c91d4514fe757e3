"""The per-country configuration (JSON object keyed by country code) and CSV seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix import dims

_ENTRY = ("struct<country_name: string, entsoe_areas: array<struct<code: string, label: string>>, "
          "era5_area: array<double>>")


def read_country_config(spark: SparkSession, path: str) -> DataFrame:
    """``{"DE": {"country_name": …, "entsoe_areas": [{code, label}], "era5_area": [N, W, S, E]}, …}``
    -> one row per country (country_code, country_name, entsoe_areas, era5_area)."""
    text = spark.read.text(path, wholetext=True)
    m = text.select(F.explode(F.from_json("value", f"map<string, {_ENTRY}>")).alias("country_code", "c"))
    return m.select("country_code", "c.country_name", "c.entsoe_areas", "c.era5_area")


def country_areas(config: DataFrame) -> DataFrame:
    """One row per (country, bidding zone) with the bounding box split into named columns."""
    return config.select(
        "country_code", "country_name", F.inline("entsoe_areas"),
        F.col("era5_area")[0].alias("north"), F.col("era5_area")[1].alias("west"),
        F.col("era5_area")[2].alias("south"), F.col("era5_area")[3].alias("east"))


def read_energy_source_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(dims.ENERGY_SOURCE_SCHEMA).csv(path)


def read_country_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(dims.COUNTRY_SCHEMA).csv(path)
