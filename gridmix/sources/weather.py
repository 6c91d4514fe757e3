"""Weather rows as archives deliver them, made into silver weather: names, types, contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix import dims
from gridmix import functions as gf

REQUIRED = ["timestamp", "lat", "lon", "variable", "value", "country"]


def rename_dimensions(df: DataFrame) -> DataFrame:
    """``valid_time`` / ``time`` -> timestamp, ``latitude`` -> lat, ``longitude`` -> lon, where the target is missing."""
    have = set(df.columns)
    for old, new in dims.WEATHER_DIMENSION_NAMES:
        if old in have and new not in have:
            df, have = df.withColumnRenamed(old, new), (have - {old}) | {new}
    return df


def short_variable(name):
    """Archive variable name -> short name; short names stay."""
    return F.coalesce(F.try_element_at(dims.map_literal(dims.WEATHER_SHORT_NAMES), gf.col_of(name)), gf.col_of(name))


def rename_wide(df: DataFrame) -> DataFrame:
    """Wide frames: archive names of variables and dimensions -> the names that users read."""
    df = rename_dimensions(df)
    return df.withColumnsRenamed({k: v for k, v in dims.WEATHER_VAR_NAMES.items() if k in df.columns})


def _number(df: DataFrame, column: str):
    """A double, or NULL where the text is no number or the number is NaN."""
    c = F.col(column)
    if dict(df.dtypes)[column] == "string":
        c = F.trim(c).try_cast("double")
    return gf.nan_to_null(c)


def _epoch_ns(df: DataFrame, column: str):
    """Epoch nanoseconds from INT64, a timestamp, or text that may be one."""
    kind = dict(df.dtypes)[column]
    if kind == "bigint":
        return F.col(column)
    ts = F.coalesce(F.col(column).try_cast("timestamp"), gf.parse_xml_time(column)) if kind == "string" \
        else F.col(column).cast("timestamp")
    return F.unix_micros(ts) * F.lit(1000)


def to_silver_weather(raw: DataFrame) -> DataFrame:
    """Silver weather rows.  Missing columns fail; rows without a time, place or number are dropped."""
    df = rename_dimensions(raw)
    gf.require_columns(df, REQUIRED)
    rows = df.select(_epoch_ns(df, "timestamp").alias("timestamp"), _number(df, "lat").alias("lat"),
                     _number(df, "lon").alias("lon"), short_variable("variable").alias("variable"),
                     _number(df, "value").alias("value"), F.col("country").cast("string").alias("country"))
    return rows.dropna(subset=["timestamp", "lat", "lon", "value"])
