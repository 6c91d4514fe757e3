"""Hot keys and nanosecond Parquet."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from gridmix import operators as ops
from gridmix.sources.tables import SILVER_GENERATION_SCHEMA, read_silver_generation
from helpers import BASE_NS, HOUR, QUARTER


def test_hot_key_third_of_rows(spark):
    # 30k rows: 10k on ONE (hour, country, source) key, the rest spread over 20k keys
    hot = spark.range(10000).select(
        F.lit(BASE_NS).alias("timestamp"), F.lit("DE").alias("country"), F.lit("Fossil Gas").alias("energy_source"),
        F.lit("B04").alias("psr_type"), (F.col("id") % 997).cast("double").alias("actual_MW"),
        F.lit(None).cast("double").alias("forecast_MW"), F.lit("generation").alias("domain"))
    rest = spark.range(20000).select(
        (F.lit(BASE_NS) + (F.col("id") + 1) * HOUR).alias("timestamp"), F.lit("FR").alias("country"),
        F.lit("Nuclear").alias("energy_source"), F.lit("B14").alias("psr_type"),
        F.lit(5.0).alias("actual_MW"), F.lit(None).cast("double").alias("forecast_MW"), F.lit("generation").alias("domain"))
    raw = hot.unionByName(rest).repartition(16)
    stg = ops.stg_generation(raw)
    de = stg.where("country_code = 'DE'").collect()
    assert len(de) == 1 and de[0]["actual_mw"] == 996.0
    assert stg.count() == 20001
    daily = ops.int_daily_generation(stg)
    assert daily.where("country_code = 'FR'").agg(F.sum("hours_reported")).collect()[0][0] == 20000


def test_nanosecond_parquet_silver(spark, tmp_dir):
    # silver as pandas writes it: TIMESTAMP(NANOS) — Spark reads it as INT64 nanoseconds
    ts = pa.array([BASE_NS, BASE_NS + QUARTER + 123], type=pa.timestamp("ns"))
    table = pa.table({
        "timestamp": ts, "country": ["GR", "GR"], "energy_source": ["Solar", "Solar"], "psr_type": ["B16", "B16"],
        "actual_MW": [1.0, 2.0], "forecast_MW": pa.array([None, None], type=pa.float64()),
        "domain": ["generation", "generation"]})
    path = os.path.join(tmp_dir, "silver")
    os.makedirs(path)
    pq.write_table(table, os.path.join(path, "part.parquet"))
    raw = read_silver_generation(spark, path)
    assert raw.schema == SILVER_GENERATION_SCHEMA
    rows = ops.stg_generation(raw).collect()
    assert len(rows) == 1 and rows[0]["actual_mw"] == 2.0 and rows[0]["ts_hour"].isoformat() == "2025-03-01T00:00:00"
