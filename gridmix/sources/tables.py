"""Table readers (A7, A11).  Parquet scans stay lazy so filters and projections reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridmix import session

# Silver layer as written by the ingest step: epoch-nanosecond timestamps stored as INT64.
SILVER_GENERATION_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("country", T.StringType()),
    T.StructField("energy_source", T.StringType()),
    T.StructField("psr_type", T.StringType()),
    T.StructField("actual_MW", T.DoubleType()),
    T.StructField("forecast_MW", T.DoubleType()),
    T.StructField("domain", T.StringType()),
])

SILVER_WEATHER_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("variable", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("country", T.StringType()),
])


# The driver's tables that gridmix reads (explicit schemas: no footer sampling per query).
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables: ``{sf_dir}/{name}.parquet``."""
    session.configure(spark)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def read_silver_generation(spark: SparkSession, path: str) -> DataFrame:
    """Silver generation Parquet (a folder, possibly partitioned by country/date)."""
    session.configure(spark)
    return spark.read.option("recursiveFileLookup", "false").schema(SILVER_GENERATION_SCHEMA).parquet(path)
