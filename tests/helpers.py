from pyspark.sql import types as T

from gridmix.sources.tables import SILVER_GENERATION_SCHEMA

BASE_NS = 1740787200000000000  # 2025-03-01T00:00:00Z
HOUR = 3600 * 10**9
QUARTER = 900 * 10**9


def gen_rows(spark, rows):
    """rows: (offset_ns, country, energy_source, psr, actual, forecast, domain)"""
    data = [(BASE_NS + off, c, s, p, a, f, d) for off, c, s, p, a, f, d in rows]
    return spark.createDataFrame(data, SILVER_GENERATION_SCHEMA)


WEATHER_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()), T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()), T.StructField("variable", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("country", T.StringType()),
])
