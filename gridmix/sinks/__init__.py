"""Writers.  Silver tables are partitioned by country and month and written with dynamic partition overwrite.  A re-run
replaces the slices (country, date and domain) that it has rows for: it writes their months again, with the rows of the months' other
slices as they were.  A retried job converges to the same table.  Slices for which the new input has no rows at all are left as
they are.  Folders and files thus grow with countries and months, not with days."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from gridmix import functions as gf
from gridmix import session
from gridmix.sources.tables import SILVER_GENERATION_SCHEMA, SILVER_WEATHER_SCHEMA

#: A slice: what one file of the source covers, and what a re-run replaces.
SILVER_PARTITIONS = ["country", "date", "domain"]
WEATHER_PARTITIONS = ["country", "date"]


#: Partitions of the silver tables; the month is its first day.  A day's rows of a country are too few for files of their own.
MONTH = "date_month"
_FOLDERS = ["country", MONTH]


def with_date_partition(silver: DataFrame) -> DataFrame:
    """Add the slice's ``date`` (UTC day of the epoch-ns timestamp)."""
    return silver.withColumn("date", F.to_date(gf.epoch_ns_to_ts("timestamp")))


# cap on rows per written file (keeps files scan-friendly without a shuffle)
MAX_RECORDS_PER_FILE = 5_000_000


def _write_slices(df: DataFrame, path: str, slices: Sequence[str], schema: T.StructType) -> None:
    """Replace exactly the slices that ``df`` holds.

    Where there is a table already, the new rows are written once and then meet the other slices of their months.  ``REBALANCE``
    gathers a partition's rows into few files and splits partitions that are large, so files are
    neither one per task and partition nor one task's work for a dominant country-month."""
    from gridmix.sinks.versions import matching

    spark = df.sparkSession
    df = df.withColumn(MONTH, F.trunc("date", "month"))
    if session.exists(spark, path):
        df = session.materialize(df, "slices")
        months = df.agg(F.min(MONTH).alias("low"), F.max(MONTH).alias("high")).first()
        there = _read_slices(spark, path, slices, schema)
        # folders of other months aren't read; rows without a time have a folder of their own
        there = there.where(F.col(MONTH).between(F.lit(months.low), F.lit(months.high)) | F.col(MONTH).isNull())
        there = matching(there, df.select(*_FOLDERS).distinct(), _FOLDERS)
        others = matching(there, df.select(*slices).distinct(), slices, "left_anti")
        df = df.unionByName(others, allowMissingColumns=True)
    (df.hint("rebalance", *_FOLDERS).write.mode("overwrite").option("compression", "snappy")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("partitionOverwriteMode", "dynamic")
       .partitionBy(*_FOLDERS).parquet(path))


def _read_slices(spark: SparkSession, path: str, slices: Sequence[str], schema: T.StructType) -> DataFrame:
    more = [T.StructField("date", T.DateType()), T.StructField(MONTH, T.DateType())]
    rows = spark.read.schema(T.StructType([*schema.fields, *more])).parquet(path)
    if rows.columns[-1] != MONTH:  # Spark puts partition columns last
        raise ValueError(f"{path} has folders by day, as earlier versions wrote them: ingest its rows into a new folder")
    return rows.select(*[c for c in schema.names if c not in slices], *slices, MONTH)


def write_silver_generation(silver: DataFrame, path: str) -> None:
    """Silver generation, Snappy Parquet; replaces the slices (country, date, domain) that it has rows for."""
    _write_slices(with_date_partition(silver), path, SILVER_PARTITIONS, SILVER_GENERATION_SCHEMA)


def read_silver_generation(spark: SparkSession, path: str) -> DataFrame:
    """Silver rows with their ``date``, and the month's partition column, by which ``plans.increments.within`` prunes."""
    return _read_slices(spark, path, SILVER_PARTITIONS, SILVER_GENERATION_SCHEMA)


def write_silver_weather(silver: DataFrame, path: str) -> None:
    """Silver weather, Snappy Parquet; replaces the slices (country, date) that it has rows for."""
    _write_slices(with_date_partition(silver), path, WEATHER_PARTITIONS, SILVER_WEATHER_SCHEMA)


def read_silver_weather(spark: SparkSession, path: str) -> DataFrame:
    return _read_slices(spark, path, WEATHER_PARTITIONS, SILVER_WEATHER_SCHEMA)


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*partition_cols).parquet(path)


def write_single_file(df: DataFrame, path: str) -> None:
    """One Parquet file — only for small test outputs (funnels the data into one task)."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def write_repartitioned(df: DataFrame, path: str, n: int) -> int:
    """Write ``n`` files; returns the partition count used."""
    out = df.repartition(n)
    out.write.mode("overwrite").parquet(path)
    return out.rdd.getNumPartitions()


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``.  Other errors than its absence are raised."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def append_missing(spark: SparkSession, df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Skip-if-exists: append only the key groups not yet present at ``path``, null keys like any other.  Returns the rows that
    were appended (lazy; already written).  A table that can't be read, or lacks a key, raises."""
    from gridmix.sinks.versions import matching

    new = df
    if table_exists(spark, path):
        there = spark.read.parquet(path).select(*keys).distinct()
        new = session.materialize(matching(df, there, keys, "left_anti"), "new")
    new.write.mode("append").partitionBy(*keys).parquet(path)
    return new


def save_table(spark: SparkSession, df: DataFrame, name: str, path: str, partition_cols: list[str] | None = None) -> None:
    """Materialise a model as Parquet at ``path`` and (re)register it as an external table."""
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def write_bucketed(spark: SparkSession, df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table at ``path`` in ``buckets`` by ``keys``, sorted, and read it back so that Spark knows that: tables with the
    same buckets join on the keys without a shuffle.

    Spark keeps a bucketing in its catalog alone, so the table is named there while it is written and read; the name is gone when
    this returns, the files stay and what is returned keeps the bucketing."""
    name = "bucketed_" + uuid.uuid4().hex[:12]
    # one task per bucket: each writes one file
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet")
     .saveAsTable(name))
    table = spark.table(name)
    table.schema  # resolved before its name goes
    spark.sql(f"DROP TABLE {name}")
    return table


def written_files(df: DataFrame) -> list[str]:
    """Files backing a DataFrame read from storage."""
    return sorted(df.inputFiles())
