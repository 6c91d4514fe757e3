"""File-stream increments: raw files that land in drop folders replace the silver slices they cover.

Triggered with ``availableNow``: a scheduled run takes whatever arrived since the last run and stops.  A drop
is a folder ``drop=<n>``; of drops in one batch that cover a slice (country, date, domain), the last wins, and a
later batch replaces what an earlier one wrote.  A corrected file, up or down, therefore gives the same silver
as the batch increment.  Batches that are repeated after a failure replace the same slices again."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix import session, sinks
from gridmix.sources.tables import SILVER_GENERATION_SCHEMA


def landing_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(T.StructType([*SILVER_GENERATION_SCHEMA.fields, T.StructField("drop", T.LongType())]))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(landing)


def latest_drop(rows: DataFrame) -> DataFrame:
    """Rows of each slice's last drop.  The join's small side has one row per slice."""
    rows = sinks.with_date_partition(rows)
    last = rows.groupBy(*sinks.SILVER_PARTITIONS).agg(F.max("drop").alias("drop"))
    return rows.join(last, [*sinks.SILVER_PARTITIONS, "drop"]).drop("drop", "date")


def run_available_now(spark: SparkSession, landing: str, silver: str, checkpoint: str) -> None:
    """Bring all landed files not yet seen (per the checkpoint) into the silver table, then stop.  Re-running
    with no new files is a no-op."""
    session.configure(spark)

    def replace(batch: DataFrame, _: int) -> None:
        sinks.write_silver_generation(latest_drop(batch), silver)

    q = (landing_stream(spark, landing).writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(replace).trigger(availableNow=True).start())
    q.awaitTermination()


def batch_run(checkpoint: str, batch_id: int) -> str:
    """A batch's run: the same whenever it is repeated, another for any other stream."""
    return f"b{hashlib.sha256(checkpoint.encode()).hexdigest()[:12]}-{batch_id}"


def publish_batch(batch: DataFrame, batch_id: int, silver: str, warehouse: str, checkpoint: str, **options) -> bool:
    """One batch into silver, and the models of the slices that it brought published as one version.

    The manifest is the ledger of batches: a batch whose run it names is published, and nothing is done.  A batch
    that failed before that replaces the same silver slices and writes the same run's folders again.  Returns whether it published."""
    from gridmix.plans import increments
    from gridmix.sinks.versions import Store

    spark, run = batch.sparkSession, batch_run(checkpoint, batch_id)
    if run in Store(spark, warehouse).runs():
        return False
    rows = session.materialize(latest_drop(batch), "batch")
    sinks.write_silver_generation(rows, silver)
    slices = session.materialize(sinks.with_date_partition(rows).select(
        F.col("date").alias("date_key"), F.col("country").alias("country_code")).distinct(), "touched")
    bounds = slices.agg(F.min("date_key"), F.max("date_key")).first()
    if bounds[1] is None:
        return False
    increments.publish_marts(spark, silver, warehouse, bounds[0], bounds[1], slices=slices, run=run, **options)
    return True


def publish_available_now(spark: SparkSession, landing: str, silver: str, warehouse: str, checkpoint: str, **options) -> None:
    """All landed files not yet seen, into silver and on to the published marts, then stop.  ``options`` are those of
    ``increments.publish_marts`` (gate, held-back slices, weather)."""
    session.configure(spark)
    q = (landing_stream(spark, landing).writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, n: publish_batch(batch, n, silver, warehouse, checkpoint, **options) and None)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_silver(spark: SparkSession, silver: str) -> DataFrame:
    return sinks.read_silver_generation(spark, silver)
