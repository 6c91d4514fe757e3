"""What a backfill has to fetch: days of a range that no file covers, and the fewest requests for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A month of which more than this share is missing is asked for as a whole.
MONTHLY_SHARE = 0.5
KEY = ["country", "category"]


def wanted_days(keys: DataFrame, start: Column, end: Column) -> DataFrame:
    """(country, category, date) for each key and each day of [start, end): the end is left out.  An empty range has no days."""
    last = F.date_sub(end, 1)
    days = F.when(start < end, F.sequence(start, last))
    return keys.select(*KEY, F.explode(days).alias("date"))


def missing_days(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """Wanted days that no file (country, category, file_min, file_max) covers.  A monthly file covers its days: it is spread
    over them (31 at most), so files and days meet by an equi-join."""
    covered = (files.where(F.col("file_min").isNotNull())
               .select(*KEY, F.explode(F.sequence("file_min", "file_max")).alias("date")).distinct())
    return wanted.join(covered, [*KEY, "date"], "left_anti")


def requests(missing: DataFrame, monthly_share: float = MONTHLY_SHARE) -> DataFrame:
    """(country, category, mode, first_day, last_day, days): a month that lacks more than ``monthly_share`` of its days is
    one monthly request for all of it; elsewhere each run of missing days within a month is one daily range.

    ``days`` counts the missing days that the request brings.  A window holds one key's days of one month."""
    month = Window.partitionBy(*KEY, "month")
    days = missing.distinct().withColumn("month", F.trunc("date", "month"))
    days = days.withColumns({
        "lacking": F.count(F.lit(1)).over(month),
        # days that follow each other have the same difference to their number
        "island": F.date_sub("date", F.row_number().over(month.orderBy("date")))})
    whole = F.col("lacking") > F.dayofmonth(F.last_day("month")) * F.lit(monthly_share)
    days = days.withColumns({"mode": F.when(whole, "monthly").otherwise("daily"),
                             "island": F.when(~whole, F.col("island"))})
    found = days.groupBy(*KEY, "month", "mode", "island").agg(
        F.min("date").alias("first"), F.max("date").alias("last"), F.count(F.lit(1)).alias("days"))
    monthly = F.col("mode") == "monthly"
    return found.select(*KEY, "mode", F.when(monthly, F.col("month")).otherwise(F.col("first")).alias("first_day"),
                        F.when(monthly, F.last_day("month")).otherwise(F.col("last")).alias("last_day"), "days")
