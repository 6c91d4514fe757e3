"""Bronze file listings: path-derived columns and file pruning by date (point or interval).

Paths look like ``…/entsoe/{country}/{domain}/{YYYY-MM-DD}/generation.xml`` (one day) and
``…/era5/{country}/{YYYY}/{MM}/{YYYY-MM}_{category}.nc`` (a month) or
``…/{YYYY-MM-DD}_{category}.nc`` (a day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def path_columns(files: DataFrame, path: str = "path") -> DataFrame:
    """Add country, domain, file_date (generation tree) and category / file_min / file_max
    (weather tree, daily or monthly files).  Undated files get NULL dates."""
    p = F.col(path)
    stem = F.regexp_extract(p, r"([^/]+)\.[A-Za-z0-9]+$", 1)
    date_part = F.split(stem, "_").getItem(0)
    daily = F.try_to_date(date_part, "yyyy-MM-dd")
    monthly = F.when(F.length(date_part) == 7, F.try_to_date(F.concat(date_part, F.lit("-01")), "yyyy-MM-dd"))
    folder_date = F.try_to_date(F.regexp_extract(p, r"/(\d{4}-\d{2}-\d{2})/[^/]+$", 1), "yyyy-MM-dd")
    return files.withColumns({
        "country": F.nullif(F.regexp_extract(p, r"/(?:entsoe|era5)/([A-Z]{2})/", 1), F.lit("")),
        "domain": F.nullif(F.regexp_extract(p, r"/entsoe/[A-Z]{2}/([^/]+)/", 1), F.lit("")),
        "file_date": folder_date,
        "category": F.nullif(F.regexp_extract(stem, r"^[0-9-]+_(.+)$", 1), F.lit("")),
        "file_min": F.coalesce(F.when(F.length(date_part) == 10, daily), monthly, folder_date),
        "file_max": F.coalesce(F.when(F.length(date_part) == 10, daily), F.last_day(monthly), folder_date),
    })


def prune_by_date(files: DataFrame, start: Column, end: Column) -> DataFrame:
    """Keep generation files whose folder date lies in [start, end]; undated files are skipped."""
    d = F.col("file_date")
    return files.where(d.isNotNull() & (d >= start) & (d <= end))


def prune_by_overlap(files: DataFrame, start: Column, end: Column) -> DataFrame:
    """Keep weather files whose covered interval [file_min, file_max] overlaps [start, end]."""
    return files.where(F.col("file_min").isNotNull() & (F.col("file_max") >= start) & (F.col("file_min") <= end))
