"""Data-quality checks.  Each check returns the offending rows (empty = pass), so a check is
just another lazy DataFrame; ``summary`` counts failures of many checks in one job and ``gate``
raises when an error-severity check failed (warn-severity checks only report)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Fixed values — bounds of the singular tests: timestamp window and daily row floor.
TS_MIN = "2024-01-01"
TS_MAX = "2026-12-31"
MIN_ROWS_PER_DAY = 18


class QualityGateError(RuntimeError):
    pass


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once (with their count)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Rows outside [min, max] (or the open interval); NULLs pass."""
    c = F.col(column)
    bad: Column = F.lit(False)
    if min_value is not None:
        bad = bad | ((c < F.lit(min_value)) if inclusive else (c <= F.lit(min_value)))
    if max_value is not None:
        bad = bad | ((c > F.lit(max_value)) if inclusive else (c >= F.lit(max_value)))
    return df.where(bad)


def recency(df: DataFrame, field: str, datepart: str, interval: int, as_of: Column | None = None,
            ignore_time_component: bool = False) -> DataFrame:
    """One status row: the newest ``field`` value, the threshold ``as_of - interval`` and
    whether the table is stale.  ``as_of`` defaults to the current timestamp."""
    newest = F.max(F.col(field))
    now = as_of if as_of is not None else F.current_timestamp()
    if ignore_time_component:
        newest, now = F.to_date(newest), F.to_date(now)
    unit = datepart.upper()
    threshold = F.timestamp_add(unit, F.lit(-interval), now.cast("timestamp"))
    return df.agg(newest.alias("newest")).select(
        F.col("newest"), threshold.alias("threshold"),
        (F.col("newest").cast("timestamp") < threshold).alias("is_stale"),
    )


def negative_mw(stg: DataFrame) -> DataFrame:
    return stg.where(F.col("actual_mw").isNotNull() & (F.col("actual_mw") < 0)) \
        .select("ts_hour", "country_code", "energy_source", "actual_mw")


def timestamp_range(stg: DataFrame, lo: str = TS_MIN, hi: str = TS_MAX) -> DataFrame:
    ts = F.col("ts_hour")
    return stg.where((ts < F.lit(lo).cast("timestamp")) | (ts > F.lit(hi).cast("timestamp"))).select("ts_hour")


def row_coverage(stg: DataFrame, min_rows: int = MIN_ROWS_PER_DAY, distinct_hours: bool = False) -> DataFrame:
    """Country-days with fewer than ``min_rows`` reported rows (all sources together, as the
    original test counts), or with fewer distinct hours when ``distinct_hours``."""
    rows = stg.where(F.col("actual_mw").isNotNull() | F.col("forecast_mw").isNotNull())
    n = F.count_distinct("hour_of_day") if distinct_hours else F.count(F.lit(1))
    return rows.groupBy("date_key", "country_code").agg(n.alias("hour_count")) \
        .where(F.col("hour_count") < min_rows)


def country_code_valid(fact: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Country codes of ``fact`` missing from the country dimension (seed-sized, broadcast)."""
    codes = fact.select("country_code").distinct()
    return codes.join(F.broadcast(dim_country.select("country_code")), "country_code", "left_anti")


@dataclass(frozen=True)
class Check:
    """A named check.  Either ``failures`` (offending rows of a key-level check) or a row-level
    ``predicate`` over ``source`` (a row fails when the predicate is TRUE).  ``sliced`` are the offending rows with the
    slice's columns, where ``failures`` lacks them."""
    name: str
    model: str
    failures: DataFrame | None = None
    severity: str = "error"
    predicate: Column | None = None
    source: DataFrame | None = None
    sliced: DataFrame | None = None


def row_check(name: str, model: str, source: DataFrame, predicate: Column, severity: str = "error") -> Check:
    return Check(name, model, None, severity, predicate, source)


def offending(check: Check) -> DataFrame:
    return check.failures if check.failures is not None else check.source.where(check.predicate)


def summary(checks: list[Check]) -> DataFrame:
    """(check, model, severity, failures) for every check.

    Row-level checks on the same model are fused into ONE aggregation (``count_if`` per
    predicate), so a model is scanned once for all of them; key-level checks are one
    aggregation each."""
    parts = []
    by_source: dict[int, list[Check]] = {}
    for c in checks:
        if c.predicate is not None:
            by_source.setdefault(id(c.source), []).append(c)
        else:
            parts.append(c.failures.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(c.name).alias("check"), F.lit(c.model).alias("model"), F.lit(c.severity).alias("severity"),
                F.col("failures")))
    for group in by_source.values():
        counts = group[0].source.agg(*[F.count_if(F.coalesce(c.predicate, F.lit(False))).alias(f"c{i}")
                                       for i, c in enumerate(group)])
        rows = F.array(*[F.struct(F.lit(c.name).alias("check"), F.lit(c.model).alias("model"),
                                  F.lit(c.severity).alias("severity"), F.col(f"c{i}").alias("failures"))
                         for i, c in enumerate(group)])
        parts.append(counts.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


class Observed:
    """Row checks counted while their model is written, so that they cost no scan.

    ``watch`` puts the counts of a model's checks into its plan; they are there when an action has run on what it returns.
    ``counts`` gives them as (check, model, severity, failures).  A stage that is recomputed after a lost executor may count
    its rows again: whether a check has failures is always right, their number is right without such a loss."""

    def __init__(self):
        self.watched: list[tuple[Observation, list[Check]]] = []

    def watch(self, df: DataFrame, checks: list[Check]) -> DataFrame:
        if not checks:
            return df
        seen = Observation()
        self.watched.append((seen, checks))
        return df.observe(seen, *[F.count_if(F.coalesce(c.predicate, F.lit(False))).alias(f"c{i}") for i, c in enumerate(checks)])

    def has(self, check: Check) -> bool:
        return any((c.name, c.model) == (check.name, check.model) for _, checks in self.watched for c in checks)

    def counts(self) -> list[tuple[str, str, str, int]]:
        """A row per check; the watched models must have been written."""
        return [(c.name, c.model, c.severity, seen.get[f"c{i}"]) for seen, checks in self.watched for i, c in enumerate(checks)]


SUMMARY = "check string, model string, severity string, failures long"


def failing_slices(checks: list[Check]) -> DataFrame:
    """(date_key, country_code, check, model, failures): failures of every check by slice.  Checks must be over rows, or give
    offending rows, that have the slice's columns; an offending row without one of them counts for the slices of
    that country or day that are null."""
    parts, by_source = [], {}
    for c in checks:
        if c.predicate is not None:
            by_source.setdefault(id(c.source), []).append(c)
        else:
            parts.append(_sliced(c.failures if c.sliced is None else c.sliced).groupBy("date_key", "country_code").agg(F.count(F.lit(1)).alias("failures"))
                         .select("date_key", "country_code", F.lit(c.name).alias("check"), F.lit(c.model).alias("model"), "failures"))
    for group in by_source.values():
        counts = _sliced(group[0].source).groupBy("date_key", "country_code").agg(
            *[F.count_if(F.coalesce(c.predicate, F.lit(False))).alias(f"c{i}") for i, c in enumerate(group)])
        rows = F.array(*[F.struct(F.lit(c.name).alias("check"), F.lit(c.model).alias("model"), F.col(f"c{i}").alias("failures"))
                         for i, c in enumerate(group)])
        parts.append(counts.select("date_key", "country_code", F.inline(rows)))
    return reduce(DataFrame.unionByName, parts).where("failures > 0")


def _sliced(df: DataFrame) -> DataFrame:
    """Rows with the slice's columns: a missing day is that of the row's hour, if it has one."""
    out = df
    if "date_key" not in df.columns:
        out = out.withColumn("date_key", F.to_date("ts_hour") if "ts_hour" in df.columns else F.lit(None).cast("date"))
    if "country_code" not in df.columns:
        out = out.withColumn("country_code", F.lit(None).cast("string"))
    return out


def stop(counts: list[tuple[str, str, str, int]]) -> None:
    """Raise if an error-severity check of (check, model, severity, failures) failed."""
    failed = [(check, model, n) for check, model, severity, n in counts if severity == "error" and n]
    if failed:
        raise QualityGateError("data-quality gate failed: " + ", ".join(f"{m}.{c}={n}" for c, m, n in failed))


def gate(summary_df: DataFrame) -> DataFrame:
    """Stop the pipeline if an error-severity check failed.  Reads only the tiny summary."""
    stop([(r["check"], r["model"], r["severity"], r["failures"]) for r in summary_df.where("failures > 0").collect()])
    return summary_df
