"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridmix import session

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def normalize(df: DataFrame) -> DataFrame:
    """Result conventions shared with the oracle: integers as BIGINT, floats as DOUBLE,
    timestamps as naive UTC (TIMESTAMP_NTZ), decimals as DOUBLE."""
    exprs, changed = [], False
    for f in df.schema.fields:
        name = "`" + f.name.replace("`", "``") + "`"
        t = f.dataType
        target = None
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            target = "bigint"
        elif isinstance(t, (T.FloatType, T.DecimalType)):
            target = "double"
        elif isinstance(t, T.TimestampType):
            target = "timestamp_ntz"
        if target:
            changed = True
            exprs.append(f"cast({name} as {target}) as {name}")
        else:
            exprs.append(name)
    return df.selectExpr(*exprs) if changed else df


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` (and its oracle SQL if it has one)."""

    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.configure(spark)
            return normalize(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from gridmix.plans import models, reports, notebook, quality_checks, bronze, increments, tables  # noqa: F401
