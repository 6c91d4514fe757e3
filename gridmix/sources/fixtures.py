"""Silver-shaped inputs derived from the driver's tables (see FIXTURES.md).

``gen_raw``     — generation rows (epoch-ns timestamp, country, PSR code, actual / forecast MW)
                  derived from ``events``; every event becomes one row.
``weather_raw`` — long weather rows (epoch-ns timestamp, lat, lon, variable, value, country)
                  derived from ``embeddings``: each 64-float vector is an 8 x 8 grid.

Both are plain projections (no shuffle); they grow linearly with their source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmix import dims
from gridmix.sources.tables import read_table

# Fixed values — recipe constants of the derived fixtures (FIXTURES.md).
EPOCH_START_NS = 1740528000000000000          # 2025-02-26T00:00:00Z
HOUR_NS = 3600000000000
WEEK_NS = 604800000000000
QUARTER_NS = 900000000000
GEN_COUNTRIES = "DEDKESFRGRITPLSEUK"          # nine 2-letter codes, UK is not in the seed
GRID_COUNTRIES = "DEDKESFRGRITPLSE"           # eight codes, one per grid column
WEATHER_VARS = ["u100", "v100", "ssrd", "t2m"]


def _gen_base_exprs() -> list[str]:
    return [
        f"""{EPOCH_START_NS} + (event_id % 168) * {HOUR_NS}
            + cast(floor(event_id / 10000) as bigint) * {WEEK_NS}
            + (cast(floor(event_id / 168) as bigint) % 4) * {QUARTER_NS}""",
        f"substr('{GEN_COUNTRIES}', cast(1 + 2 * (user_id % 9) as int), 2)",
        "'B' || lpad(cast(1 + (cast(floor(event_id / 336) as bigint) + event_id) % 21 as string), 2, '0')",
        """case when event_id % 11 = 0 then cast(null as double) when event_id % 13 = 0 then cast(-1 as double)
                else floor(value * 4) / 4 end""",
        "cast(case when event_id % 11 = 0 or event_id % 17 = 0 then floor(value * 8) / 8 end as double)",
        "case when event_id % 11 = 0 then 'forecast' else 'generation' end",
    ]


def gen_base(events: DataFrame) -> DataFrame:
    names = ["ts_ns", "country", "psr_type", "actual_MW", "forecast_MW", "domain"]
    return events.selectExpr(*[f"{e} as {n}" for e, n in zip(_gen_base_exprs(), names)])


def gen_raw(events: DataFrame) -> DataFrame:
    """Silver generation schema: timestamp (epoch ns), country, energy_source, psr_type,
    actual_MW, forecast_MW, domain — one projection of ``events``."""
    ts, country, psr, actual, forecast, domain = _gen_base_exprs()
    known = "map(" + ", ".join(f"'{k}', '{v}'" for k, v in sorted(dims.PSR_TO_SOURCE.items())) + ")"
    source = f"coalesce(try_element_at({known}, {psr}), concat('Unknown (', {psr}, ')'))"
    return events.selectExpr(
        f"{ts} as timestamp", f"{country} as country", f"{source} as energy_source", f"{psr} as psr_type",
        f"{actual} as actual_MW", f"{forecast} as forecast_MW", f"{domain} as domain")


def weather_base(embeddings: DataFrame) -> DataFrame:
    cell = embeddings.selectExpr("vec_id", "posexplode(embedding) as (pos, e)")
    names = ", ".join(f"'{v}'" for v in WEATHER_VARS)
    return cell.selectExpr(
        f"{EPOCH_START_NS} + cast(floor(vec_id / 4) as bigint) * {HOUR_NS} as ts_ns",
        "40 + 0.25D * (pos div 8) as lat", "20 + 0.25D * (pos % 8) as lon",
        f"element_at(array({names}), cast(1 + vec_id % 4 as int)) as variable",
        "floor(cast(e as double) * 1024) / 1024 as v",
        f"substr('{GRID_COUNTRIES}', cast(1 + 2 * (pos % 8) as int), 2) as country",
    )


def weather_raw(embeddings: DataFrame) -> DataFrame:
    """Silver weather schema: timestamp (epoch ns), lat, lon, variable, value, country."""
    return weather_base(embeddings).selectExpr(
        "ts_ns as timestamp", "lat", "lon", "variable",
        """case when variable in ('u100', 'v100') then v * 16 when variable = 'ssrd' then abs(v) * 4194304
                else 283.15 + v * 16 end as value""",
        "country",
    )


def load_gen_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen_raw(read_table(spark, sf_dir, "events"))


def load_weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_raw(read_table(spark, sf_dir, "embeddings"))
