"""Column helpers — all JVM-side built-ins, no Python UDF.

Each helper takes and returns ``Column`` so it composes inside ``select``/``withColumn`` and
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmix import dims

__all__ = [
    "col_of", "psr_name", "psr_name_snake", "legacy_psr_name", "country_name", "is_renewable_name",
    "is_legacy_renewable_code", "nan_to_null", "epoch_ns_to_ts", "resolution_minutes",
    "point_time", "parse_xml_time", "unified_generation", "forecast_error_ratio",
    "wind_speed", "wind_direction_math", "wind_direction_compass", "kelvin_to_celsius",
    "radiation_wm2", "metres_to_mm", "fraction_to_pct", "to_gwh", "fuel_group",
    "exact_avg", "safe_share_pct", "in_list", "require_columns", "report_filter", "MissingColumnsError",
]


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- code -> name maps (C1, C3, C17) -----------------------------------------------------------

def psr_name(psr: Column | str) -> Column:
    """PSR code -> energy-source name; unknown code ``X`` -> ``Unknown (X)``."""
    p = col_of(psr)
    return F.coalesce(F.try_element_at(dims.map_literal(dims.PSR_TO_SOURCE), p),
                      F.concat(F.lit("Unknown ("), p, F.lit(")")))


def psr_name_snake(psr: Column | str) -> Column:
    """Snake-case variant used by the local partitioned writer: ``fossil_gas``, ``unknown_X``."""
    p = col_of(psr)
    snake = {k: v.lower().replace("/", "_").replace("-", "_").replace(" ", "_")
             for k, v in dims.PSR_TO_SOURCE.items()}
    return F.coalesce(F.try_element_at(dims.map_literal(snake), p), F.concat(F.lit("unknown_"), p))


def legacy_psr_name(psr: Column | str) -> Column:
    """Legacy B10..B63 code table (optional second map, never the default)."""
    p = col_of(psr)
    return F.coalesce(F.try_element_at(dims.map_literal(dims.LEGACY_PSR), p),
                      F.concat(F.lit("Unknown ("), p, F.lit(")")))


def is_legacy_renewable_code(psr: Column | str) -> Column:
    return F.coalesce(col_of(psr).isin(dims.LEGACY_RENEWABLE_CODES), F.lit(False))


def country_name(code: Column | str) -> Column:
    """Country code -> name; unknown codes fall back to the code itself."""
    c = col_of(code)
    return F.coalesce(F.try_element_at(dims.map_literal(dims.COUNTRY_NAME), c), c)


def is_renewable_name(source: Column | str) -> Column:
    """Renewable flag by energy-source name (NULL name -> False)."""
    if isinstance(source, str):
        return F.coalesce(in_list(source, dims.RENEWABLE_SOURCES), F.lit(False))
    return F.coalesce(source.isin(dims.RENEWABLE_SOURCES), F.lit(False))


def fuel_group(source: Column | str) -> Column:
    """Dashboard two-way grouping: 'Renewable' vs 'Fossil/Nuclear' by its literal list."""
    return F.when(col_of(source).isin(dims.DASHBOARD_RENEWABLE_GROUP), F.lit("Renewable")) \
        .otherwise(F.lit("Fossil/Nuclear"))


# --- value coercion and time (C5, C10, C25, C26, S16) ------------------------------------------

def nan_to_null(x: Column | str) -> Column:
    """NaN compares >= 0 as TRUE in Spark; map it to NULL before any predicate."""
    c = col_of(x).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def epoch_ns_to_ts(ns: Column | str) -> Column:
    """Epoch nanoseconds (INT64) -> TIMESTAMP, truncating toward zero to microseconds.

    Uses SQL's integral ``div`` (exact on INT64; a double division is not above 2**53)."""
    if isinstance(ns, str):
        return F.expr(f"timestamp_micros(`{ns}` div 1000)")
    return F.timestamp_micros((ns.cast("decimal(20,0)") / F.lit(1000)).cast("long"))


def in_list(name: str, values: list[str]) -> Column:
    """``name IN (...)`` as one SQL expression (one round trip instead of one per literal)."""
    quoted = ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)
    return F.expr(f"`{name}` IN ({quoted})")


def resolution_minutes(res: Column | str) -> Column:
    """ISO-8601 resolution -> step minutes: '15M' -> 15, '30M' -> 30, else (and missing) 60."""
    r = F.coalesce(col_of(res), F.lit("PT60M"))
    return F.when(r.contains("15M"), 15).when(r.contains("30M"), 30).otherwise(60)


def parse_xml_time(s: Column | str) -> Column:
    """Document timestamps such as ``2025-03-01T00:00Z``: with or without seconds, ``Z``, a numeric offset
    (``+01:00``, ``+0100``) or none (UTC)."""
    c = F.trim(col_of(s))
    forms = ["yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
             "yyyy-MM-dd'T'HH:mmXX", "yyyy-MM-dd'T'HH:mm:ssXX", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss"]
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in forms])


def point_time(start: Column, step_minutes: Column, position: Column) -> Column:
    """Absolute time of a series point: start + step * (position - 1)."""
    return F.timestamp_add("MINUTE", step_minutes * (position - F.lit(1)), start)


# --- generation metrics (C13, C14) -----------------------------------------------------------

def unified_generation(actual: Column | str, forecast: Column | str) -> Column:
    return F.coalesce(col_of(actual), col_of(forecast))


def forecast_error_ratio(actual: Column | str, forecast: Column | str) -> Column:
    """|a - f| / max(f, 0.01) when both are present, else NULL (a ratio, named *_pct)."""
    a, f = col_of(actual), col_of(forecast)
    return F.when(a.isNotNull() & f.isNotNull(), F.abs(a - f) / F.greatest(f, F.lit(0.01)))


def safe_share_pct(part: Column, total: Column, digits: int = 2) -> Column:
    """round(part * 100 / max(total, 0.001)); NULL when the total is NULL (GREATEST of NULL)."""
    return F.when(total.isNotNull(), F.round(part * F.lit(100.0) / F.greatest(total, F.lit(0.001)), digits))


def exact_avg(x: Column | str, scale: int = 2, digits: int | None = None) -> Column:
    """Average of values carrying ``scale`` decimals, exact and rounded half away from zero to
    ``digits`` decimals (default ``scale + 4``).

    A float sum depends on the order rows reach each partial aggregate, so a plain ``avg`` can
    differ in the last bits from run to run.  Here each value becomes an integer number of
    10^-scale units and the units are summed as two LONGs (exact, and primitive hash-aggregate
    buffers — about twice as fast as a decimal sum).  The one division per group is done in
    integers: half-up(a / b) = (2|a| + b) div 2b, with the sign of a reapplied.
    """
    c = col_of(x)
    digits = scale + 4 if digits is None else digits
    each = F.round(c * F.lit(10.0 ** scale)).cast("long")
    # two LONG sums (units = high * 2**31 + low) stay in range where one would overflow
    high, low = F.sum(F.shiftright(each, 31)), F.sum(each.bitwiseAND(F.lit(2 ** 31 - 1)))
    units = high.cast("decimal(38,0)") * F.lit(2 ** 31).cast("decimal(12,0)") + low
    n = F.count(c)
    a = (units * F.lit(10 ** max(0, digits - scale)).cast("decimal(12,0)")).cast("decimal(38,0)")
    b = (n * F.lit(10 ** max(0, scale - digits))).cast("decimal(38,0)")
    num, den = (F.abs(a) * 2 + b).cast("decimal(38,0)"), (b * 2).cast("decimal(38,0)")
    q = ((num - num % den) / den).cast("long") * F.signum(a).cast("long")
    return F.when(n > 0, q.cast("double") / F.lit(10.0 ** digits))


# --- weather (C12, C15) --------------------------------------------------------------------

def wind_speed(u: Column | str, v: Column | str) -> Column:
    uu, vv = col_of(u), col_of(v)
    return F.sqrt(uu * uu + vv * vv)


def wind_direction_math(u: Column | str, v: Column | str, digits: int | None = None) -> Column:
    """Mathematical angle in degrees, range (-180, 180] (pi as the staging model states it), raw unless ``digits``."""
    d = F.atan2(col_of(v), col_of(u)) * F.lit(180.0) / F.lit(3.14159265)
    return F.round(d, digits) if digits is not None else d


def wind_direction_compass(u: Column | str, v: Column | str) -> Column:
    """Same angle folded into [0, 360) with a positive modulus."""
    return F.pmod(F.degrees(F.atan2(col_of(v), col_of(u))), F.lit(360.0))


def kelvin_to_celsius(k: Column | str, digits: int | None = 2) -> Column:
    c = col_of(k) - F.lit(273.15)
    return F.round(c, digits) if digits is not None else c


def radiation_wm2(jm2: Column | str) -> Column:
    """Hourly accumulated J/m2 -> mean W/m2, rounded to 2, missing -> 0."""
    return F.round(F.coalesce(col_of(jm2) / F.lit(3600.0), F.lit(0.0)), 2)


def metres_to_mm(m: Column | str) -> Column:
    return col_of(m) * F.lit(1000.0)


def fraction_to_pct(f: Column | str) -> Column:
    return col_of(f) * F.lit(100.0)


def to_gwh(mwh: Column | str, digits: int = 1) -> Column:
    return F.round(col_of(mwh) / F.lit(1000.0), digits)


# --- contracts and report filters (C11, C23) ---------------------------------------------------

class MissingColumnsError(ValueError):
    pass


def require_columns(df, required) -> None:
    """Fail with the sorted list of required columns the frame lacks."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}")


def report_filter(df, year: int | None = None, start=None, end=None, countries: list[str] | None = None,
                  date_col: str = "date_key", country_col: str = "country_name"):
    """Dashboard controls: year, inclusive date range, country multi-select."""
    out = df
    if year is not None:
        out = out.where(F.year(date_col) == F.lit(year))
    if start is not None:
        out = out.where(F.col(date_col) >= F.lit(start).cast("date"))
    if end is not None:
        out = out.where(F.col(date_col) <= F.lit(end).cast("date"))
    if countries:
        out = out.where(F.col(country_col).isin(list(countries)))
    return out
