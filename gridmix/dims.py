"""Reference dimensions: energy sources, countries and the per-country configuration.

The values below are fixed values: they must equal the published seed tables and code lists
for results to match (energy-source names, PSR codes, emission factors, country names,
bidding-zone codes, bounding boxes, 2030 targets).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values — energy-source seed: (energy_source, psr_code, fuel_category, is_renewable,
# emission_factor_gco2_kwh).  PSR codes B01..B20 of the generation-per-type documents.
# ---------------------------------------------------------------------------------------------
ENERGY_SOURCES: list[tuple[str, str, str, bool, float]] = [
    ("Biomass", "B01", "Renewable", True, 230.0),
    ("Fossil Brown coal/Lignite", "B02", "Fossil", False, 1090.0),
    ("Fossil Coal-derived gas", "B03", "Fossil", False, 427.0),
    ("Fossil Gas", "B04", "Fossil", False, 427.0),
    ("Fossil Hard coal", "B05", "Fossil", False, 850.0),
    ("Fossil Oil", "B06", "Fossil", False, 730.0),
    ("Fossil Oil shale", "B07", "Fossil", False, 730.0),
    ("Fossil Peat", "B08", "Fossil", False, 1033.0),
    ("Geothermal", "B09", "Renewable", True, 38.0),
    ("Hydro Pumped Storage", "B10", "Renewable", True, 0.0),
    ("Hydro Run-of-river and poundage", "B11", "Renewable", True, 0.0),
    ("Hydro Water Reservoir", "B12", "Renewable", True, 0.0),
    ("Marine", "B13", "Renewable", True, 0.0),
    ("Nuclear", "B14", "Nuclear", False, 12.0),
    ("Other renewable", "B15", "Renewable", True, 0.0),
    ("Solar", "B16", "Renewable", True, 0.0),
    ("Waste", "B17", "Other", False, 230.0),
    ("Wind Offshore", "B18", "Renewable", True, 0.0),
    ("Wind Onshore", "B19", "Renewable", True, 0.0),
    ("Other", "B20", "Other", False, 0.0),
]

# Fixed values — country seed: (country_code, country_name, entsoe_code, region, grid_operator,
# installed_wind_mw, installed_solar_mw, eu_member, 2030_renewable_target_pct)
COUNTRIES: list[tuple[str, str, str, str, str, int, int, bool, int]] = [
    ("GR", "Greece", "GR", "Southern Europe", "ADMIE/IPTO", 5500, 6000, True, 35),
    ("DE", "Germany", "DE", "Central Europe", "50Hertz/Amprion/TransnetBW/TenneT", 60000, 70000, True, 80),
    ("FR", "France", "FR", "Western Europe", "RTE", 21000, 18000, True, 40),
    ("PL", "Poland", "PL", "Eastern Europe", "PSE", 10000, 3000, True, 23),
    ("ES", "Spain", "ES", "Southern Europe", "REE", 30000, 30000, True, 42),
    ("DK", "Denmark", "DK", "Northern Europe", "Energinet", 6500, 1500, True, 100),
    ("SE", "Sweden", "SE", "Northern Europe", "Svenska Kraftnät", 5000, 500, True, 100),
    ("IT", "Italy", "IT", "Southern Europe", "Terna", 11000, 25000, True, 35),
]

# Fixed values — country configuration: code -> (bidding-zone EIC code, area label,
# weather bounding box as [north, west, south, east]).
COUNTRY_CONFIG: dict[str, tuple[str, str, tuple[float, float, float, float]]] = {
    "DE": ("10Y1001A1001A83F", "generation", (55.1, 5.5, 47.0, 15.5)),
    "DK": ("10Y1001A1001A65H", "generation", (57.8, 7.5, 54.5, 15.5)),
    "ES": ("10YES-REE------0", "generation", (44.5, -10.0, 35.5, 4.5)),
    "FR": ("10YFR-RTE------C", "generation", (51.5, -5.5, 41.0, 9.8)),
    "GR": ("10YGR-HTSO-----Y", "generation", (41.5, 19.0, 34.5, 29.5)),
    "IT": ("10YIT-GRTN-----B", "generation", (47.5, 6.0, 36.0, 18.8)),
    "PL": ("10YPL-AREA-----S", "generation", (55.0, 14.0, 49.0, 24.5)),
    "SE": ("10YSE-1--------K", "generation", (69.5, 10.5, 55.0, 24.5)),
}

# Fixed values — default bounding box of the single-country grid helper (Greece):
# lat 34.5..41.5, lon 19.0..29.5, inclusive.
DEFAULT_BBOX = {"lat_min": 34.5, "lat_max": 41.5, "lon_min": 19.0, "lon_max": 29.5}

# Fixed values — renewable names of the KPI model (equal to is_renewable of the seed).
KPI_RENEWABLE_NAMES = [
    "Biomass",
    "Geothermal",
    "Hydro Pumped Storage",
    "Hydro Run-of-river and poundage",
    "Hydro Water Reservoir",
    "Marine",
    "Other renewable",
    "Solar",
    "Wind Offshore",
    "Wind Onshore",
]

# Fixed values — dashboard literals: the two-way fuel grouping (its 'Hydro Run-of-river'
# literal matches no seed name, as published) and the six-source comparison filter.
DASHBOARD_RENEWABLE_GROUP = ["Wind Onshore", "Wind Offshore", "Solar", "Hydro Water Reservoir", "Hydro Run-of-river"]
DASHBOARD_COMPARISON_SOURCES = ["Wind Onshore", "Wind Offshore", "Solar", "Fossil Hard coal", "Fossil Gas", "Nuclear"]
WIND_SOURCES = ["Wind Onshore", "Wind Offshore"]
WEATHER_EFFICIENCY_SOURCES = ["Wind Onshore", "Wind Offshore", "Solar"]

# Fixed values — weather variable names: wind components, solar/temperature/cloud variables.
WIND_VARIABLES = ["u100", "v100"]
SOLAR_VARIABLES = ["ssrd", "tcc", "t2m"]

# Fixed values — request categories of the weather archive and their variables.
WEATHER_CATEGORIES = {
    "wind": ["100m_u_component_of_wind", "100m_v_component_of_wind"],
    "solar": ["surface_solar_radiation_downwards"],
    "temp": ["2m_temperature"],
}

# Fixed values — long weather-archive variable names -> short names.
WEATHER_VAR_NAMES = {
    "100m_u-component_of_wind": "wind_100m_u",
    "100m_v-component_of_wind": "wind_100m_v",
    "10m_u-component_of_wind": "wind_10m_u",
    "10m_v-component_of_wind": "wind_10m_v",
    "2m_temperature": "t2m",
    "2m_dewpoint_temperature": "d2m",
    "surface_solar_radiation_downwards": "ssrd",
    "surface_thermal_radiation_downwards": "strd",
    "total_cloud_cover": "tcc",
    "total_precipitation": "tp",
}

# Fixed values — archive variable names -> the short names of silver, and dimension names -> silver's.
WEATHER_SHORT_NAMES = {
    "100m_u-component_of_wind": "u100",
    "100m_v-component_of_wind": "v100",
    "2m_temperature": "t2m",
    "2m_dewpoint_temperature": "d2m",
    "surface_solar_radiation_downwards": "ssrd",
    "surface_thermal_radiation_downwards": "strd",
    "total_cloud_cover": "tcc",
    "total_precipitation": "tp",
}
WEATHER_DIMENSION_NAMES = [("valid_time", "timestamp"), ("time", "timestamp"), ("latitude", "lat"), ("longitude", "lon")]

# Fixed values — legacy PSR code table (B10..B63 meanings of an older code list) and its
# renewable subset.  Never the default: B01..B20 take precedence.
LEGACY_PSR = {
    "B10": "Fossil Brown coal/Lignite", "B11": "Fossil Hard coal", "B12": "Fossil Oil shale",
    "B13": "Fossil Oil", "B14": "Fossil Natural gas", "B15": "Fossil Coal derived gas",
    "B16": "Fossil Lignite", "B17": "Fossil Peat", "B18": "Fossil Industrial waste",
    "B19": "Fossil Hydrogen", "B20": "Fossil Other", "B30": "Nuclear", "B31": "Solar",
    "B32": "Solar photovoltaic", "B33": "Solar concentrated", "B34": "Solar thermal",
    "B40": "Wind", "B41": "Wind onshore", "B42": "Wind offshore", "B43": "Tidal",
    "B44": "Marine", "B45": "Ocean", "B46": "Geothermal", "B47": "Biofuel", "B48": "Biomass",
    "B49": "Biogas", "B50": "Hydro Run-of-river and poundage", "B51": "Hydro Water Reservoir",
    "B52": "Hydro Pumped Storage", "B53": "Other renewable", "B54": "Other non-fossil fuels",
    "B60": "Other", "B61": "Waste", "B62": "Geothermal", "B63": "Other non-fossil fuels",
}
LEGACY_RENEWABLE_CODES = [
    "B31", "B32", "B33", "B34", "B40", "B41", "B42", "B43", "B44", "B45", "B46",
    "B47", "B48", "B49", "B50", "B51", "B52", "B53",
]

# ---------------------------------------------------------------------------------------------
# Derived lookups
# ---------------------------------------------------------------------------------------------
PSR_TO_SOURCE = {code: name for name, code, _, _, _ in ENERGY_SOURCES}
COUNTRY_NAME = {code: name for code, name, *_ in COUNTRIES}
RENEWABLE_SOURCES = [name for name, _, _, ren, _ in ENERGY_SOURCES if ren]

ENERGY_SOURCE_SCHEMA = T.StructType([
    T.StructField("energy_source", T.StringType(), False),
    T.StructField("psr_code", T.StringType(), False),
    T.StructField("fuel_category", T.StringType(), False),
    T.StructField("is_renewable", T.BooleanType(), False),
    T.StructField("emission_factor_gco2_kwh", T.DoubleType(), False),
])

COUNTRY_SCHEMA = T.StructType([
    T.StructField("country_code", T.StringType(), False),
    T.StructField("country_name", T.StringType(), False),
    T.StructField("entsoe_code", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("grid_operator", T.StringType(), False),
    T.StructField("installed_wind_mw", T.IntegerType(), False),
    T.StructField("installed_solar_mw", T.IntegerType(), False),
    T.StructField("eu_member", T.BooleanType(), False),
    T.StructField("2030_renewable_target_pct", T.IntegerType(), False),
])

COUNTRY_AREA_SCHEMA = T.StructType([
    T.StructField("country_code", T.StringType(), False),
    T.StructField("country_name", T.StringType(), False),
    T.StructField("entsoe_areas", T.ArrayType(T.StructType([
        T.StructField("code", T.StringType()), T.StructField("label", T.StringType())]))),
    T.StructField("era5_area", T.ArrayType(T.DoubleType())),
])


def dim_energy_source(spark: SparkSession) -> DataFrame:
    """The 20-row energy-source seed (size fixed by the code list, safe to broadcast)."""
    return spark.createDataFrame(ENERGY_SOURCES, ENERGY_SOURCE_SCHEMA)


def dim_country(spark: SparkSession) -> DataFrame:
    """The 8-row country seed."""
    return spark.createDataFrame(COUNTRIES, COUNTRY_SCHEMA)


def country_config(spark: SparkSession) -> DataFrame:
    """The country configuration as rows (same shape as the JSON reader in sources.config)."""
    rows = [
        (code, COUNTRY_NAME[code], [(eic, label)], list(box))
        for code, (eic, label, box) in sorted(COUNTRY_CONFIG.items())
    ]
    return spark.createDataFrame(rows, COUNTRY_AREA_SCHEMA)


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_literal(mapping: dict[str, str]) -> Column:
    """A literal MapType column built from a small fixed dict (one SQL expression)."""
    return F.expr("map(" + ", ".join(f"{_sql_str(k)}, {_sql_str(v)}" for k, v in sorted(mapping.items())) + ")")
