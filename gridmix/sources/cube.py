"""Gridded weather as cubes: (country, variable, time[], lat[], lon[], values[]) with values in
row-major (time, lat, lon) order — the shape a NetCDF variable has once decoded.

``flatten_cube`` turns cubes into long rows with ``posexplode`` and index arithmetic (no
per-cell Python); ``wide``/``melt`` convert between one-column-per-variable and long form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix import functions as gf

CUBE_DDL = ("country string, variable string, time array<timestamp>, lat array<double>, "
            "lon array<double>, `values` array<double>")


#: Hours that one cube covers (a quarter-degree world grid has a million cells an hour).
CUBE_HOURS = 1


def build_cubes(weather_raw: DataFrame) -> DataFrame:
    """Long silver weather -> one cube per (country, variable, hours of ``CUBE_HOURS``).  Repeated cells are
    collapsed first (max value, partially aggregated map-side), so a cube holds at most
    CUBE_HOURS x lat x lon values — bounded by the grid, never by how often a cell repeats."""
    cells = weather_raw.select(
        "country", "variable", gf.epoch_ns_to_ts("timestamp").alias("t"), "lat", "lon", "value") \
        .groupBy("country", "variable", "t", "lat", "lon").agg(F.max("value").alias("value"))
    grouped = cells.groupBy("country", "variable", F.floor(F.unix_timestamp("t") / (3600 * CUBE_HOURS)).alias("slot")).agg(
        F.array_sort(F.collect_set("t")).alias("time"),
        F.array_sort(F.collect_set("lat")).alias("lat"),
        F.array_sort(F.collect_set("lon")).alias("lon"),
        F.array_sort(F.collect_list(F.struct("t", "lat", "lon", "value"))).alias("cells"),
    )
    # place every cell at its row-major index; cells missing from the grid stay NULL
    nlat, nlon = F.size("lat"), F.size("lon")

    def index(c):
        return ((F.array_position("time", c["t"]) - 1) * nlat * nlon
                + (F.array_position("lat", c["lat"]) - 1) * nlon
                + (F.array_position("lon", c["lon"]) - 1)).cast("int")

    n = F.size("time") * nlat * nlon
    # complete grid: the (t, lat, lon)-sorted cells already are row-major, O(n)
    dense = F.transform("cells", lambda c: c["value"])
    # incomplete grid: scatter by index (rare path)
    keyed = F.map_from_entries(F.transform("cells", lambda c: F.struct(index(c), c["value"])))
    sparse = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.try_element_at(keyed, i))
    values = F.when(F.size("cells") == n, dense).otherwise(sparse)
    return grouped.select("country", "variable", "time", "lat", "lon", values.alias("values"))


def flatten_cube(cubes: DataFrame) -> DataFrame:
    """Cubes -> (timestamp, lat, lon, variable, value, country); missing values dropped."""
    nlat, nlon = F.size("lat"), F.size("lon")
    ex = cubes.select("country", "variable", "time", "lat", "lon", F.posexplode("values").alias("i", "value"))
    i = F.col("i")
    t_idx = F.floor(i / (nlat * nlon)).cast("int")
    la_idx = (F.floor(i / nlon) % nlat).cast("int")
    lo_idx = (i % nlon).cast("int")
    return ex.where(F.col("value").isNotNull()).select(
        F.element_at("time", t_idx + 1).alias("timestamp"), F.element_at("lat", la_idx + 1).alias("lat"),
        F.element_at("lon", lo_idx + 1).alias("lon"), "variable", "value", "country")


def wide(long: DataFrame, variables: list[str]) -> DataFrame:
    """Long weather rows -> one column per variable (explicit pivot list), with the unit
    conversions of the dataset helper: temperatures K -> deg C, precipitation m -> mm,
    cloud cover fraction -> %."""
    piv = long.groupBy("timestamp", "lat", "lon", "country").pivot("variable", variables).agg(F.first("value"))
    conv = {}
    for v in variables:
        c = F.col(v)
        if v in ("t2m", "d2m"):
            conv[v] = gf.kelvin_to_celsius(c, digits=None)
        elif v == "tp":
            conv[v] = gf.metres_to_mm(c)
        elif v == "tcc":
            conv[v] = gf.fraction_to_pct(c)
    return piv.withColumns(conv) if conv else piv


def melt(wide_df: DataFrame, ids: list[str] | None = None) -> DataFrame:
    """Wide -> long (variable, value) with NULL values dropped."""
    ids = ids or [c for c in ("timestamp", "lat", "lon", "country") if c in wide_df.columns]
    values = [c for c in wide_df.columns if c not in ids]
    return wide_df.unpivot(ids, values, "variable", "value").where(F.col("value").isNotNull())


def bbox_filter(df: DataFrame, box: dict) -> DataFrame:
    """Inclusive latitude / longitude box."""
    return df.where(F.col("lat").between(box["lat_min"], box["lat_max"])
                    & F.col("lon").between(box["lon_min"], box["lon_max"]))


def mean_numeric_per_time(df: DataFrame, time_col: str = "timestamp", scale: int = 6) -> DataFrame:
    """Mean of every numeric column per time step (coordinates included, as the helper does)."""
    numeric = [f.name for f in df.schema.fields
               if f.name != time_col and f.dataType.typeName() in ("double", "float", "integer", "long", "decimal")]
    return df.groupBy(time_col).agg(*[gf.exact_avg(c, scale, scale).alias(c) for c in numeric])


def grid_to_country(cells: DataFrame, boxes: DataFrame) -> DataFrame:
    """Assign grid points to every country whose box contains them (boxes overlap, so a point
    may get several countries).  ``boxes`` is the configuration (one row per country, size
    fixed by the config), broadcast into a nested-loop range join."""
    b = F.broadcast(boxes.select(
        "country_code", F.col("era5_area")[0].alias("north"), F.col("era5_area")[1].alias("west"),
        F.col("era5_area")[2].alias("south"), F.col("era5_area")[3].alias("east")))
    cond = (F.col("lat").between(F.col("south"), F.col("north"))
            & F.col("lon").between(F.col("west"), F.col("east")))
    return cells.join(b, cond, "inner").drop("north", "west", "south", "east")


#: Degrees of a tile's side.
TILE = 1.0


def grid_to_country_tiles(cells: DataFrame, boxes: DataFrame, tile: float = TILE) -> DataFrame:
    """``grid_to_country`` as an equi-join: boxes are cut into the tiles that they touch, cells meet the boxes of their tile,
    and the exact test follows.  A cell meets few boxes however many there are, and neither side is broadcast by hand.

    Cells may carry any columns; a cell outside all boxes, or without coordinates, comes out for none."""
    def of(degrees) -> Column:
        return F.floor(degrees / F.lit(tile))

    b = boxes.select("country_code", F.col("era5_area")[0].alias("north"), F.col("era5_area")[1].alias("west"),
                     F.col("era5_area")[2].alias("south"), F.col("era5_area")[3].alias("east"))
    b = b.withColumn("tile_y", F.explode(F.sequence(of(F.col("south")), of(F.col("north")))))
    b = b.withColumn("tile_x", F.explode(F.sequence(of(F.col("west")), of(F.col("east")))))
    at = cells.withColumns({"tile_y": of(F.col("lat")), "tile_x": of(F.col("lon"))})
    inside = F.col("lat").between(F.col("south"), F.col("north")) & F.col("lon").between(F.col("west"), F.col("east"))
    return at.join(b, ["tile_y", "tile_x"]).where(inside).drop("tile_y", "tile_x", "north", "west", "south", "east")
