"""Inputs: silver tables, derived fixtures, XML documents, weather cubes, seeds, config, files."""

from gridmix.sources.tables import read_table, read_silver_generation  # noqa: F401
from gridmix.sources.fixtures import gen_base, gen_raw, weather_raw, load_gen_raw, load_weather_raw  # noqa: F401
