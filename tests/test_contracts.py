import csv
import os

import pytest

from gridmix import dims, sinks
from gridmix import functions as gf
from gridmix.sources import config


def test_csv_seeds(spark, tmp_dir):
    p = os.path.join(tmp_dir, "dim_energy_source.csv")
    with open(p, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["energy_source", "psr_code", "fuel_category", "is_renewable", "emission_factor_gco2_kwh"])
        for n, c, f, r, e in dims.ENERGY_SOURCES:
            w.writerow([n, c, f, str(r).lower(), int(e)])
    got = config.read_energy_source_seed(spark, p).collect()
    assert [tuple(r) for r in got] == [tuple(x) for x in dims.ENERGY_SOURCES]
    p = os.path.join(tmp_dir, "dim_country.csv")
    with open(p, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow([f.name for f in dims.COUNTRY_SCHEMA.fields])
        for row in dims.COUNTRIES:
            w.writerow([str(x).lower() if isinstance(x, bool) else x for x in row])
    got = config.read_country_seed(spark, p)
    assert got.where("`2030_renewable_target_pct` = 100").count() == 2


def test_partitioned_write_and_files(spark, tmp_dir):
    df = spark.createDataFrame([("GR", "Solar", 1.0), ("GR", "Nuclear", 2.0), ("DE", "Solar", 3.0)],
                               "country string, energy_source string, mw double")
    path = os.path.join(tmp_dir, "by_source")
    sinks.write_partitioned(df, path, ["country", "energy_source"])
    back = spark.read.parquet(path)
    assert back.count() == 3 and set(back.columns) == {"country", "energy_source", "mw"}
    assert all("country=" in f for f in sinks.written_files(back))
    one = os.path.join(tmp_dir, "one")
    sinks.write_single_file(df, one)
    assert len([f for f in os.listdir(one) if f.endswith(".parquet")]) == 1


def test_required_columns_and_filters(spark):
    df = spark.createDataFrame([("Greece", "2025-03-01"), ("Spain", "2026-01-02")], "country_name string, d string") \
        .selectExpr("country_name", "cast(d as date) as date_key")
    gf.require_columns(df, ["country_name"])
    with pytest.raises(gf.MissingColumnsError, match=r"\['lat', 'value'\]"):
        gf.require_columns(df, ["value", "lat", "country_name"])
    assert gf.report_filter(df, year=2025).count() == 1
    assert gf.report_filter(df, start="2025-03-02", countries=["Spain", "Italy"]).count() == 1
