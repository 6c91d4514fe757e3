import math

from pyspark.sql import functions as F

from gridmix import dims
from gridmix import functions as gf


def one(spark, expr, data=None, schema="x string"):
    df = spark.createDataFrame(data or [("a",)], schema)
    return df.select(expr.alias("r")).collect()[0]["r"]


def test_psr_and_country_names(spark):
    df = spark.createDataFrame([("B16",), ("B21",), ("B01",)], "p string")
    got = [r[0] for r in df.select(gf.psr_name("p")).collect()]
    assert got == ["Solar", "Unknown (B21)", "Biomass"]
    df = spark.createDataFrame([("GR",), ("UK",)], "c string")
    assert [r[0] for r in df.select(gf.country_name("c")).collect()] == ["Greece", "UK"]
    df = spark.createDataFrame([("B04",), ("B99",)], "p string")
    assert [r[0] for r in df.select(gf.psr_name_snake("p")).collect()] == ["fossil_gas", "unknown_B99"]


def test_renewable_lists_agree():
    # the KPI model's hard-coded list equals the seed's is_renewable flag
    assert sorted(dims.KPI_RENEWABLE_NAMES) == sorted(dims.RENEWABLE_SOURCES)
    assert len(dims.ENERGY_SOURCES) == 20 and len(dims.COUNTRIES) == 8


def test_resolution_and_point_time(spark):
    df = spark.createDataFrame([("PT15M",), ("PT30M",), ("PT60M",), (None,), ("P1D",)], "r string")
    assert [r[0] for r in df.select(gf.resolution_minutes("r")).collect()] == [15, 30, 60, 60, 60]
    t = one(spark, gf.point_time(gf.parse_xml_time(F.lit("2025-03-01T00:00Z")), F.lit(15), F.lit(3)))
    assert t.isoformat() == "2025-03-01T00:30:00"
    assert one(spark, gf.parse_xml_time(F.lit("2025-03-01T10:00:00Z"))).hour == 10
    assert one(spark, gf.parse_xml_time(F.lit("garbage"))) is None


def test_nan_and_epoch(spark):
    assert one(spark, gf.nan_to_null(F.lit(float("nan")))) is None
    assert one(spark, gf.nan_to_null(F.lit(1.5))) == 1.5
    ts = one(spark, gf.epoch_ns_to_ts(F.lit(1740787200123456789)))
    assert ts.isoformat() == "2025-03-01T00:00:00.123456"


def test_wind_helpers(spark):
    assert one(spark, gf.wind_speed(F.lit(3.0), F.lit(4.0))) == 5.0
    assert math.isclose(one(spark, gf.wind_direction_math(F.lit(0.0), F.lit(-1.0))), -90.0, abs_tol=1e-4)
    # compass variant folds into [0, 360): -90 -> 270 (Spark's % would keep the sign)
    assert math.isclose(one(spark, gf.wind_direction_compass(F.lit(0.0), F.lit(-1.0))), 270.0)
    assert one(spark, gf.kelvin_to_celsius(F.lit(300.0))) == 26.85
    assert one(spark, gf.radiation_wm2(F.lit(None).cast("double"))) == 0.0


def test_forecast_error_and_share(spark):
    assert one(spark, gf.forecast_error_ratio(F.lit(10.0), F.lit(0.0))) == 1000.0
    assert one(spark, gf.forecast_error_ratio(F.lit(10.0), F.lit(None).cast("double"))) is None
    assert one(spark, gf.safe_share_pct(F.lit(1.0), F.lit(None).cast("double"))) is None


def test_exact_avg_is_order_free(spark):
    df = spark.createDataFrame([(1.01,), (1.02,)], "x double")
    # 1.015 exactly -> half up -> 1.02 (a float mean could land on 1.0149999)
    assert df.agg(gf.exact_avg("x", 2, 2)).collect()[0][0] == 1.02
