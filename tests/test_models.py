from pyspark.sql import functions as F

from gridmix import dims
from gridmix import operators as ops
from helpers import HOUR, QUARTER, gen_rows


def test_quarter_hour_collapse_keeps_max(spark):
    raw = gen_rows(spark, [(i * QUARTER, "GR", "Solar", "B16", v, None, "generation")
                           for i, v in enumerate([10.0, 40.0, 20.0, 30.0])])
    rows = ops.stg_generation(raw).collect()
    assert len(rows) == 1 and rows[0]["actual_mw"] == 40.0 and rows[0]["hour_of_day"] == 0


def test_forecast_beside_actual_and_negative_actual(spark):
    raw = gen_rows(spark, [
        (0, "GR", "Solar", "B16", 12.0, None, "generation"),
        (0, "GR", "Solar", "B16", None, 9.0, "forecast"),
        (HOUR, "GR", "Solar", "B16", -1.0, 5.0, "generation"),
        (2 * HOUR, "GR", "Solar", "B16", float("nan"), None, "generation"),
        (3 * HOUR, "GR", "Solar", "B16", -2.0, None, "generation"),
    ])
    rows = {r["hour_of_day"]: r for r in ops.stg_generation(raw).collect()}
    assert rows[0]["actual_mw"] == 12.0 and rows[0]["forecast_mw"] is None and rows[0]["forecast_error_pct"] is None
    assert rows[1]["generation_mw"] == -1.0 and rows[1]["forecast_error_pct"] == 6.0 / 5.0
    assert 2 not in rows and 3 not in rows  # NaN -> NULL -> dropped; negative without forecast dropped


def test_dedup_is_idempotent(spark):
    raw = gen_rows(spark, [(i * QUARTER, "DE", "Fossil Gas", "B04", float(i), None, "generation") for i in range(8)])
    once = ops.stg_generation(raw)
    assert once.count() == 2


def test_all_null_country_day_gives_null_share(spark):
    raw = gen_rows(spark, [(0, "PL", "Fossil Hard coal", "B05", None, 100.0, "forecast")])
    kpi = ops.fct_renewable_kpi(ops.int_daily_generation(ops.stg_generation(raw))).collect()
    assert len(kpi) == 1 and kpi[0]["renewable_pct"] is None and kpi[0]["total_sources_active"] == 1


def test_daily_shares_and_kpi(spark):
    raw = gen_rows(spark, [
        (0, "DK", "Wind Onshore", "B19", 30.0, None, "generation"),
        (HOUR, "DK", "Wind Onshore", "B19", 10.0, None, "generation"),
        (0, "DK", "Fossil Gas", "B04", 60.0, None, "generation"),
    ])
    daily = {r["energy_source"]: r for r in ops.int_daily_generation(ops.stg_generation(raw)).collect()}
    assert daily["Wind Onshore"]["total_mwh"] == 40.0 and daily["Wind Onshore"]["hours_reported"] == 2
    assert daily["Fossil Gas"]["pct_of_total"] == 60.0 and daily["Fossil Gas"]["total_mwh_all_sources"] == 100.0
    kpi = ops.fct_renewable_kpi(ops.int_daily_generation(ops.stg_generation(raw))).collect()[0]
    assert kpi["renewable_pct"] == 40.0 and kpi["renewable_sources_active"] == 1 and kpi["total_sources_active"] == 2


def test_carbon_intensity_and_cleanest_hour_tie(spark):
    raw = gen_rows(spark, [
        (0, "FR", "Nuclear", "B14", 100.0, None, "generation"),        # 12 g
        (HOUR, "FR", "Nuclear", "B14", 100.0, None, "generation"),     # 12 g (tie -> earlier hour)
        (2 * HOUR, "FR", "Fossil Gas", "B04", 100.0, None, "generation"),  # 427 g
        (2 * HOUR, "FR", "Unknown (B21)", "B21", 100.0, None, "generation"),  # factor 0
    ])
    hourly = ops.int_carbon_intensity(ops.stg_generation(raw), dims.dim_energy_source(spark))
    by_hour = {r["hour_of_day"]: r for r in hourly.collect()}
    assert by_hour[2]["carbon_intensity_gco2_kwh"] == 213.5 and by_hour[2]["total_co2_grams_per_hour"] == 42700.0
    fct = ops.fct_grid_carbon_intensity(hourly).collect()[0]
    assert fct["cleanest_hour_of_day"] == 0 and fct["dirtiest_hour_of_day"] == 2
    assert fct["typical_cleanest_hour"] == 0 and fct["daily_intensity_range_gco2_kwh"] == 201.5
    assert fct["avg_carbon_intensity_gco2_kwh"] == 79.17  # (12 + 12 + 213.5) / 3 = 79.1666..


def test_zero_wind_efficiency_is_null(spark):
    from gridmix.plans.reports import weather_efficiency

    gw = spark.createDataFrame(
        [("Greece", "Wind Onshore", 10.0, 0.0, 1.0)],
        "country_name string, energy_source string, actual_mw double, avg_wind_speed double, avg_solar_radiation double")
    r = weather_efficiency(gw).collect()[0]
    assert r["mw_per_ms"] is None and r["avg_actual_mw"] == 10.0


def test_heatmap_wide_pivot(spark):
    from gridmix.plans.reports import carbon_heatmap_wide

    fct = spark.createDataFrame(
        [("Greece", "2025-02-27", 100.0, 10.0), ("Greece", "2025-03-01", 50.0, 20.0), ("Spain", "2025-03-02", 80.5, 5.0)],
        "country_name string, d string, avg_carbon_intensity_gco2_kwh double, avg_renewable_pct double",
    ).selectExpr("country_name", "cast(d as date) as date_key", "avg_carbon_intensity_gco2_kwh", "avg_renewable_pct")
    rows = {r["country_name"]: r for r in carbon_heatmap_wide(fct, ["2025-02", "2025-03"]).collect()}
    assert rows["Greece"]["2025-02"] == 100.0 and rows["Greece"]["2025-03"] == 50.0
    assert rows["Spain"]["2025-02"] is None and rows["Spain"]["2025-03"] == 80.5
