import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from gridmix.__main__ import main
from gridmix.plans.increments import published
from gridmix.sources import load_gen_raw


def test_cli_backfill_daily_query(spark, tmp_dir):
    raw_path = os.path.join(tmp_dir, "raw")
    load_gen_raw(spark, SF_SMALL).write.parquet(raw_path)
    silver, wh = os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "wh")
    args = ["--raw", raw_path, "--silver", silver, "--warehouse", wh, "--gate", "keys"]
    assert main(["backfill", *args, "--start", "2025-02-26", "--end", "2025-02-27"]) == 0
    assert main(["daily", *args, "--date", "2025-02-28"]) == 0
    assert main(["daily", *args, "--date", "2025-02-28"]) == 0  # idempotent re-run
    kpi = published(spark, wh, "fct_renewable_kpi")
    days = sorted(r[0].isoformat() for r in kpi.select("date_key").distinct().collect())
    assert days == ["2025-02-26", "2025-02-27", "2025-02-28"]
    assert kpi.groupBy("date_key", "country_code").count().where(F.col("count") > 1).count() == 0
    out = os.path.join(tmp_dir, "q")
    assert main(["query", "fct_renewable_kpi", "--sf", SF_SMALL, "--out", out]) == 0
    assert spark.read.parquet(out).count() > 0
