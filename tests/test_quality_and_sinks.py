import os

import pytest

from gridmix import dims, sinks
from gridmix import operators as ops
from gridmix.operators import quality as dq
from gridmix.plans import increments as pipeline
from helpers import HOUR, gen_rows


def _raw(spark):
    return gen_rows(spark, [
        (0, "GR", "Solar", "B16", 10.0, None, "generation"),
        (HOUR, "GR", "Solar", "B16", -1.0, 3.0, "generation"),
        (24 * HOUR, "XX", "Fossil Gas", "B04", 5.0, None, "generation"),
    ])


def test_checks_fire(spark):
    stg = ops.stg_generation(_raw(spark))
    assert dq.negative_mw(stg).count() == 1
    assert dq.row_coverage(stg).count() == 2
    kpi = ops.fct_renewable_kpi(ops.int_daily_generation(stg))
    assert [r[0] for r in dq.country_code_valid(kpi, dims.dim_country(spark)).collect()] == ["XX"]
    assert dq.accepted_range(stg, "actual_mw", 0).count() == 1
    assert dq.unique_combination(stg, ["country_code", "ts_hour", "energy_source"]).count() == 0
    rec = dq.recency(kpi, "date_key", "day", 2, as_of=kpi.select("date_key").agg({"date_key": "max"}).scalar(),
                     ignore_time_component=True).collect()[0]
    assert rec["is_stale"] is False


def test_gate(spark):
    stg = ops.stg_generation(_raw(spark))
    checks = [dq.Check("mw_positive", "stg", dq.negative_mw(stg)),
              dq.Check("cov", "stg", dq.row_coverage(stg), severity="warn")]
    with pytest.raises(dq.QualityGateError):
        dq.gate(dq.summary(checks))
    dq.gate(dq.summary(checks[1:]))  # warn-only: passes


def test_silver_write_is_idempotent(spark, tmp_dir):
    raw = _raw(spark)
    path = os.path.join(tmp_dir, "silver")
    pipeline.ingest(raw, path)
    pipeline.ingest(raw, path, "2025-03-01", "2025-03-01")  # re-run one day
    back = sinks.read_silver_generation(spark, path)
    assert back.count() == 3
    assert sorted(p for p in os.listdir(path) if p.startswith("country=")) == ["country=GR", "country=XX"]
    assert pipeline.build(spark, path).kpi.count() == 2
    one = pipeline.build(spark, path, None, "2025-03-02", "2025-03-02")  # one day's run holds one day
    assert [r.country_code for r in one.kpi.collect()] == ["XX"]


def test_append_missing_and_table(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    path = os.path.join(tmp_dir, "t")
    assert sinks.append_missing(spark, df, path, ["k"]).count() == 2
    sinks.append_missing(spark, df, path, ["k"])
    assert spark.read.parquet(path).count() == 2
    sinks.save_table(spark, df, "gm_test_table", os.path.join(tmp_dir, "tbl"))
    assert spark.sql("select count(*) from gm_test_table").collect()[0][0] == 2
    assert sinks.write_repartitioned(df, os.path.join(tmp_dir, "r"), 2) == 2


def test_append_missing_raises_on_other_errors(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    path = os.path.join(tmp_dir, "t")
    sinks.append_missing(spark, df, path, ["k"])
    with pytest.raises(Exception, match="other"):
        sinks.append_missing(spark, df.withColumnRenamed("k", "other"), path, ["other"])
    assert spark.read.parquet(path).count() == 1


def test_publish_gate_blocks_by_default(spark, tmp_dir):
    raw = _raw(spark)
    silver, wh = os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "w")
    pipeline.ingest(raw, silver)
    with pytest.raises(dq.QualityGateError, match="mw_positive"):
        pipeline.publish_marts(spark, silver, wh)
    assert pipeline.published(spark, wh, "fct_renewable_kpi").count() == 0  # nothing published
    pipeline.publish_marts(spark, silver, wh, gate_checks=pipeline.key_integrity_checks)
    before = sorted(pipeline.published(spark, wh, "fct_renewable_kpi").collect())
    assert len(before) == 2
    pipeline.ingest(raw.withColumn("actual_MW", -raw["actual_MW"]), silver)
    with pytest.raises(dq.QualityGateError):  # a failing mart test leaves the old tables
        pipeline.publish_marts(spark, silver, wh)
    assert sorted(pipeline.published(spark, wh, "fct_renewable_kpi").collect()) == before
    assert pipeline.carbon_mart(spark, wh).count() == 2


def test_silver_files_are_few_and_large_partitions_are_split(spark, tmp_dir):
    rows = spark.range(0, 40_000, 1, 16).selectExpr(
        "1740787200000000000 + (id % 24) * 3600000000000 as timestamp", "'DE' as country", "'Solar' as energy_source",
        "'B16' as psr_type", "cast(id as double) as actual_MW", "cast(null as double) as forecast_MW", "'generation' as domain")
    path = os.path.join(tmp_dir, "s")
    sinks.write_silver_generation(rows, path)
    assert len(spark.read.parquet(path).inputFiles()) == 1  # 16 tasks, one slice
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        sinks.write_silver_generation(rows, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(spark.read.parquet(path).inputFiles()) > 1  # the hot slice is written by several tasks
    assert sinks.read_silver_generation(spark, path).count() == 40_000


def test_runs_prune_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "s")
    pipeline.ingest(_raw(spark), path)
    df = pipeline.within(sinks.read_silver_generation(spark, path), sinks.F.col("date"), "2025-03-02", "2025-03-02", ["XX"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date" in filters and "country" in filters


def test_checkpoint_folder_is_required_off_local(monkeypatch):
    from gridmix import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Connect:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("no context")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Connect())


def test_silver_folders_grow_with_months(spark, tmp_dir):
    """A folder a country and month, not a day; a re-run of one day's slice keeps the month's others, and rows without a time."""
    rows = spark.range(60 * 4).selectExpr(
        "1740787200000000000 + (id div 4) * 86400000000000 as timestamp", "if(id % 2 = 0, 'GR', 'FR') as country", "'Solar' as energy_source",
        "'B16' as psr_type", "1.0D as actual_MW", "2.0D as forecast_MW", "if(id % 4 < 2, 'generation', 'forecast') as domain")
    undated = rows.limit(1).selectExpr("cast(null as bigint) as timestamp", "* except (timestamp)")
    path = os.path.join(tmp_dir, "s")
    pipeline.ingest(rows.union(undated), path)
    assert sorted(os.listdir(os.path.join(path, "country=FR"))) == ["date_month=2025-03-01", "date_month=2025-04-01"]
    again = rows.where("country = 'GR' and domain = 'generation'").selectExpr("* except (actual_MW)", "5.0D as actual_MW").select(rows.columns)
    pipeline.ingest(again, path, "2025-03-02", "2025-03-02")
    back = sinks.read_silver_generation(spark, path)
    assert back.count() == 241 and back.where("date is null").count() == 1
    assert [tuple(map(str, r)) for r in back.where("actual_MW = 5").select("country", "date", "domain").collect()] == [("GR", "2025-03-02", "generation")]


def test_silver_with_folders_by_day_is_refused(spark, tmp_dir):
    path = os.path.join(tmp_dir, "s")
    sinks.with_date_partition(_raw(spark)).write.partitionBy("country", "date", "domain").parquet(path)
    with pytest.raises(ValueError, match="folders by day"):
        sinks.read_silver_generation(spark, path)
