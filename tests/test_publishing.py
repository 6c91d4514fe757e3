import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from gridmix.__main__ import main
from gridmix.operators import quality as dq
from gridmix.operators import work_grid
from gridmix.plans import catalog
from gridmix.plans import increments as inc
from gridmix.sinks.versions import Store, new_run
from gridmix.sources import xml as bx
from helpers import HOUR, gen_rows

catalog.load_all()
DAY = 24 * HOUR


def raw_rows(spark, factor=1.0):
    return gen_rows(spark, [(d * DAY + h * HOUR, c, "Solar", "B16", factor * (10.0 + h), None, "generation")
                            for d in range(2) for h in range(20) for c in ("FR", "GR")]
                    + [(HOUR, None, "Solar", "B16", 5.0, None, "generation")])


def slices(df, *more):
    return sorted((str(r.date_key), str(r.country_code), *(r[c] for c in more)) for r in df.collect())


def test_one_country_through_the_command_line(spark, tmp_dir):
    raw, half = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "half")
    raw_rows(spark).write.parquet(raw)
    raw_rows(spark, 0.5).write.parquet(half)
    place = ["--silver", os.path.join(tmp_dir, "s"), "--warehouse", os.path.join(tmp_dir, "w"), "--gate", "keys"]
    wh = place[3]
    assert main(["backfill", "--raw", raw, *place, "--start", "2025-03-01", "--end", "2025-03-02"]) == 0
    before = {n: slices(inc.published(spark, wh, n)) for n in inc.TABLES if n != "int_generation_weather"}
    assert len(before["fct_renewable_kpi"]) == 5  # a null country is a slice too
    assert main(["daily", "--raw", half, *place, "--date", "2025-03-02", "--countries", "FR"]) == 0
    assert {n: slices(inc.published(spark, wh, n)) for n in before} == before
    kpi = {k[:2]: k[2] for k in slices(inc.published(spark, wh, "fct_renewable_kpi"), "total_mwh")}
    assert kpi["2025-03-02", "FR"] * 2 == kpi["2025-03-01", "FR"] == kpi["2025-03-02", "GR"]
    one = inc.published(spark, wh, "fct_renewable_kpi", "2025-03-02", "2025-03-02", ["GR"])
    assert slices(one) == [("2025-03-02", "GR")]
    versions = Store(spark, wh).version()
    assert main(["vacuum", "--warehouse", wh]) == 0
    assert {n: slices(inc.published(spark, wh, n)) for n in before} == before and Store(spark, wh).version() == versions + 1
    assert Store(spark, wh).vacuum() == 0


def test_an_unfinished_run_is_not_seen(spark, tmp_dir):
    """A run that stops between two tables leaves readers the version before, of all tables."""
    silver, wh = os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "w")
    inc.ingest(raw_rows(spark), silver)
    inc.publish_marts(spark, silver, wh, gate_checks=inc.key_integrity_checks)
    store = Store(spark, wh)
    before = {n: sorted(map(str, store.read(n).collect())) for n in ("int_daily_generation", "fct_renewable_kpi")}
    inc.ingest(raw_rows(spark, 3.0), silver)

    class Stops(Store):
        def write(self, table, run, df):
            if table == "fct_renewable_kpi":
                raise RuntimeError("lost")
            return super().write(table, run, df)

    with pytest.raises(RuntimeError, match="lost"):
        inc.build(spark, silver, store=Stops(spark, wh), run=new_run())
    assert {n: sorted(map(str, store.read(n).collect())) for n in before} == before
    inc.publish_marts(spark, silver, wh, gate_checks=inc.key_integrity_checks)
    assert sorted(map(str, store.read("fct_renewable_kpi").collect())) != before["fct_renewable_kpi"]
    assert sorted(map(str, store.read("fct_renewable_kpi", version=1).collect())) == before["fct_renewable_kpi"]


def test_failing_slices_are_held_until_they_are_right(spark, tmp_dir):
    silver, wh = os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "w")
    rows = raw_rows(spark).where("country is not null")
    bad = rows.selectExpr("timestamp", "country", "energy_source", "psr_type", "if(country = 'GR' and timestamp % 7 = 0, -actual_MW, actual_MW)"
                          " as actual_MW", "1.0D as forecast_MW", "domain")
    inc.ingest(bad, silver)
    with pytest.raises(dq.QualityGateError, match="mw_positive"):
        inc.publish_marts(spark, silver, wh)
    assert Store(spark, wh).version() == 0
    inc.publish_marts(spark, silver, wh, on_failure="hold")
    held = Store(spark, wh).read(inc.HELD)
    assert {r.country_code for r in held.collect()} == {"GR"} and "mw_positive" in {r.check for r in held.collect()}
    assert slices(inc.published(spark, wh, "fct_renewable_kpi")) == [("2025-03-01", "FR"), ("2025-03-02", "FR")]
    inc.ingest(rows, silver)
    inc.publish_marts(spark, silver, wh, on_failure="hold")
    assert Store(spark, wh).read(inc.HELD).count() == 0
    assert len(slices(inc.published(spark, wh, "fct_renewable_kpi"))) == 4


def test_a_slice_that_lost_its_rows_goes(spark, tmp_dir):
    silver, wh = os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "w")
    inc.ingest(raw_rows(spark), silver)
    inc.publish_marts(spark, silver, wh, gate_checks=inc.key_integrity_checks)
    inc.ingest(raw_rows(spark).where("country = 'GR'").selectExpr(
        "timestamp", "country", "energy_source", "psr_type", "-1.0D as actual_MW", "forecast_MW", "domain"), silver, "2025-03-02", "2025-03-02")  # staging drops them all
    inc.publish_marts(spark, silver, wh, "2025-03-02", "2025-03-02", gate_checks=inc.key_integrity_checks)
    assert ("2025-03-02", "GR") not in slices(inc.published(spark, wh, "fct_renewable_kpi"))
    days = {r.country_code: r.days for r in Store(spark, wh).read(inc.COUNTS).groupBy("country_code").sum("days").toDF(
        "country_code", "days").collect()}
    assert days["GR"] == 1 and days["FR"] == 2


def test_rejects_follow_their_documents(spark, tmp_dir):
    at = inc.Layout(tmp_dir)
    docs = bx.generation_documents(raw_rows(spark).where("country is not null").coalesce(1))
    cut = docs.selectExpr("country", "date", "if(date = date'2025-03-01', substring(xml, 1, 200), xml) as xml")
    bx.land_documents(cut, at.documents, "generation")
    assert sorted((r.country, r.reason) for r in inc.bronze_to_silver(spark, at).collect()) == [("FR", "corrupt"), ("GR", "corrupt")]
    fixed = docs.where("country = 'FR' and date = date'2025-03-01'").selectExpr("xml as value", "country", "date", "'generation' as domain")
    (fixed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("country", "date", "domain")
     .text(at.documents))
    left = inc.bronze_to_silver(spark, at, "2025-03-01", "2025-03-01", ["FR"])  # returns that range's
    assert left.count() == 0
    assert [r.country for r in inc.rejected(spark, at).collect()] == ["GR"]  # the other country's stays


def test_documents_are_read_and_decoded_once(spark, tmp_dir):
    bx.land_documents(bx.generation_documents(raw_rows(spark)), tmp_dir, "generation")
    plan = bx.read_through(bx.read_documents(spark, tmp_dir))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Join" not in plan and plan.count("from_xml(") == 1


def test_row_tests_cost_no_scan(spark):
    """Counted in the write: what is left for the summary are checks on keys and groups."""
    seen = dq.Observed()
    df = spark.range(100)
    checks = [dq.row_check("odd", "m", df, df["id"] % 2 == 1), dq.row_check("none", "m", df, df["id"] < 0)]
    out = seen.watch(df, checks)
    out.write.format("noop").mode("overwrite").save()
    assert seen.counts() == [("odd", "m", "error", 50), ("none", "m", "error", 0)]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_colocated_join_has_no_exchange(spark):
    plan = executed(catalog.QUERIES["colocated_weather"](spark, SF_SMALL))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_tiles_need_no_nested_loop(spark):
    plan = executed(catalog.QUERIES["grid_to_country_tiles"](spark, SF_SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_work_grid_edges(spark):
    def lit(day):
        return F.lit(dt.date.fromisoformat(day))

    keys = spark.createDataFrame([("GR", "wind")], "country string, category string")
    want = work_grid.wanted_days(keys, lit("2025-01-30"), lit("2025-02-03"))
    assert [r.date for r in want.orderBy("date").collect()] == [dt.date(2025, 1, 30), dt.date(2025, 1, 31), dt.date(2025, 2, 1), dt.date(2025, 2, 2)]
    assert work_grid.wanted_days(keys, lit("2025-02-03"), lit("2025-02-03")).count() == 0
    files = spark.createDataFrame([("GR", "wind", dt.date(2025, 2, 1), dt.date(2025, 2, 28)), ("GR", "wind", None, None)],
                                  "country string, category string, file_min date, file_max date")
    missing = work_grid.missing_days(want, files)
    got = [tuple(r) for r in work_grid.requests(missing.union(missing)).collect()]  # a range doesn't cross months
    assert got == [("GR", "wind", "daily", dt.date(2025, 1, 30), dt.date(2025, 1, 31), 2)]
    whole = work_grid.wanted_days(keys, lit("2025-02-01"), lit("2025-02-16"))
    got = [tuple(r) for r in work_grid.requests(whole).collect()]
    assert got == [("GR", "wind", "monthly", dt.date(2025, 2, 1), dt.date(2025, 2, 28), 15)]



def test_a_version_that_names_nothing(spark, tmp_dir):
    store = Store(spark, os.path.join(tmp_dir, "w"))
    none = spark.createDataFrame([], "table string, date_key date, country_code string, run string, rows long")
    assert [store.commit(none), store.commit(none), store.version()] == [1, 2, 2]
    one = store.write("t", "r1", spark.createDataFrame([(None, "GR", 1)], "date_key date, country_code string, v int"))
    rows = store.slices("t", one).withColumn("run", F.lit("r1"))
    assert store.commit(rows) == 3 and [tuple(r) for r in store.read("t").collect()] == [(None, "GR", 1)]


def test_the_overview_reads_one_day(spark, tmp_dir):
    silver, wh = os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "w")
    inc.ingest(raw_rows(spark), silver)
    inc.publish_marts(spark, silver, wh, "2025-03-01", "2025-03-01", gate_checks=inc.key_integrity_checks)
    inc.publish_marts(spark, silver, wh, "2025-03-02", "2025-03-02", gate_checks=inc.key_integrity_checks)
    latest = inc.latest_day(spark, wh, "fct_renewable_kpi")
    assert slices(latest) == [("2025-03-02", "FR"), ("2025-03-02", "GR")]
    runs = {f.split("run=")[1].split("/")[0] for f in latest.inputFiles() if "run=" in f}
    assert len(runs) == 1  # the other day's run isn't opened


def test_landed_files_grow_with_months(spark, tmp_dir):
    """Documents and cubes of six weeks: a folder a month, with all documents in them."""
    sf = os.path.join(tmp_dir, "sf")
    (spark.range(6 * 400).selectExpr("id div 400 * 10000 + id % 400 as event_id", "timestamp_ntz'2024-01-01' as ts", "id % 27 as user_id",
                                     "'view' as event_type", "cast(id as double) as value", "'{}' as props")
     .coalesce(1).write.parquet(f"{sf}/events.parquet"))
    (spark.range(40 * 24 * 4).where("id % 96 < 4").selectExpr("id as vec_id", "transform(sequence(1, 64), i -> cast(i as float)) as embedding", "0 as label")
     .coalesce(1).write.parquet(f"{sf}/embeddings.parquet"))
    at = inc.Layout(os.path.join(tmp_dir, "at"))
    inc.land_bronze(spark, sf, at)
    files = {folder: [f for d, _, names in os.walk(folder) for f in names if f.startswith("part-")] for folder in (at.documents, at.cubes)}
    assert len(files[at.documents]) == len(files[at.cubes]) == 3  # 2025-02-26 to 2025-04-08
    raw = inc.load_gen_raw(spark, sf)
    docs = bx.generation_documents(raw)
    got = sorted((str(r.date), r.country, r.xml) for r in bx.read_documents(spark, at.documents).where("domain = 'generation'").collect())
    assert got == sorted((str(r.date), r.country, r.xml) for r in docs.collect()) and len(got) > 300
    acks = bx.read_documents(spark, at.documents).where("xml like '<Ack%'")
    assert acks.count() == docs.where("day(date) % 3 = 0").select("country", "date").distinct().count() > 0
    assert spark.read.parquet(at.cubes).select("date").distinct().count() == 40


def test_packed_rejects_follow_a_corrected_file(spark, tmp_dir):
    at = inc.Layout(tmp_dir)
    docs = bx.generation_documents(raw_rows(spark).where("country is not null").coalesce(1)).withColumn("domain", F.lit("generation"))
    bx.pack_documents(docs.withColumn("xml", F.expr("if(date = date'2025-03-01', substring(xml, 1, 200), xml)")), at.documents)
    assert sorted((r.country, r.reason) for r in inc.bronze_to_silver(spark, at).collect()) == [("FR", "corrupt"), ("GR", "corrupt")]
    bx.land_documents(docs.where("country = 'FR' and date = date'2025-03-01'"), at.documents, "generation")
    assert inc.bronze_to_silver(spark, at, "2025-03-01", "2025-03-01", ["FR"]).count() == 0
    assert [r.country for r in inc.rejected(spark, at).collect()] == ["GR"]
    rows = inc.sinks.read_silver_generation(spark, at.silver_generation).groupBy("country", "date").count().collect()
    assert {(r.country, str(r.date)): r["count"] for r in rows} == {("FR", "2025-03-01"): 20, ("FR", "2025-03-02"): 20, ("GR", "2025-03-02"): 20}
