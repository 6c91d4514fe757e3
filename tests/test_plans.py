"""Plan regression tests: the physical properties the scale design relies on."""

import re

import pytest

from conftest import SF_SMALL
from gridmix.plans import catalog

catalog.load_all()
Q = catalog.QUERIES


def plan(spark, name):
    df = Q[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(p):
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", p))


def test_dedup_limits_before_the_shuffle(spark):
    p = plan(spark, "stg_generation")
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    assert shuffles(p) == 1
    # only the three columns the recipe needs are read
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in p


def test_carbon_mart_runs_the_pipeline_once(spark):
    p = plan(spark, "fct_grid_carbon_intensity")
    assert p.count("FileScan parquet") == 1
    assert shuffles(p) == 3  # dedup; (date, country) for hourly + daily; country for the typical hour
    assert "BroadcastHashJoin" in p  # the 20-row energy-source seed


def test_weather_is_scanned_and_pivoted_once(spark):
    p = plan(spark, "int_generation_weather")
    assert p.count("embeddings.parquet") == 1 and p.count("events.parquet") == 1


def test_overview_has_no_subquery_or_cross_join(spark):
    p = plan(spark, "overview_kpis")
    assert "Subquery" not in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "TakeOrderedAndProject" in p


@pytest.mark.parametrize("name", sorted(Q))
def test_no_cartesian_products_anywhere(spark, name):
    p = plan(spark, name)  # queries that write while planning are run, and their last plan is looked at
    assert "CartesianProduct" not in p


def test_kpi_chain_has_two_shuffles(spark):
    # dedup (hour, country, source) + one (date, country) repartition for daily/window/KPI
    assert shuffles(plan(spark, "fct_renewable_kpi")) == 2


def test_carbon_mart_aggregates_are_hash_based(spark):
    # the extreme-hour picks are packed LONG keys, so no struct buffer forces a sort aggregate
    assert "SortAggregate" not in plan(spark, "fct_grid_carbon_intensity")
