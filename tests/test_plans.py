"""Physical plan shape: what runs where, for every registered query."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from clickscope import plans
from clickscope.config import FilterSpec
from clickscope.sources import from_driver_tables
from tests.conftest import sf_dir

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans_text(spark):
    return {name: _plan(build(spark, sf_dir("0.01"))) for name, build in entry.clickstream_queries().items()}


def test_no_python_in_any_plan(plans_text):
    for name, text in plans_text.items():
        for node in PYTHON_NODES:
            assert node not in text, (name, node)


def test_no_cartesian_or_nested_loop(plans_text):
    for name, text in plans_text.items():
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_per_group_top_k_limits_before_shuffle(plans_text):
    for name in ("category_session_top10", "area_product_top3", "area_city_share"):
        text = plans_text[name]
        assert text.count("WindowGroupLimit") >= 2, name  # partial + final


def test_top10_membership_is_a_semi_join(plans_text):
    text = plans_text["category_session_top10"]
    assert "LeftSemi" in text
    assert "TakeOrderedAndProject" in text


def test_aggregates_are_partial_before_shuffle(plans_text):
    for name in ("category_top10", "page_visit_counts", "area_product_city_clicks"):
        assert "partial_count" in plans_text[name], name
    assert "partial_count(1), partial_max" in plans_text["page_jump_counts"]


def test_area_counts_before_joining_dimensions(spark):
    df = entry.queries()["area_product_city_clicks"](spark, sf_dir("0.01"))
    text = _plan(df)
    # the first aggregate over the fact scan sits below every join
    agg = text.index("HashAggregate(keys=[city_id")
    join = text.index("Join")
    assert agg > join  # printed top-down: deeper operators come later


def test_jump_counts_shuffle_the_clicks_once(plans_text):
    # one shuffle of the clicks by (session, slice); the others carry a
    # bounded sample, or a row for each wanted pair and each slice
    for name in ("page_jump_counts", "page_jump_rate"):
        text = plans_text[name]
        assert text.count("Window [lead(__value") == 1, name
        assert "rangepartitioning" not in text, name
        assert len(re.findall(r"hashpartitioning\(session_id#\d+, __slice", text)) == 1, name


def test_many_pairs_have_the_plan_of_few(spark):
    """1,000 pages: one lookup, not a column or a branch for each pair."""
    actions = from_driver_tables(spark, sf_dir("0.001")).actions
    few = _plan(plans.page_jump_counts(actions, FilterSpec(target_page_flow=tuple(range(1, 8)))))
    many = _plan(plans.page_jump_counts(actions, FilterSpec(target_page_flow=tuple(range(1, 1001)))))
    assert len(few.splitlines()) == len(many.splitlines())
    assert "INSET" in many


def test_area_jobs_leave_other_actions_in_the_scan(spark, tmp_path):
    from clickscope.sources import read_parquet_tables, write_parquet_tables

    root = str(tmp_path / "tables")
    write_parquet_tables(from_driver_tables(spark, sf_dir("0.001")), root)
    tables = read_parquet_tables(spark, root)
    for job in (
        plans.area_product_city_rows,
        plans.area_product_clicks,
        plans.area_product_top3,
        plans.area_product_city_clicks,
        plans.area_city_share,
    ):
        text = _plan(job(tables))
        assert "Not(EqualTo(click_product_id,-1))" in text, job.__name__


def test_area_share_builds_on_the_top_rows(spark):
    df = entry.clickstream_queries()["area_city_share"](spark, sf_dir("0.01"))
    rows = df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert len(rows) == 75
    top_join = next(line for line in final.splitlines() if "Join" in line)  # printed top-down
    assert "BroadcastHashJoin [area" in top_join and "BuildRight" in top_join


def test_queries_register_nothing(spark):
    before = {t.name for t in spark.catalog.listTables()}
    entry.clickstream_queries()["category_top10"](spark, sf_dir("0.001")).collect()
    assert {t.name for t in spark.catalog.listTables()} == before
