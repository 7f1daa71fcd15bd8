"""Every registered query against its DuckDB oracle on the driver's tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import sf_dir
from tests.oracle_check import compare


def test_every_clickstream_query_has_an_oracle():
    assert set(entry.clickstream_queries()) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_queries_match_oracle(spark, sf):
    report = compare(spark, sf_dir(sf), list(entry.clickstream_queries()))
    bad = {k: v for k, v in report.items() if not (v["columns_match"] and v["values_match"])}
    assert not bad, bad


def test_listed_categories_have_orders_and_pays(spark):
    rows = entry.clickstream_queries()["category_top10_listed"](spark, sf_dir("0.01")).collect()
    assert {r.category_id for r in rows} <= set(entry.LISTED.category_ids)
    assert sum(r.order_count for r in rows) and sum(r.pay_count for r in rows)


def test_expected_sizes_sf001(spark):
    # Sizes of the four headline results on sf0.01 with the driver spec.
    report = compare(
        spark,
        sf_dir("0.01"),
        ["category_top10", "category_session_top10", "page_jump_rate", "area_city_share"],
    )
    assert [report[k]["rows"] for k in report] == [10, 100, 6, 75]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns == ["category_id", "click_count", "order_count", "pay_count"]
