"""Column helpers: id lists, predicates, share of total."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickscope import plans
from clickscope.config import FilterSpec
from clickscope.functions import action_predicates, all_of, id_list, id_tokens, is_target_jump, page_in_flow, user_predicates
from clickscope.operators.share import share_of_group


def test_id_lists(spark):
    df = spark.createDataFrame([("3,1,",), ("1,,2",), (None,), ("",), ("7",), ("5,5",)], "ids string")
    rows = df.select(id_tokens("ids").alias("t"), id_list("ids").alias("n")).collect()
    assert [r.t for r in rows] == [["3", "1"], ["1", "2"], None, [], ["7"], ["5", "5"]]
    assert [r.n for r in rows] == [[3, 1], [1, 2], None, [], [7], [5, 5]]


def test_unset_bounds_give_no_predicate():
    assert all_of(action_predicates(FilterSpec())) is None
    assert all_of(user_predicates(FilterSpec())) is None


def test_bounds_are_inclusive(spark):
    spec = FilterSpec(start_date="2018-11-01", end_date="2018-11-02", start_age=20, end_age=21)
    actions = spark.createDataFrame(
        [("2018-10-31",), ("2018-11-01",), ("2018-11-02",), ("2018-11-03",)], "date string"
    )
    users = spark.createDataFrame([(19,), (20,), (21,), (22,)], "age int")
    assert [r.date for r in actions.where(all_of(action_predicates(spec))).collect()] == [
        "2018-11-01",
        "2018-11-02",
    ]
    assert [r.age for r in users.where(all_of(user_predicates(spec))).collect()] == [20, 21]


def test_flow_predicates(spark):
    spec = FilterSpec(target_page_flow="1,2,3")
    df = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (3, 1), (3, 4)], "a bigint, b bigint")
    assert [(r.a, r.b) for r in df.where(is_target_jump(spec, "a", "b")).collect()] == [(1, 2), (2, 3)]
    assert [r.a for r in df.where(page_in_flow(spec, "a")).collect()] == [1, 2, 1, 3, 3]
    assert df.where(is_target_jump(FilterSpec(target_page_flow="1"), "a", "b")).count() == 0


def test_share_by_window_equals_share_by_total(golden):
    cells = plans.area_product_city_clicks(golden)
    by_window = cells.select(
        "area", "product_id", "city_id", share_of_group("click_count", ["area", "product_id"]).alias("s")
    )
    totals = cells.groupBy("area", "product_id").agg(F.sum("click_count").alias("total"))
    by_total = cells.join(totals, ["area", "product_id"]).select(
        "area", "product_id", "city_id", share_of_group("click_count", [], total_col="total").alias("s")
    )
    assert sorted(by_window.collect()) == sorted(by_total.collect())
