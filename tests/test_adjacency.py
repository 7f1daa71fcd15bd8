"""The sliced pair counts against the plain one-window plan."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from clickscope.operators import slices
from clickscope.operators.adjacency import count_consecutive_pairs
from clickscope.sources.adapter import from_driver_tables
from tests.conftest import sf_dir


def pairs_by_window(df, group, order, value):
    """The plain plan: one window over each whole group."""
    window = Window.partitionBy(*group).orderBy(*order)
    has_next: Column = F.lead(F.lit(1)).over(window).isNotNull()
    rows = df.select(F.col(value).alias("a"), F.lead(value).over(window).alias("b"), has_next.alias("more"))
    return rows.where("more").select("a", "b")


def brute_counts(df, group, order, value, pairs):
    found = Counter(tuple(r) for r in pairs_by_window(df, group, order, value).collect())
    return {p: found[p] for p in pairs if found[p]}


def sliced_counts(df, **args):
    return {(r[0], r[1]): r[2] for r in count_consecutive_pairs(df, **args).collect()}


EVERY_PAGE_PAIR = [(a, b) for a in range(1, 11) for b in range(1, 11)]


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_counts_match_the_window_on_driver_clicks(spark, reuse, adaptive):
    actions = from_driver_tables(spark, sf_dir("0.01")).actions.where("click_product_id != -1")
    args = dict(group=["session_id"], order=["action_time", "action_seq"], value="page_id", pairs=EVERY_PAGE_PAIR)
    keys = {"spark.sql.exchange.reuse": reuse, "spark.sql.adaptive.enabled": adaptive}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        assert sliced_counts(actions, **args) == brute_counts(actions, **args)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("step", [1, 3, 8])
def test_hot_group_is_cut_and_stitched(spark, monkeypatch, step):
    monkeypatch.setattr(slices, "ONE_OF", 2)
    monkeypatch.setattr(slices, "STEP", step)
    hot = spark.range(0, 3000).select(
        F.lit("hot").alias("g"), F.col("id").alias("t"), ((F.col("id") * 7) % 5).alias("v")
    )
    cold = spark.range(0, 400).select(
        (F.col("id") % 30).cast("string").alias("g"), F.col("id").alias("t"), (F.col("id") % 4).alias("v")
    )
    data = hot.unionByName(cold)
    args = dict(group=["g"], order=["t"], value="v", pairs=[(1, 3), (3, 0), (2, 2), (0, 2)])
    assert slices.hot_group_bounds(data, ["g"], ["t"]).selectExpr("g", "size(__bounds) > 20 as many").collect() == [("hot", True)]
    got = sliced_counts(data, **args)
    assert got == brute_counts(data, **args)
    assert got


def test_null_values_groups_and_slices(spark):
    data = spark.createDataFrame(
        [(None, None, 1, 1), (None, None, 2, None), (None, 1, 3, 1), (None, 1, 4, 2), ("a", 1, 1, None),
         ("a", 1, 2, 1), ("a", 2, 3, 2), ("b", 1, 1, 2)],
        "g string, s int, t int, v int",
    )
    args = dict(group=["g"], order=["t"], value="v", pairs=[(1, 2), (1, 1), (2, 1)])
    assert sliced_counts(data, **args) == brute_counts(data, **args) == {(1, 2): 2}


def test_repeated_and_missing_pairs(spark):
    data = spark.createDataFrame([("a", 1, 1, 1), ("a", 1, 2, 2)], "g string, s int, t int, v long")
    args = dict(group=["g"], order=["t"], value="v")
    assert sliced_counts(data, pairs=[(1, 2), (1, 2)], **args) == {(1, 2): 1}
    empty = count_consecutive_pairs(data, pairs=[], **args)
    assert empty.count() == 0 and [t for _, t in empty.dtypes] == ["bigint", "bigint", "bigint"]
    assert sliced_counts(data.limit(0), pairs=[(1, 2)], **args) == {}


def test_ids_far_apart_and_negative(spark):
    data = spark.createDataFrame(
        [("a", 1, -(2**62)), ("a", 2, 2**62), ("a", 3, 5), ("a", 4, -7), ("a", 5, 5), ("a", 6, -7)], "g string, t int, v long"
    )
    args = dict(group=["g"], order=["t"], value="v")
    for pairs in ([(-(2**62), 2**62), (2**62, 5)], [(5, -7), (-7, 5), (-7, -7)]):
        assert sliced_counts(data, pairs=pairs, **args) == brute_counts(data, pairs=pairs, **args) != {}
