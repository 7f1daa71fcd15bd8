"""Hot keys: results stay whole and the hot key is split, not gathered."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from clickscope import plans
from clickscope.config import DRIVER_SPEC, FilterSpec
from clickscope.operators.adjacency import count_consecutive_pairs
from clickscope.operators.slices import with_slices
from clickscope.sources import from_driver_tables
from clickscope.sources.tables import ClickstreamTables
from tests.conftest import sf_dir
from tests.test_adjacency import brute_counts

# Settings that make the local data look like a cluster-size skew: no
# broadcast, and a partition counts as skewed from a few kilobytes.
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot_user_tables(spark):
    t = from_driver_tables(spark, sf_dir("0.01"))
    # user 7 now holds a third of all actions
    # several map tasks, as a large input has: AQE splits a partition by them
    hot = t.actions.repartition(8, "action_seq").withColumn(
        "user_id", F.when(F.col("action_seq") % 3 == 0, F.lit(7)).otherwise(F.col("user_id"))
    )
    return ClickstreamTables(hot, t.users, t.products, t.cities)


def test_hot_user_is_split_in_the_semi_join(spark):
    tables = _hot_user_tables(spark)
    spec = FilterSpec(start_age=10, end_age=60)
    expected = sorted(plans.category_top10(plans.filtered_actions(tables, spec)).collect())
    with conf(spark, SKEW_CONF):
        df = plans.category_top10(plans.filtered_actions(tables, spec))
        got = sorted(df.collect())
        text = df._jdf.queryExecution().executedPlan().toString()
    assert got == expected
    assert "SortMergeJoin(skew=true)" in text and "LeftSemi" in text


def test_hot_session_gives_whole_results(spark):
    t = from_driver_tables(spark, sf_dir("0.01"))
    # one session holds a third of all clicks
    hot = t.actions.withColumn(
        "session_id", F.when(F.col("action_seq") % 3 == 0, F.lit("hot")).otherwise(F.col("session_id"))
    )
    tables = ClickstreamTables(hot, t.users, t.products, t.cities)
    actions = plans.filtered_actions(tables, DRIVER_SPEC)
    clicks = actions.where("click_product_id != -1")
    args = dict(group=["session_id"], order=["action_time", "action_seq"], value="page_id", pairs=DRIVER_SPEC.jump_pairs)
    jumps = {(r[0], r[1]): r[2] for r in plans.page_jump_counts(actions, DRIVER_SPEC).collect()}
    assert jumps == brute_counts(clicks, **args)
    top = plans.category_top10(actions)
    sessions = plans.category_session_top10(actions, top).collect()
    assert len(sessions) == 100
    assert all(r.session_rank == 1 for r in sessions if r.session_id == "hot")


def test_hot_session_within_a_day_is_spread_over_tasks(spark):
    """A third of 300,000 clicks in one session and one day: no task has over
    twice the median's rows, and the counts are the plain window's."""
    clicks = spark.range(300_000, numPartitions=8).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 30000 as string)) as session_id",
        "cast(timestamp_seconds(id div 4) as string) as action_time",  # ties in every second
        "id as action_seq",
        "xxhash64(id) % 5 + 5 as page_id",
    )
    keys = dict(group=["session_id"], order=["action_time", "action_seq"])
    sliced = with_slices(clicks, **keys)
    largest = sliced.groupBy("session_id", "__slice").count().agg(F.max("count")).first()[0]
    assert largest < 300_000 / 40
    dealt = sliced.repartition(8, "session_id", "__slice").groupBy(F.spark_partition_id()).count()
    sizes = sorted(r["count"] for r in dealt.collect())
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[4]
    hot = sliced.where("session_id = 'hot'")
    runs = hot.groupBy("__slice").agg(F.min("action_seq").alias("lo"), F.max("action_seq").alias("hi")).orderBy("lo").collect()
    assert [r["__slice"] for r in runs] == list(range(len(runs)))  # consecutive runs, none inside another
    assert all(a.hi < b.lo for a, b in zip(runs, runs[1:]))
    pairs = [(a, b) for a in range(10) for b in range(10)]
    got = count_consecutive_pairs(clicks, **keys, value="page_id", pairs=pairs).collect()
    assert {(r[0], r[1]): r[2] for r in got} == brute_counts(clicks, **keys, value="page_id", pairs=pairs)


def test_jump_direction_on_driver_data(spark):
    # Ascending time gives 18 jumps 1 -> 2 at sf0.01; descending would give 14.
    actions = plans.filtered_actions(from_driver_tables(spark, sf_dir("0.01")), DRIVER_SPEC)
    jumps = {(r.from_page_id, r.to_page_id): r.jump_count for r in plans.page_jump_counts(actions, DRIVER_SPEC).collect()}
    assert jumps[(1, 2)] == 18


def test_large_user_table_gets_a_runtime_bloom_filter(spark):
    # When users are too many to broadcast, the semi join is sort-merge and
    # Spark first trims the fact side with a bloom filter of qualifying users.
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    tables = from_driver_tables(spark, sf_dir("0.01"))
    with conf(spark, settings):
        df = plans.category_top10(plans.filtered_actions(tables, DRIVER_SPEC))
        rows = sorted(df.collect())
        text = df._jdf.queryExecution().executedPlan().toString()
    assert "might_contain" in text and "SortMergeJoin" in text
    assert rows == sorted(plans.category_top10(plans.filtered_actions(tables, DRIVER_SPEC)).collect())


def test_hot_product_is_split_in_the_row_level_area_join(spark):
    t = from_driver_tables(spark, sf_dir("0.01"))
    hot = t.actions.withColumn(
        "click_product_id",
        F.when((F.col("click_product_id") != -1) & (F.col("action_seq") % 3 == 0), F.lit(5)).otherwise(
            F.col("click_product_id")
        ),
    )
    tables = ClickstreamTables(hot, t.users, t.products, t.cities)
    expected = sorted(plans.area_product_city_rows(tables).groupBy("product_id").count().collect())
    with conf(spark, SKEW_CONF):
        df = plans.area_product_city_rows(tables)
        got = sorted(df.groupBy("product_id").count().collect())
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
    assert got == expected
    assert "SortMergeJoin(skew=true)" in text


def test_other_actions_never_meet_on_one_product(spark):
    # Three of five actions are no clicks and carry product -1.
    t = from_driver_tables(spark, sf_dir("0.01"))
    assert t.actions.where("click_product_id = -1").count() * 2 > t.actions.count()
    with conf(spark, SKEW_CONF):
        df = plans.area_product_city_rows(t)
        rows = df.count()
        text = df._jdf.queryExecution().optimizedPlan().toString()
    clicks = t.actions.where("click_product_id != -1")
    joined = clicks.join(t.products, clicks["click_product_id"] == t.products["product_id"], "left_semi")
    assert rows == joined.join(t.cities, "city_id", "left_semi").count()
    assert "= -1)" in text  # the condition, below the joins
    assert text.index("Join") < text.index("= -1)")
