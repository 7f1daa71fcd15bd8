"""Three-phase top-k against the plain count, and what it leaves out of the shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickscope import plans
from clickscope.config import DRIVER_SPEC
from clickscope.operators import threshold_topk as K
from clickscope.operators.topk import top_k_per_group
from clickscope.sources import from_driver_tables
from tests.conftest import sf_dir


def plain(rows, k):
    counts = rows.dropna().groupBy("g", "i").agg(F.count(F.lit(1)).alias("count"))
    ranked = top_k_per_group(counts, ["g"], [F.desc("count"), F.asc("i")], k)
    return sorted(tuple(r) for r in ranked.select("g", "i", "count", "rank").collect())


def found(rows, k):
    return sorted(tuple(r) for r in K.top_k_counts(rows, ["g"], "i", k).collect())


DATA = {
    "even": "select id % 7 as g, cast(id * 31 % 400 as string) as i from range(9000)",
    "heads": "select id % 3 as g, cast(if(id % 4 = 0, id % 30, id) as string) as i from range(9000)",
    "a third in one": "select if(id % 3 = 0, 5, id % 90) as g, cast(if(id % 9 = 0, 1, id % 2000) as string) as i from range(9000)",
    "ties": "select 1L as g, cast(id as string) as i from range(50)",
    "few": "select id as g, 'x' as i from range(5)",
    "nulls": "select if(id % 5 = 0, null, id % 2) as g, if(id % 7 = 0, null, cast(id % 9 as string)) as i from range(300)",
    "none": "select 1L as g, 'x' as i from range(0)",
}


@pytest.mark.parametrize("kind", DATA)
@pytest.mark.parametrize("tasks", [1, 6])
def test_equals_the_plain_count(spark, kind, tasks):
    rows = spark.sql(DATA[kind]).repartition(tasks)
    for k in (1, 4, 100):
        assert found(rows, k) == plain(rows, k)


def test_a_task_that_tells_in_several_rows(spark, monkeypatch):
    rows = spark.sql(DATA["heads"]).repartition(3)
    original = K.local_counts

    def torn(*args):  # every local count as two rows
        local = original(*args)
        return local.withColumn("__n", F.explode(F.array(F.expr("__n div 2"), F.expr("__n - __n div 2"))))

    monkeypatch.setattr(K, "local_counts", torn)
    assert found(rows, 5) == plain(rows, 5)


def test_same_sessions_and_fewer_shuffled_rows(spark):
    t = from_driver_tables(spark, sf_dir("0.1"))
    # twelve sessions with three of four clicks, as robots have, over four input partitions
    robots = F.expr("if(action_seq % 4 > 0, concat('robot-', pmod(xxhash64(action_seq), 12)), session_id)")
    actions = t.actions.repartition(4, "action_seq").withColumn("session_id", robots)
    actions = plans.filtered_actions(type(t)(actions, t.users, t.products, t.cities), DRIVER_SPEC).cache()
    top = plans.category_top10(actions).cache()
    want = sorted(tuple(r) for r in plans.category_session_top10(actions, top).collect())
    got = sorted(tuple(r) for r in plans.category_session_top10_by_threshold(actions, top).collect())
    assert got == want and len(got) == 100
    clicks = plans.category._clicks_of(actions, top)
    local = K._stored(K.local_counts(clicks, ["category_id"], "session_id"))
    shipped_plainly = local.count()  # a row for each task, category and session
    shipped = K.surviving_counts(local, ["category_id"], "session_id", 10).count()
    assert shipped * 4 < shipped_plainly, (shipped, shipped_plainly)
