"""Q2, Q3: hot categories and the sessions that drive them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.constants import TOP_CATEGORIES, TOP_SESSIONS
from clickscope.operators.behavior import behavior_rows, count_behaviors, of_categories
from clickscope.operators.threshold_topk import top_k_counts
from clickscope.operators.topk import top_k, top_k_per_group


def category_order() -> list[Column]:
    """Clicks, then orders, then pays, all descending; then the id."""
    return [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")]


def category_behavior_counts(actions: DataFrame, categories: Sequence[int] = ()) -> DataFrame:
    """Clicks, orders and pays of every category that has any.

    ``actions`` is the output of :func:`filtered_actions`.  ``categories``
    (none: all) are the ones to count; the list applies to clicks, orders
    and pays alike.
    """
    return count_behaviors(of_categories(behavior_rows(actions), categories))


def category_top10(
    actions: DataFrame, k: int = TOP_CATEGORIES, categories: Sequence[int] = ()
) -> DataFrame:
    """The k categories with most clicks, then orders, then pays.

    Ties after all three counts go to the lower category id, so the cut is
    the same every run.
    """
    counts = category_behavior_counts(actions, categories)
    return top_k(counts, category_order(), k).select(
        "category_id", "click_count", "order_count", "pay_count"
    )


def category_session_counts(actions: DataFrame, top: DataFrame) -> DataFrame:
    """Clicks per (category, session) for the categories in ``top``.

    ``top`` is usually a top-k result, which Spark's size check broadcasts,
    so the fact side is not shuffled for the membership test; any other set
    of categories may be given.  The count is aggregated partially in every
    task, so a hot session is one row per task before the shuffle.
    """
    return _clicks_of(actions, top).groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count"))


def _clicks_of(actions: DataFrame, top: DataFrame) -> DataFrame:
    """``category_id, session_id`` of every click on a category of ``top``."""
    ids = top.select(F.col("category_id").alias("__top_category"))
    members = actions.join(
        ids, actions["click_category_id"] == ids["__top_category"], "left_semi"
    )
    return members.select(F.col("click_category_id").alias("category_id"), "session_id")


def category_session_top10(
    actions: DataFrame, top: DataFrame, k: int = TOP_SESSIONS
) -> DataFrame:
    """In each hot category, the k sessions with most clicks (ties: lower
    session id first), with their rank."""
    counts = category_session_counts(actions, top)
    ranked = top_k_per_group(
        counts,
        group=["category_id"],
        order=[F.desc("click_count"), F.asc("session_id")],
        k=k,
        rank_col="session_rank",
    )
    return ranked.select("category_id", "session_id", "click_count", "session_rank")


def category_session_top10_by_threshold(actions: DataFrame, top: DataFrame, k: int = TOP_SESSIONS) -> DataFrame:
    """:func:`category_session_top10` in three phases, so that sessions that
    cannot be among the k are never shuffled.

    Worth it where few sessions hold many clicks (robots, shared terminals)
    and the fact table has many files.  The counts of each task are stored when
    this is called.
    """
    return top_k_counts(
        _clicks_of(actions, top), ["category_id"], "session_id", k, count_col="click_count", rank_col="session_rank"
    )
