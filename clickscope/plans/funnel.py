"""Q4-Q6: page-to-page jump counts, page visits and jump rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.config import FilterSpec
from clickscope.constants import NO_CLICK, PAGE_FLOW_SEPARATOR
from clickscope.functions.predicates import page_in_flow
from clickscope.operators.adjacency import count_consecutive_pairs

# The order of actions inside a session: time, then the unique sequence
# number (timestamps have one-second resolution and often tie).
SESSION_ORDER = ("action_time", "action_seq")


def page_jump_counts(actions: DataFrame, spec: FilterSpec) -> DataFrame:
    """How often a session's next product click follows on the next page of
    the target flow.

    The next click is found among *all* product clicks of the session in
    time order; only then are pairs cut to the flow's steps, so no
    adjacency is invented by dropping pages in between.  Clicks are shuffled
    once, by session; one that holds a large part of all clicks is cut into
    runs of consecutive clicks first (:func:`count_consecutive_pairs`).
    """
    clicks = actions.where(F.col("click_product_id") != F.lit(NO_CLICK))
    return count_consecutive_pairs(
        clicks,
        group=["session_id"],
        order=list(SESSION_ORDER),
        value="page_id",
        pairs=spec.jump_pairs,
        from_col="from_page_id",
        to_col="to_page_id",
        count_col="jump_count",
    )


def page_visit_counts(actions: DataFrame, spec: FilterSpec) -> DataFrame:
    """Actions of any kind on each page of the target flow."""
    return (
        actions.where(page_in_flow(spec))
        .groupBy("page_id")
        .agg(F.count(F.lit(1)).alias("visit_count"))
    )


def page_jump_rate(actions: DataFrame, spec: FilterSpec) -> DataFrame:
    """jumps(from -> to) / visits(from), as a double.

    The visit counts have at most one row per page of the flow (a
    parameter), so their broadcast is bounded.  A step whose from-page has
    no visits divides by 1, as the original did; that cannot happen for a
    step that has jumps, since the jump's first click is itself a visit.
    """
    jumps = page_jump_counts(actions, spec)
    visits = F.broadcast(page_visit_counts(actions, spec))
    joined = jumps.join(visits, jumps["from_page_id"] == visits["page_id"], "left")
    visit_count = F.coalesce(F.col("visit_count"), F.lit(1).cast("bigint"))
    return joined.select(
        F.col("from_page_id"),
        F.col("to_page_id"),
        F.concat_ws(PAGE_FLOW_SEPARATOR, F.col("from_page_id"), F.col("to_page_id")).alias("page_flow"),
        F.col("jump_count"),
        visit_count.alias("visit_count"),
        (F.col("jump_count").cast("double") / visit_count).alias("rate"),
    )
