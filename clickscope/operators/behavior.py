"""Classify actions as click / order / pay and count them per category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.constants import CLICK, NO_CLICK, ORDER, PAY
from clickscope.functions.idlists import id_list_sql

IS_CLICK_SQL = f"click_category_id != {NO_CLICK}"

# F6-F8: the first that applies of click, order, pay (else null).  The kinds
# exclude one another in that order: an action that is both a click and an
# order counts only as a click.
KIND_SQL = (
    f"case when {IS_CLICK_SQL} then '{CLICK}'"
    f" when order_category_ids is not null then '{ORDER}'"
    f" when pay_category_ids is not null then '{PAY}' end"
)

# The categories an action counts for, by the same precedence.
CATEGORY_IDS_SQL = (
    f"case when {IS_CLICK_SQL} then array(click_category_id)"
    f" when order_category_ids is not null then {id_list_sql('order_category_ids')}"
    f" when pay_category_ids is not null then {id_list_sql('pay_category_ids')} end"
)


def is_click() -> Column:
    return F.expr(IS_CLICK_SQL)


def behavior_kind() -> Column:
    return F.expr(KIND_SQL)


def behavior_category_ids() -> Column:
    return F.expr(CATEGORY_IDS_SQL)


def behavior_rows(actions: DataFrame) -> DataFrame:
    """P7: one row ``(kind, category_id)`` per counted category of an action.

    One pass over the fact table: the kind and the id array are computed
    together and exploded once (no union of three filtered scans).  Actions
    of no kind have a null array and produce no row.
    """
    return actions.selectExpr(f"{KIND_SQL} as kind", f"explode({CATEGORY_IDS_SQL}) as category_id")


def of_categories(behaviors: DataFrame, categories: Sequence[int]) -> DataFrame:
    """the rows of the listed categories (an empty list: all rows)."""
    return behaviors.where(F.col("category_id").isin(list(categories))) if categories else behaviors


def count_behaviors(behaviors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A1: clicks, orders and pays per category (and ``by``), 0 when a kind is missing.

    A plain ``groupBy`` with conditional counts: Spark aggregates partially
    in every task before the shuffle, so a category that holds a third of
    all actions costs one row per task on the wire.
    """
    return behaviors.groupBy(*by, "category_id").agg(
        F.expr(f"count_if(kind = '{CLICK}') as click_count"),
        F.expr(f"count_if(kind = '{ORDER}') as order_count"),
        F.expr(f"count_if(kind = '{PAY}') as pay_count"),
    )
