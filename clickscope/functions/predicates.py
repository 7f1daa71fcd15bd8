"""Column predicates built from a :class:`FilterSpec`.

Bounds that are not set contribute nothing, so an empty spec yields no
predicate at all (the original's ``where 1=1`` base).  Every predicate is a
plain Column, so Catalyst pushes it into the parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickscope.config import FilterSpec


def all_of(predicates: list[Column]) -> Column | None:
    if not predicates:
        return None
    return reduce(lambda left, right: left & right, predicates)


def action_predicates(spec: FilterSpec) -> list[Column]:
    """F1, F2 (date range, inclusive) and the optional fact-side lists.

    The category list is not among them: an action holds several categories
    (a click's, or its ordered or paid ones), so it applies to the exploded
    rows of the category jobs (``operators.behavior.of_categories``).
    """
    preds: list[Column] = []
    if spec.start_date is not None:
        preds.append(F.col("date") >= F.lit(spec.start_date))
    if spec.end_date is not None:
        preds.append(F.col("date") <= F.lit(spec.end_date))
    if spec.city_ids:
        preds.append(F.col("city_id").isin(list(spec.city_ids)))
    if spec.keywords:
        preds.append(F.col("search_keyword").isin(list(spec.keywords)))
    return preds


def user_predicates(spec: FilterSpec) -> list[Column]:
    """F3, F4 (age range, inclusive, integer literals) and user lists."""
    preds: list[Column] = []
    if spec.start_age is not None:
        preds.append(F.col("age") >= F.lit(int(spec.start_age)))
    if spec.end_age is not None:
        preds.append(F.col("age") <= F.lit(int(spec.end_age)))
    if spec.professionals:
        preds.append(F.col("professional").isin(list(spec.professionals)))
    if spec.genders:
        preds.append(F.col("gender").isin(list(spec.genders)))
    return preds


def page_in_flow(spec: FilterSpec, page_col: str = "page_id") -> Column:
    """the page is one of the target flow's pages."""
    return F.col(page_col).isin(list(dict.fromkeys(spec.target_page_flow)))


def is_target_jump(spec: FilterSpec, from_col: str, to_col: str) -> Column:
    """``(from, to)`` is one step of the target flow.

    The pair set is a parameter (flow length - 1 entries), so it is inlined
    as a disjunction that runs inside generated code; no join is needed.
    """
    pairs = list(dict.fromkeys(spec.jump_pairs))
    if not pairs:
        return F.lit(False)
    return F.expr(
        " or ".join(f"(`{from_col}` = {int(a)} and `{to_col}` = {int(b)})" for a, b in pairs)
    )
