"""The four applications: compute a job and store it under one run id.

``run_category_session_top10`` reads the top-10 categories of the same run
back from the store, as the original did through its database.  That read
is filtered by ``task_id`` (the original read every run ever stored), so it
is at most ten rows, and the stored table cuts the lineage between the two
jobs: a lost executor in the second job never recomputes the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickscope.config import FilterSpec
from clickscope.plans.actions import filtered_actions
from clickscope.plans.area import area_city_share
from clickscope.plans.category import category_session_top10, category_top10
from clickscope.plans.funnel import page_jump_rate
from clickscope.sinks.results import JdbcResultStore, ResultStore, as_result, new_task_id
from clickscope.sources.tables import ClickstreamTables

Store = ResultStore | JdbcResultStore


def run_category_top10(
    tables: ClickstreamTables, spec: FilterSpec, store: Store, task_id: str
) -> DataFrame:
    top = category_top10(filtered_actions(tables, spec), categories=spec.category_ids)
    store.append("category_top10", as_result("category_top10", top), task_id)
    return store.read(tables.actions.sparkSession, "category_top10", task_id)


def run_category_session_top10(
    tables: ClickstreamTables, spec: FilterSpec, store: Store, task_id: str
) -> DataFrame:
    spark = tables.actions.sparkSession
    top = store.read(spark, "category_top10", task_id)
    sessions = category_session_top10(filtered_actions(tables, spec), top)
    store.append(
        "category_session_top10", as_result("category_session_top10", sessions), task_id
    )
    return store.read(spark, "category_session_top10", task_id)


def run_page_jump_rate(
    tables: ClickstreamTables, spec: FilterSpec, store: Store, task_id: str
) -> DataFrame:
    rates = page_jump_rate(filtered_actions(tables, spec), spec)
    store.append("page_jump_rate", as_result("page_jump_rate", rates), task_id)
    return store.read(tables.actions.sparkSession, "page_jump_rate", task_id)


def run_area_top3(tables: ClickstreamTables, spec: FilterSpec | None = None) -> DataFrame:
    """The area job stores nothing (the original had no result table for
    it); the caller gets the DataFrame of top products and city shares."""
    return area_city_share(tables, spec)


def run_all(
    tables: ClickstreamTables,
    spec: FilterSpec,
    store: Store,
    task_id: str | None = None,
) -> str:
    """Run the three stored jobs in order under one task id; return it.

    The fourth, :func:`run_area_top3`, stores nothing; the caller runs it
    for its DataFrame.
    """
    task_id = task_id or new_task_id()
    run_category_top10(tables, spec, store, task_id)
    run_category_session_top10(tables, spec, store, task_id)
    run_page_jump_rate(tables, spec, store, task_id)
    return task_id
