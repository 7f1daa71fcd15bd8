"""Q1: the actions a job looks at."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickscope.config import FilterSpec
from clickscope.functions.predicates import action_predicates, all_of, user_predicates
from clickscope.operators.joins import restrict_to_keys
from clickscope.sources.tables import ClickstreamTables


def filtered_actions(tables: ClickstreamTables, spec: FilterSpec) -> DataFrame:
    """Actions of known users, cut by the spec's date and age ranges.

    Date predicates go to the fact scan (pushed into parquet, and into the
    folder layout when the table is partitioned by ``date``); age
    predicates go to the user scan before the semi join, so only the keys
    of qualifying users meet the fact table.  Actions of users missing
    from ``user_info`` are dropped even without an age bound, as the
    original inner join did.
    """
    actions = tables.actions
    fact_filter = all_of(action_predicates(spec))
    if fact_filter is not None:
        actions = actions.where(fact_filter)
    return restrict_to_keys(
        actions,
        tables.users,
        fact_key="user_id",
        dimension_key="userId",
        dimension_filter=all_of(user_predicates(spec)),
    )
