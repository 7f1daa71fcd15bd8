"""Fact-to-dimension joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def restrict_to_keys(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    dimension_filter: Column | None = None,
) -> DataFrame:
    """Keep the fact rows whose key names a (filtered) dimension row.

    This is the original ``select t.* from fact t join dim d on ...`` with
    only fact columns kept.  Because dimension keys are unique, the inner
    join equals a left-semi join, which never widens or duplicates fact
    rows and ships only the key column of the dimension.

    No broadcast hint: the dimension (users) grows with the data, so the
    choice is left to Spark's size check (``autoBroadcastJoinThreshold``,
    re-checked by AQE on the real filtered size).  Beyond it the plan is a
    sort-merge semi join whose skewed fact partitions AQE splits.
    """
    dim = dimension if dimension_filter is None else dimension.where(dimension_filter)
    keys = dim.select(F.col(dimension_key).alias("__dim_key"))
    joined = fact.join(keys, fact[fact_key] == keys["__dim_key"], "left_semi")
    return joined
