"""Top-k, globally and per group, with a total order so ties are stable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k: ``orderBy(...).limit(k)``.

    Planned as ``TakeOrderedAndProject``: every task keeps its own k best
    rows and only those k x tasks rows meet in the final step, so the
    whole input is never sorted or gathered.
    """
    return df.orderBy(*order).limit(k)


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Per-group top-k via ``row_number() <= k``.

    Spark rewrites this filter into a ``WindowGroupLimit`` that also runs
    before the shuffle, so each task sends at most k rows per group: a
    group holding a third of all rows is cut down where it is read instead
    of being gathered into one task.  ``order`` must end in a unique key so
    that ties are broken the same way every run.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(window))
    kept = ranked.where(F.col(rank_col) <= F.lit(k))
    return kept.withColumn(rank_col, F.col(rank_col).cast("bigint"))
