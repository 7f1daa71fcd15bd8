"""Counts of consecutive pairs inside ordered groups, safe for very large groups.

The plain plan, ``lead(v) over (partition by g order by t)``, sends each group
to one task.  If one group (one session) holds a third of all rows, that task
sorts and scans a third of the data alone.  Here it is a segmented scan:

1. Hot groups are cut into slices of neighbouring rows (``operators.slices``);
   any other group is one run.  One hash shuffle on (group, slice), and
   ``lead`` inside a run gives each row's next value.
2. What a run says to its neighbours is its summary: its first value, its last
   value and its pair counts.  Counts of all runs add up, so they are summed
   at once, by position of the pair, in each task before they are shuffled;
   only a hot group's slices keep a row of first and last values.
3. Slices of one group that follow each other give the pairs that cross from
   one to the next.  This sees a row for each wanted pair and each slice,
   whose numbers are bounded by parameters, not by data.

Whether a pair is wanted is one lookup of its position in a hash set, so the
number of wanted pairs does not change the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.operators.slices import with_slices


def _q(name: str) -> str:
    return f"`{name}`"


def _is_wanted(pairs: Sequence[tuple[int, int]], a: str, b: str) -> str:
    """Whether columns ``a`` and ``b`` (integers) are one of ``pairs``, as one
    lookup in a hash set of positions: row of the first id, column of the second."""
    if not pairs:
        return "false"
    ids = [i for pair in pairs for i in pair]
    low, width = min(ids), max(ids) - min(ids) + 1
    if width**2 >= 1 << 63:  # ids too far apart for one position
        return f"coalesce(({a}, {b}) in ({', '.join(f'({x}L, {y}L)' for x, y in pairs)}), false)"
    inside = " and ".join(f"{c} between {low}L and {low + width - 1}L" for c in (a, b))
    places = ", ".join(f"{(x - low) * width + y - low}L" for x, y in pairs)
    return f"coalesce({inside} and ({a} - {low}L) * {width}L + {b} - {low}L in ({places}), false)"


def count_consecutive_pairs(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    pairs: Sequence[tuple[int, int]],
    from_col: str = "from_value",
    to_col: str = "to_value",
    count_col: str = "pair_count",
) -> DataFrame:
    """``(from_col, to_col, count_col)``: how often a value is followed by
    another inside a group, for the wanted ``pairs`` that occur.

    ``order`` must be unique within a group.  A null value is in no pair; rows
    whose group is null are one group.
    """
    wanted = list(dict.fromkeys((int(a), int(b)) for a, b in pairs))
    keys = [f"__g{i}" for i in range(len(group))]
    narrow = df.selectExpr(*map(_q, dict.fromkeys((*group, *order))), f"{_q(value)} as __value")
    by_run = f"over (partition by {', '.join(map(_q, group))}, __slice order by {', '.join(map(_q, order))})"
    runs = with_slices(narrow, group, order).selectExpr(
        *[f"{_q(c)} as {k}" for c, k in zip(group, keys)],
        "__slice",
        "__value",
        f"lead(__value) {by_run} as __next",
        f"__slice is not null and lag(1) {by_run} is null as __is_first",
        f"__slice is not null and lead(1) {by_run} is null as __is_last",
    )
    # A row of a summary is a counted pair, or an end of a hot group's slice.
    told = runs.withColumn("__counted", F.expr(_is_wanted(wanted, "__value", "__next")))
    told = told.where("__counted or __is_first or __is_last")
    told = told.withColumn("__end", F.explode(F.array(F.lit(False), F.lit(True)))).where(
        "if(__end, __is_first or __is_last, __counted)"
    )
    summaries = (
        told.selectExpr(
            "__end",
            "if(__end, null, __value) as __from",
            "if(__end, null, __next) as __to",
            *[f"if(__end, {c}, null) as {c}" for c in (*keys, "__slice")],
            "if(__end and __is_first, __value, null) as __first",
            "if(__end and __is_last, __value, null) as __last",
        )
        .groupBy("__end", "__from", "__to", *keys, "__slice")
        .agg(F.count(F.lit(1)).alias("__n"), F.max("__first").alias("__first"), F.max("__last").alias("__last"))
        .repartition(1)  # a row for each wanted pair and each slice
    )
    follower = f"lead(__first) over (partition by __end, {', '.join(keys)} order by __slice)"
    crossed = summaries.selectExpr(
        "if(__end, __last, __from) as __from",
        f"if(__end, {follower}, __to) as __to",
        "if(__end, 1L, __n) as __n",
    )
    return (
        crossed.where(_is_wanted(wanted, "__from", "__to"))
        .groupBy(F.col("__from").alias(from_col), F.col("__to").alias(to_col))
        .agg(F.expr("sum(__n)").alias(count_col))
    )
