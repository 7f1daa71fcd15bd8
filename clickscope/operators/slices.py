"""Cut hot groups of an ordered table into runs of neighbouring rows.

A window or a sort by group sends each group to one task.  That is fine for
most groups and wrong for one that holds a third of all rows.  Here a bounded
sample of the table finds the groups that are large *for this table and this
number of shuffle partitions*, and cuts each, at sampled rows, into slices of
consecutive rows in the group's order.  Other groups stay whole.

The sample is taken by hash: of the rows whose order key hashes to a
64th, one row for each of ``SAMPLES x partitions`` buckets.  So it is the same
in a task that runs again, and never larger than that, whatever the table's
size.  A group with ``HOT`` sampled rows or more holds about 1/(16 x partitions)
of the rows; each ``STEP``-th of its sampled rows begins a slice.  That bounds the
hot groups (``SAMPLES x partitions / HOT``) and the slices' bounds, so
both may be broadcast.  The sample decides only where the cuts are: results
built on slices hold for any cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sampled rows for each shuffle partition; of a hot group; of a slice.
SAMPLES, HOT, STEP = 256, 16, 8
#: One row of so many may enter the sample.
ONE_OF = 64


def _q(name: str) -> str:
    return f"`{name}`"


def hot_group_bounds(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``group`` and ``__bounds``, the ascending first order keys of a hot
    group's slices but the first (an array of structs)."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ", ".join(_q(c) for c in (*group, *order))
    sample = (
        df.selectExpr(f"xxhash64({keys}) as __hash", *map(_q, (*group, *order)))
        .where(f"pmod(__hash, {ONE_OF}) = 0")
        .groupBy(F.expr(f"pmod(div(__hash, {ONE_OF}), {SAMPLES * partitions}) as __bucket"))
        .agg(F.expr(f"min(struct(__hash, {keys})) as __row"))
        .select("__row.*")
    )
    found = sample.groupBy(*group).agg(
        F.expr(f"array_sort(collect_list(struct({', '.join(map(_q, order))}))) as __sampled")
    )
    return found.where(f"size(__sampled) >= {HOT}").selectExpr(
        *map(_q, group),
        f"array_distinct(transform(sequence({STEP}, size(__sampled) - 1, {STEP}), i -> __sampled[i])) as __bounds",
    )


def with_slices(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "__slice") -> DataFrame:
    """``df`` with the slice of each row: 0, 1, ... ascending with ``order``
    inside a hot group, null in any other group (nulls are one group)."""
    hot = hot_group_bounds(df, group, order)
    # the steps of a search by halving, the same for all rows of a group
    steps = "filter(transform(sequence(0, 30), s -> shiftleft(1, 30 - s)), s -> s <= size(__bounds))"
    renamed = hot.selectExpr(*[f"{_q(c)} as __hot_{i}" for i, c in enumerate(group)], "__bounds", f"{steps} as __steps")
    same = [df[c].eqNullSafe(renamed[f"__hot_{i}"]) for i, c in enumerate(group)]
    key = f"struct({', '.join(map(_q, order))})"
    # how many of the ascending bounds are at most the row's key
    found = f"aggregate(__steps, 0, (n, s) -> if(n + s <= size(__bounds) and __bounds[n + s - 1] <= {key}, n + s, n))"
    return df.join(F.broadcast(renamed), same, "left").selectExpr(
        *map(_q, df.columns), f"case when __bounds is not null then {found} end as {_q(name)}"
    )
