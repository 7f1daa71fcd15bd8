"""The k largest counts of each group, without shuffling every count.

``groupBy(group, item).count()`` ships a partial count of every item in every
task, though k items of a group are wanted.  Three phases ship less:

1. Each task counts its own rows and keeps its k largest counts of each group.
   Their sums over tasks are at most the true counts, so the k-th largest of
   these sums is a lower bound of the k-th largest true count.
2. An item that reaches the bound has, in one of the ``m`` tasks that saw its
   group, at least an ``m``-th of it.  Items that have so much nowhere are
   out, and never leave their task.
3. The counts of the others, from all tasks, are summed and ranked.

The counts of phase 1 are stored, one row for each task, group and item, in the
session's checkpoint folder, which cuts the lineage too.  The result is exact
for any data; what is saved depends on it: with a few items far above the
rest nearly everything is cut, with counts all alike nothing is.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.operators.topk import top_k_per_group
from clickscope.session import ensure_checkpoint_dir

#: Distinct (group, item) pairs that a task counts at once; more are told in
#: several rows, which add up.
HELD = 1_000_000
_TASK, _COUNT = "__task", "__n"


def local_counts(rows: DataFrame, group: Sequence[str], item: str) -> DataFrame:
    """``group``, ``item``, ``__task`` and ``__n``: the counts inside each task, nothing shuffled."""
    keys = [*group, item]
    narrow = rows.select(*keys)
    schema = T.StructType([*narrow.schema.fields, T.StructField(_TASK, T.LongType()), T.StructField(_COUNT, T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def told(table: pa.Table) -> Iterator[pa.RecordBatch]:
            at = pa.array([task] * table.num_rows, pa.int64())
            out = table.select([*keys, _COUNT]).add_column(len(keys), _TASK, at)
            yield from out.combine_chunks().to_batches()

        held: pa.Table | None = None
        for batch in batches:
            counts = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
            counts = counts.rename_columns([*keys, _COUNT] if counts.column_names[0] == keys[0] else [_COUNT, *keys])
            counts = counts.select([*keys, _COUNT])
            if held is not None:
                both = pa.concat_tables([held, counts]).group_by(keys).aggregate([(_COUNT, "sum")])
                counts = both.rename_columns([_COUNT if c == f"{_COUNT}_sum" else c for c in both.column_names])
            held = counts.select([*keys, _COUNT])
            if held.num_rows >= HELD:
                yield from told(held)
                held = None
        if held is not None and held.num_rows:
            yield from told(held)

    return narrow.mapInArrow(count, schema)


def _stored(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/local-counts-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def surviving_counts(local: DataFrame, group: Sequence[str], item: str, k: int) -> DataFrame:
    """The stored local counts of the items that may be among their group's k largest."""
    # a task that told an item in several rows is one task
    in_task = local.where(f"{_COUNT} > 0")
    best = top_k_per_group(in_task, [*group, _TASK], [F.desc(_COUNT), F.asc(item)], k, "__place")
    sums = best.groupBy(*group, item).agg(F.sum(_COUNT).alias("__least"))
    kth = top_k_per_group(sums, list(group), [F.desc("__least"), F.asc(item)], k, "__place")
    bounds = kth.groupBy(*group).agg(F.expr(f"if(count(1) < {int(k)}, 0, min(__least)) as __bound"))
    # each row counts as a task of its own, so that several rows of one are safe
    tasks = in_task.groupBy(*group, _TASK, item).agg(F.count(F.lit(1)).alias("__rows"))
    seen = tasks.groupBy(*group, _TASK).agg(F.max("__rows").alias("__rows"))
    seen = seen.groupBy(*group).agg(F.sum("__rows").alias("__m"))
    limits = bounds.join(seen, list(group)).selectExpr(*[f"`{c}`" for c in group], "__bound", "__m")
    candidates = (
        in_task.join(limits, list(group))
        .where(f"{_COUNT} * __m >= __bound")
        .select(*group, item)
        .distinct()
    )
    return in_task.join(candidates, [*group, item], "left_semi")


def top_k_counts(
    rows: DataFrame,
    group: Sequence[str],
    item: str,
    k: int,
    order: Sequence[Column] | None = None,
    count_col: str = "count",
    rank_col: str = "rank",
) -> DataFrame:
    """``group, item, count, rank`` of the k most frequent items of each group.

    Ties go to the smaller item (or to ``order`` after the count).  Groups and
    items are not null: rows where one is null are left out.
    """
    wanted = rows.dropna(subset=[*group, item])
    local = _stored(local_counts(wanted, group, item))
    counts = surviving_counts(local, group, item, k).groupBy(*group, item).agg(F.sum(_COUNT).alias(count_col))
    ranked = top_k_per_group(counts, group, [F.desc(count_col), *(order or [F.asc(item)])], k, rank_col)
    return ranked.select(*group, item, count_col, rank_col)
