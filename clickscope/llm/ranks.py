"""Global positions of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import stored

#: monotonically_increasing_id: the partition above, the row in it below.
_ROW_BITS = 33


def ranked(df: DataFrame, order: Sequence[str], purpose: str, name: str = "rank") -> DataFrame:
    """``df`` with the 0-based position of each row in ascending order (nulls first).

    Rows are range partitioned and sorted, numbered in their partition, and
    stored; a partition starts where the counts of those before it end (one
    row for each partition).  Equal rows may follow each other in any order,
    so a number of their own keeps many of them from meeting in one partition.
    """
    loose = df.withColumn("__tie", F.monotonically_increasing_id())
    lined = loose.repartitionByRange(*order, "__tie").sortWithinPartitions(*order, "__tie")
    laid = stored(lined.drop("__tie").withColumn("__at", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("__at", _ROW_BITS)
    sizes = laid.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    row = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = laid.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return numbered.withColumn(name, F.col("__start") + row).drop("__part", "__at", "__start")
