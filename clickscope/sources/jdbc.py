"""Read a table over JDBC (the original read its results back from a database)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """``spark.read.jdbc`` with optional range-split parallel reads.

    Column types come from the database (no stringified rows).  A large
    table should be read with ``partition_column`` and bounds so the read
    is split over tasks instead of running as one query in one task.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("a partitioned JDBC read needs bounds and a partition count")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()
