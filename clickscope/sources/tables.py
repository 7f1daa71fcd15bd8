"""Readers for the four clickstream tables (fact + three dimensions)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope import schemas


@dataclass(frozen=True)
class ClickstreamTables:
    """The inputs every job is built from.

    ``actions`` is the fact table (``user_visit_action``); ``users``,
    ``products`` and ``cities`` are dimensions keyed by ``userId``,
    ``product_id`` and ``city_id``.  Dimension keys are assumed unique, as a
    primary key would make them (``tests/test_sources.py`` checks it for the
    driver's tables).
    """

    actions: DataFrame
    users: DataFrame
    products: DataFrame
    cities: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "user_visit_action": self.actions,
            "user_info": self.users,
            "product_info": self.products,
            "city_info": self.cities,
        }

    def register_views(self, prefix: str = "") -> None:
        """Expose the tables to ``spark.sql`` under their original names."""
        for name, df in self.as_dict().items():
            df.createOrReplaceTempView(prefix + name)


def read_parquet_tables(spark: SparkSession, root: str) -> ClickstreamTables:
    """Read ``<root>/<table>`` parquet folders with the fixed schemas.

    An explicit schema means no inference pass over 100 TB of footers and a
    stable column order; Catalyst still prunes columns and pushes filters
    into each scan.
    """

    def read(name: str) -> DataFrame:
        schema = schemas.INPUT_SCHEMAS[name]
        df = spark.read.schema(schema).parquet(f"{root}/{name}")
        return df.select(*schema.fieldNames())  # partition columns back in place

    return ClickstreamTables(
        actions=read("user_visit_action"),
        users=read("user_info"),
        products=read("product_info"),
        cities=read("city_info"),
    )


def read_catalog_tables(
    spark: SparkSession, database: str | None = None, prefix: str = ""
) -> ClickstreamTables:
    """Read the four tables from the session catalog (Hive or other)."""

    def read(name: str) -> DataFrame:
        qualified = f"{database}.{prefix}{name}" if database else prefix + name
        return spark.table(qualified)

    return ClickstreamTables(
        actions=read("user_visit_action"),
        users=read("user_info"),
        products=read("product_info"),
        cities=read("city_info"),
    )


def write_parquet_tables(
    tables: ClickstreamTables, root: str, mode: str = "error", files: int | None = None, layout: str = "date"
) -> None:
    """Materialise the four tables as parquet folders under ``root``.

    ``layout`` is ``date``, or ``curve`` for :func:`along_curve`: one folder,
    in which filters on either users or times leave out row groups.

    In the first, the fact table is laid out by ``date`` so that date-range filters prune
    whole folders at read time.  Before the write it is range-partitioned on
    ``(date, session_id, action_time, action_seq)``: each task writes a
    contiguous slice of dates (few files per date), and a date holding a
    third of all actions is spread over many tasks instead of one.
    """
    if layout not in ("date", "curve"):
        raise ValueError(f"unknown layout {layout!r}")
    keys = ("date", "session_id", "action_time", "action_seq")
    if layout == "curve":
        along_curve(tables.actions, files).write.mode(mode).parquet(f"{root}/user_visit_action")
    elif files:
        _by_date(tables.actions.repartitionByRange(files, *keys), root, mode)
    else:
        # adaptive execution merges adjacent small ranges up to the advisory
        # partition size, so file sizes follow the data
        _by_date(tables.actions.repartitionByRange(*keys), root, mode)
    tables.users.write.mode(mode).parquet(f"{root}/user_info")
    tables.products.write.mode(mode).parquet(f"{root}/product_info")
    tables.cities.write.mode(mode).parquet(f"{root}/city_info")


def _by_date(actions: DataFrame, root: str, mode: str) -> None:
    actions.write.mode(mode).partitionBy("date").parquet(f"{root}/user_visit_action")


#: Bits of each of the two interleaved positions.
_CURVE_BITS = 16


def along_curve(actions: DataFrame, files: int | None = None) -> DataFrame:
    """``actions`` in the order of a space-filling curve over users and times.

    Positions of the user id and the time inside their ranges, 16 bits each, are
    interleaved bit by bit; rows near each other on the curve are near in both,
    so the row groups of the files written from it have narrow statistics of
    ``user_id``, ``date`` and ``action_time`` alike, and a range of any of them
    skips groups.  One aggregate finds the ranges; a position that a third of all
    rows share is spread by the rest of the sort key.
    """
    seconds = "unix_timestamp(try_to_timestamp(action_time))"
    ends = actions.selectExpr(
        "min(user_id) as u0", "max(user_id) as u1", f"min({seconds}) as t0", f"max({seconds}) as t1"
    ).first()  # one row

    def place(value: str, low: int | None, high: int | None) -> str:
        top = (1 << _CURVE_BITS) - 1
        span = max(1, (high or 0) - (low or 0))
        return f"cast(coalesce(({value} - {low or 0}L) / {span}D * {top}, 0) as bigint)"

    at = actions.selectExpr(
        "*", f"{place('user_id', ends.u0, ends.u1)} as __u", f"{place(seconds, ends.t0, ends.t1)} as __t"
    )
    step = at
    for name in ("__u", "__t"):
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            step = step.withColumn(name, F.expr(f"({name} | shiftleft({name}, {shift})) & {mask}L"))
    curve = step.withColumn("__curve", F.expr("shiftleft(__u, 1) | __t")).drop("__u", "__t")
    keys = ("__curve", "user_id", "action_time", "action_seq")
    dealt = curve.repartitionByRange(files, *keys) if files else curve.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys).drop("__curve")


def write_bucketed_tables(
    tables: ClickstreamTables, database: str, buckets: int, location: str | None = None
) -> ClickstreamTables:
    """Store actions and users in the catalog, both in ``buckets`` of the user id, sorted by it.

    The join of actions to users then meets bucket by bucket where the files
    are: neither side is shuffled or sorted, however large the users.  A bucket
    is one task of that join, so for a user with a large part of all actions the
    plain layout is the better one: there adaptive execution splits the user's
    rows.  ``location`` is a folder for the tables (default: the
    warehouse).  Returns the four tables, the small two as they were.
    """
    spark = tables.actions.sparkSession

    def write(df: DataFrame, name: str, key: str) -> DataFrame:
        # one file for each bucket, so that each is sorted as a whole
        writer = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
        if location is not None:
            writer = writer.option("path", f"{location.rstrip('/')}/{name}")
        writer.saveAsTable(f"{database}.{name}")
        return spark.table(f"{database}.{name}")

    return ClickstreamTables(
        actions=write(tables.actions, "user_visit_action", "user_id"),
        users=write(tables.users, "user_info", "userId"),
        products=tables.products,
        cities=tables.cities,
    )
