"""A stored range-sum cube of behaviour counts, so Q2 needs no fact scan.

A cell holds the clicks, orders and pays of one category, of users of one age,
on all dates up to its own (prefix sums along the dates); ``*_upto`` adds all
lower ages (prefix sums along the ages).  Any date and age range is then four
corners of two dates: last day and the day before the first, highest age and
the one below the lowest.  Counts add, so a day is appended from the
day before it and its own actions; no other day is read or written again.

The cube is one folder a day.  A day has a row for each (age, category) seen so
far, whatever the number of actions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.config import FilterSpec
from clickscope.constants import TOP_CATEGORIES
from clickscope.operators.behavior import CATEGORY_IDS_SQL, KIND_SQL, count_behaviors, of_categories
from clickscope.operators.topk import top_k
from clickscope.plans.category import category_order
from clickscope.sources.tables import ClickstreamTables

COUNTS = ("click_count", "order_count", "pay_count")
#: Keys of an action without a date and of a user without an age; both sort
#: below every other, and no bound takes them in.
NO_DATE, NO_AGE = "0000-00-00", -(2**31)
_SCHEMA = (
    "age int, category_id long, click_count long, order_count long, pay_count long, "
    "click_count_upto long, order_count_upto long, pay_count_upto long, date string"
)


def _cells(tables: ClickstreamTables) -> DataFrame:
    """Counts of each (date, age, category) that occurs."""
    users = tables.users.selectExpr("userId as __user", f"coalesce(age, {NO_AGE}) as age")
    joined = tables.actions.join(users, F.col("user_id") == F.col("__user"))
    behaviors = joined.selectExpr(
        f"coalesce(date, '{NO_DATE}') as date", "age", f"{KIND_SQL} as kind", f"explode({CATEGORY_IDS_SQL}) as category_id"
    )
    return count_behaviors(behaviors, ["date", "age"])


def _sums(over: str, suffix: str = "") -> list[str]:
    return [f"sum({c}) over ({over}) as {c}{suffix}" for c in COUNTS]


def _with_lower_ages(by_age: DataFrame) -> DataFrame:
    return by_age.selectExpr("*", *_sums("partition by date, category_id order by age", "_upto"))


def _columns(df: DataFrame) -> DataFrame:
    return df.selectExpr("age", "category_id", *COUNTS, *[f"{c}_upto" for c in COUNTS], "date")


def build_cube(tables: ClickstreamTables, folder: str) -> None:
    """Write the cube of all days of ``tables`` to a new ``folder``."""
    cells = _cells(tables)
    # a row for each day there is: the calendar bounds it
    days = sorted(r["date"] for r in tables.actions.selectExpr(f"coalesce(date, '{NO_DATE}') as date").distinct().collect())
    listed = ", ".join(f"'{d}'" for d in days)
    keys = cells.groupBy("age", "category_id").agg(F.min("date").alias("since"))
    dense = keys.selectExpr("age", "category_id", "since", f"explode(cast(array({listed}) as array<string>)) as date")
    dense = dense.where("date >= since").drop("since")
    by_date = dense.join(cells, ["date", "age", "category_id"], "left").fillna(0, list(COUNTS))
    summed = by_date.selectExpr("date", "age", "category_id", *_sums("partition by age, category_id order by date"))
    _columns(_with_lower_ages(summed)).repartition("date").write.partitionBy("date").parquet(folder)


def read_cube(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(folder)


def cube_days(cube: DataFrame) -> list[str]:
    return sorted(r["date"] for r in cube.select("date").distinct().collect())


def append_day(tables: ClickstreamTables, folder: str, date: str) -> None:
    """Add ``date``, which has to come after every day of the cube, from that
    day's actions and the day before it."""
    spark = tables.actions.sparkSession
    cube = read_cube(spark, folder)
    days = cube_days(cube)
    if days and date <= days[-1]:
        raise ValueError(f"{date} does not come after {days[-1]}, the cube's last day")
    of_day = ClickstreamTables(tables.actions.where(F.col("date") == date), tables.users, tables.products, tables.cities)
    names = ("age", "category_id", *COUNTS)
    before = cube.where(F.col("date") == (days[-1] if days else "")).select(*names)
    summed = _cells(of_day).select(*names).unionByName(before).groupBy("age", "category_id").agg(
        *[F.sum(c).cast("long").alias(c) for c in COUNTS]
    )
    rows = _columns(_with_lower_ages(summed.withColumn("date", F.lit(date)))).drop("date")
    rows.write.mode("errorifexists").parquet(f"{folder}/date={date}")


def _last(days: Sequence[str], bound: str | None, inclusive: bool) -> str | None:
    """The last day up to (or, if not inclusive, before) ``bound``."""
    fit = [d for d in days if bound is None or d < bound or (inclusive and d == bound)]
    return fit[-1] if fit else None


def category_counts_from_cube(cube: DataFrame, spec: FilterSpec) -> DataFrame:
    """Clicks, orders and pays of every category that has any, for the
    spec's dates, ages and categories, from the cells of two days at most."""
    if spec.genders or spec.professionals or spec.city_ids or spec.keywords:
        raise ValueError("the cube has dates and ages only")
    days = cube_days(cube)
    upper = _last(days, spec.end_date, True)
    dated = spec.start_date is not None or spec.end_date is not None
    lower = _last(days, spec.start_date, False) if spec.start_date else _last(days, NO_DATE, True) if dated else None
    # ages below the range: all lower ones, or those without an age under any bound
    below = spec.start_age - 1 if spec.start_age is not None else NO_AGE if spec.end_age is not None else None
    corners = []
    for day, sign in ((upper, 1), (lower, -1)):
        for age, way in ((spec.end_age, sign), (below, -sign)):
            if day is None or (way != sign and below is None):
                continue
            at = cube.where(F.col("date") == day)
            if age is not None:
                at = at.where(F.col("age") <= age)
            corners.append(
                at.groupBy("category_id").agg(
                    *[F.expr(f"{way} * max_by({c}_upto, age) as {c}") for c in COUNTS]
                )
            )
    if not corners:
        corners = [cube.where("false").select("category_id", *COUNTS)]
    found = corners[0]
    for corner in corners[1:]:
        found = found.unionByName(corner)
    summed = found.groupBy("category_id").agg(*[F.sum(c).cast("long").alias(c) for c in COUNTS])
    return of_categories(summed.where(" or ".join(f"{c} > 0" for c in COUNTS)), spec.category_ids)


def category_top10_from_cube(cube: DataFrame, spec: FilterSpec, k: int = TOP_CATEGORIES) -> DataFrame:
    """Q2 for any date and age range, without the fact table."""
    return top_k(category_counts_from_cube(cube, spec), category_order(), k).select("category_id", *COUNTS)
