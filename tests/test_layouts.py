"""Stored layouts: buckets that join in place, the curve that prunes on users and times; SQL text."""

from __future__ import annotations

import glob
import re

import pyarrow.parquet as pq
import pytest

from clickscope import plans
from clickscope.config import DRIVER_SPEC, REFERENCE_SPEC, FilterSpec
from clickscope.plans import sql_text
from clickscope.sources import (
    from_driver_tables,
    read_parquet_tables,
    write_bucketed_tables,
    write_parquet_tables,
)
from tests import golden as G
from tests.conftest import sf_dir
from tests.test_skew import conf


def rows(df):
    return sorted(map(str, df.collect()))


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    t = from_driver_tables(spark, sf_dir("0.01"))
    spark.sql("CREATE DATABASE IF NOT EXISTS clickscope_buckets")
    stored = write_bucketed_tables(t, "clickscope_buckets", 6, str(tmp_path))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with conf(spark, off):
        df = plans.filtered_actions(stored, DRIVER_SPEC)
        got = rows(df)
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text and "Bucketed: true" in text
        shuffled = plans.filtered_actions(t, DRIVER_SPEC)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in shuffled
    assert got == rows(plans.filtered_actions(t, DRIVER_SPEC))
    assert [r.category_id for r in plans.category_top10(plans.filtered_actions(stored, DRIVER_SPEC)).collect()] == [
        r.category_id for r in plans.category_top10(plans.filtered_actions(t, DRIVER_SPEC)).collect()
    ]


def overlapping(folder, column, low, high):
    """Row groups whose statistics meet [low, high], and all row groups."""
    meet = total = 0
    for path in glob.glob(f"{folder}/user_visit_action/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            meet += stats.min <= high and stats.max >= low
    return meet, total


def test_curve_prunes_on_users_and_on_times(spark, tmp_path):
    t = from_driver_tables(spark, sf_dir("0.1"))
    write_parquet_tables(t, str(tmp_path / "curve"), files=64, layout="curve")
    write_parquet_tables(t, str(tmp_path / "date"))
    users = t.actions.selectExpr("min(user_id) as lo", "max(user_id) as hi").first()
    eighth = users.lo + (users.hi - users.lo) // 8
    by_user = overlapping(tmp_path / "curve", "user_id", users.lo, eighth)
    by_time = overlapping(tmp_path / "curve", "action_time", "2024-01-05 00:00:00", "2024-01-08 23:59:59")
    by_date = overlapping(tmp_path / "curve", "date", "2024-01-05", "2024-01-08")
    assert by_user[1] >= 60
    for meet, total in (by_user, by_time, by_date):
        assert meet * 2 <= total, (by_user, by_time, by_date)  # eight by eight cells; the ranges touch three columns
    # laid out by date, no row group can be left out for its users
    meet, total = overlapping(tmp_path / "date", "user_id", users.lo, eighth)
    assert meet == total
    stored = read_parquet_tables(spark, str(tmp_path / "curve"))
    assert stored.actions.count() == t.actions.count() and stored.actions.columns == t.actions.columns
    assert rows(plans.category_top10(plans.filtered_actions(stored, DRIVER_SPEC))) == rows(
        plans.category_top10(plans.filtered_actions(t, DRIVER_SPEC))
    )


def test_curve_of_odd_tables(spark, golden, tmp_path):
    from clickscope.sources.tables import ClickstreamTables

    null_keys = golden.actions.selectExpr(
        "date", "if(action_seq = 3, null, user_id) as user_id",
        *[c for c in golden.actions.columns if c not in ("date", "user_id", "action_time", "action_seq", "session_id")],
        "if(action_seq = 4, null, action_time) as action_time", "action_seq", "session_id",
    ).select(golden.actions.columns)
    one = golden.actions.where("action_seq = 1")
    for k, actions in enumerate((null_keys, one, one.where("false"))):
        folder = str(tmp_path / f"t{k}")
        write_parquet_tables(ClickstreamTables(actions, golden.users, golden.products, golden.cities), folder, layout="curve")
        assert rows(read_parquet_tables(spark, folder).actions) == rows(actions)
    with pytest.raises(ValueError):
        write_parquet_tables(golden, str(tmp_path / "x"), layout="spiral")


def _optimized(df):
    """The optimized plan without expression ids, columns of a projection in one order."""
    text = re.sub(r"#\d+L?", "", df._jdf.queryExecution().optimizedPlan().toString())
    return re.sub(r"Project \[(.*)\]", lambda m: f"Project {sorted(m[1].split(', '))}", text)


def _same_optimized(a, b):
    return _optimized(a) == _optimized(b)


def test_sql_text_has_the_plan_of_the_dataframe(spark, golden):
    views = {v.name for v in spark.catalog.listTables()}
    for spec in (REFERENCE_SPEC, FilterSpec(), FilterSpec(start_age=20), FilterSpec(end_date="2018-12-01")):
        by_text = sql_text.run_text(golden, sql_text.filtered_actions_text, spec)
        by_frame = plans.filtered_actions(golden, spec)
        assert _same_optimized(by_text, by_frame), spec
        assert rows(by_text) == rows(by_frame)
    assert _same_optimized(
        sql_text.run_text(golden, sql_text.area_product_city_rows_text), plans.area_product_city_rows(golden)
    )
    listed = FilterSpec(genders=("F",), city_ids=(1, 3), professionals=("prof", "x' or '1'='1"))
    assert rows(sql_text.run_text(golden, sql_text.filtered_actions_text, listed)) == rows(plans.filtered_actions(golden, listed))
    assert {v.name for v in spark.catalog.listTables()} == views
    assert len(G.FILTERED_SEQ) == sql_text.run_text(golden, sql_text.filtered_actions_text, REFERENCE_SPEC).count()


def test_values_never_become_text():
    text, args = sql_text.filtered_actions_text(FilterSpec(genders=("F' or 1=1 --",), start_age=20))
    assert "1=1" not in text and "20" not in text
    assert args == {"genders": ["F' or 1=1 --"], "start_age": 20}
