"""Result stores, the apps that fill them, and table publishing."""

from __future__ import annotations

import tempfile

import pytest

from clickscope import plans
from clickscope.config import DRIVER_SPEC, REFERENCE_SPEC
from clickscope.plans import apps
from clickscope.sinks import ResultStore, as_result, drop_old_versions, new_task_id, preview, publish_table, with_task_id
from clickscope.sources import from_driver_tables
from tests.conftest import sf_dir


def test_append_and_read_back_by_task(spark, golden):
    store = ResultStore(tempfile.mkdtemp(prefix="clickscope-results-"))
    top = as_result("category_top10", plans.category_top10(plans.filtered_actions(golden, REFERENCE_SPEC)))
    assert top.count() == 4
    first, second = new_task_id(), new_task_id()
    store.append("category_top10", top, first)
    store.append("category_top10", top, second)
    assert store.read(spark, "category_top10").count() == 2 * top.count()
    back = store.read(spark, "category_top10", first)
    assert back.columns == ["task_id", "category_id", "click_count", "order_count", "pay_count"]
    assert {r.task_id for r in back.collect()} == {first}
    assert sorted(tuple(r)[1:] for r in back.collect()) == sorted(tuple(r) for r in top.collect())
    # re-running under the same id replaces that run only
    store.append("category_top10", top, first)
    assert store.read(spark, "category_top10", first).count() == top.count()
    assert store.read(spark, "category_top10").count() == 2 * top.count()


def test_rerun_without_rows_leaves_none(spark, golden):
    store = ResultStore(tempfile.mkdtemp(prefix="clickscope-results-"))
    top = as_result("category_top10", plans.category_top10(plans.filtered_actions(golden, REFERENCE_SPEC)))
    store.append("category_top10", top, "again")
    store.append("category_top10", top, "other")
    store.append("category_top10", top.where("false"), "again")
    assert store.read(spark, "category_top10", "again").count() == 0
    assert store.read(spark, "category_top10").count() == top.count()
    with pytest.raises(ValueError):
        store.append("category_top10", top, "../elsewhere")


def test_with_task_id_is_one_literal(spark, golden):
    df = with_task_id(golden.cities, "run-1")
    assert df.columns[0] == "task_id"
    assert {r.task_id for r in df.collect()} == {"run-1"}


def test_run_all_chains_through_the_store(spark):
    tables = from_driver_tables(spark, sf_dir("0.01"))
    store = ResultStore(tempfile.mkdtemp(prefix="clickscope-results-"))
    task = apps.run_all(tables, DRIVER_SPEC, store)
    top = store.read(spark, "category_top10", task)
    sessions = store.read(spark, "category_session_top10", task)
    rates = store.read(spark, "page_jump_rate", task)
    assert (top.count(), sessions.count(), rates.count()) == (10, 100, 6)
    assert sessions.columns == ["task_id", "category_id", "session_id", "click_count"]
    assert rates.columns == ["task_id", "page_flow", "rate"]
    # the stored sessions equal the direct plan's
    actions = plans.filtered_actions(tables, DRIVER_SPEC)
    direct = plans.category_session_top10(actions, plans.category_top10(actions))
    assert sorted(tuple(r)[1:] for r in sessions.collect()) == sorted(
        (r.category_id, r.session_id, r.click_count) for r in direct.collect()
    )
    # a second run appends under its own id and leaves the first intact
    apps.run_category_top10(tables, DRIVER_SPEC, store, "second")
    assert store.read(spark, "category_top10", task).count() == 10
    assert store.read(spark, "category_top10").count() == 20


def test_area_app_returns_shares(spark, golden):
    rows = apps.run_area_top3(golden).collect()
    assert len(rows) == 7


def test_publish_table_overwrites(spark, golden):
    publish_table(golden.cities, "clickscope_test_cities")
    publish_table(golden.cities.limit(2), "clickscope_test_cities")
    assert spark.table("clickscope_test_cities").count() == 2
    assert preview(golden.cities, 3).count() == 3


def test_cli_runs_all_apps(spark, capsys):
    from clickscope.__main__ import main

    root = tempfile.mkdtemp(prefix="clickscope-cli-")
    code = main([
        "all", "--driver-dir", sf_dir("0.001"), "--results", f"{root}/results",
        "--start-date", "2024-01-03", "--end-date", "2024-01-28",
        "--start-age", "20", "--end-age", "50", "--flow", "1,2,3,4,5,6,7",
        "--task-id", "cli-run", "--show", "1",
    ])
    assert code == 0
    store = ResultStore(f"{root}/results")
    assert store.read(spark, "category_top10", "cli-run").count() == 10
    assert store.read(spark, "page_jump_rate", "cli-run").count() == 3
    assert "area_rank" in capsys.readouterr().out
    assert main(["area-top3", "--driver-dir", sf_dir("0.001"), "--show", "1"]) == 0


def test_cli_area_job_takes_its_flags(spark):
    from clickscope.__main__ import main

    root = tempfile.mkdtemp(prefix="clickscope-cli-")
    args = ["area-top3", "--driver-dir", sf_dir("0.01"), "--show", "1"]
    assert main([*args, "--output", f"{root}/all"]) == 0
    assert main([*args, "--output", f"{root}/some", "--start-date", "2024-01-20", "--cities", "1,2,3"]) == 0
    total = spark.read.parquet(f"{root}/all").agg({"city_click_count": "sum"}).first()[0]
    some = spark.read.parquet(f"{root}/some")
    assert 0 < some.agg({"city_click_count": "sum"}).first()[0] < total
    assert {r.city_id for r in some.collect()} <= {1, 2, 3}
    with pytest.raises(SystemExit):
        main([*args, "--start-age", "20"])


def test_cli_list_flags_hive_and_jdbc(spark):
    from clickscope.__main__ import _builder, _parser, _spec, main

    args = _parser().parse_args(
        ["category-top10", "--catalog", "db", "--genders", "F", "--professionals", "a,b", "--cities", "1,2",
         "--keywords", "x", "--categories", "3", "--jdbc-url", "jdbc:none:x", "--jdbc-property", "user=me"]
    )
    spec = _spec(args)
    assert (spec.genders, spec.professionals, spec.city_ids) == (("F",), ("a", "b"), (1, 2))
    assert (spec.keywords, spec.category_ids) == (("x",), (3,))
    assert _builder(args)._options["spark.sql.catalogImplementation"] == "hive"
    # No database is started: the store is reached, and its failure is raised.
    with pytest.raises(Exception, match="(?i)driver"):
        main(["category-top10", "--driver-dir", sf_dir("0.001"), "--jdbc-url", "jdbc:none:x"])


def test_cli_reads_a_conditions_file(spark):
    from clickscope.__main__ import main

    root = tempfile.mkdtemp(prefix="clickscope-cli-")
    conditions = f"{root}/conditions.properties"
    with open(conditions, "w", encoding="utf-8") as handle:
        handle.write(
            'condition.params.json={startDate:"2024-01-03", endDate:"2024-01-28", '
            'startAge: "20", endAge: "50", targetPageFlow:"1,2,3,4,5,6,7"}\n'
        )
    code = main([
        "page-jump-rate", "--driver-dir", sf_dir("0.001"), "--results", f"{root}/results",
        "--conditions", conditions, "--task-id", "from-file", "--show", "1",
    ])
    assert code == 0
    assert ResultStore(f"{root}/results").read(spark, "page_jump_rate", "from-file").count() == 3


def test_jdbc_write_failure_raises(spark, golden):
    # No database is started: a URL no driver accepts must fail the write
    # loudly instead of being logged and dropped.
    from clickscope.sinks import JdbcResultStore

    store = JdbcResultStore("jdbc:clickscope-no-such-driver://nowhere/db")
    with pytest.raises(Exception):
        store.append("category_top10", golden.cities, "run")


def test_publish_to_catalog_and_read_back_by_name(spark, golden):
    from clickscope.config import REFERENCE_SPEC
    from clickscope.sources import read_catalog_tables
    from tests import golden as G

    spark.sql("CREATE DATABASE IF NOT EXISTS clickscope_testdb")
    for name, df in golden.as_dict().items():
        publish_table(df, f"clickscope_testdb.{name}")
    tables = read_catalog_tables(spark, "clickscope_testdb")
    rows = plans.category_top10(plans.filtered_actions(tables, REFERENCE_SPEC)).collect()
    assert [tuple(r) for r in rows] == G.TOP10


def test_a_write_that_fails_midway_leaves_the_old_run(spark, golden):
    store = ResultStore(tempfile.mkdtemp(prefix="clickscope-results-"))
    top = as_result("category_top10", plans.category_top10(plans.filtered_actions(golden, REFERENCE_SPEC)))
    store.append("category_top10", top, "run")
    want = sorted(tuple(r) for r in store.read(spark, "category_top10", "run").collect())
    # four tasks, of which one fails after others may have written
    broken = spark.range(0, 400, 1, 4).selectExpr(
        "id as category_id", "if(id = 399, assert_true(false), null) is null as ok", "id as click_count",
        "id as order_count", "id as pay_count",
    ).where("ok").drop("ok")
    with pytest.raises(Exception):
        store.append("category_top10", broken, "run")
    assert sorted(tuple(r) for r in store.read(spark, "category_top10", "run").collect()) == want
    # staged and never committed: whole, but not there
    store.stage("category_top10", top.limit(1), "run")
    store.stage("category_top10", top.limit(1), "never")
    assert sorted(tuple(r) for r in store.read(spark, "category_top10", "run").collect()) == want
    assert store.read(spark, "category_top10", "never").count() == 0
    assert store.read(spark, "category_top10").count() == len(want)
    assert store.prune(spark, "category_top10") >= 2
    assert sorted(tuple(r) for r in store.read(spark, "category_top10", "run").collect()) == want
    # two writers of one id: one of them is the run, never a mixture
    first = store.stage("category_top10", top.limit(1), "run")
    second = store.stage("category_top10", top.limit(3), "run")
    store.commit(spark, "category_top10", "run", second)
    store.commit(spark, "category_top10", "run", first)
    assert store.read(spark, "category_top10", "run").count() == 1


def test_publish_switches_and_a_failure_keeps_the_old_version(spark, golden):
    name = "clickscope_test_published"
    first = publish_table(golden.cities, name)
    reader = spark.table(name)
    broken = golden.cities.selectExpr("city_id", "city_name", "if(city_id = 4, raise_error('x'), area) as area")
    with pytest.raises(Exception):
        publish_table(broken, name)
    assert spark.table(name).count() == 4
    second = publish_table(golden.cities.limit(2).selectExpr("*", "1 as extra"), name)
    assert spark.table(name).count() == 2 and "extra" in spark.table(name).columns
    assert reader.count() == 4  # a reader that began before the switch
    assert drop_old_versions(spark, name, second) >= 1
    assert not spark.catalog.tableExists(first) and spark.table(name).count() == 2


def test_publish_over_a_plain_table_and_to_a_folder(spark, golden, tmp_path):
    golden.cities.write.saveAsTable("clickscope_test_plain")
    publish_table(golden.cities.limit(1), "clickscope_test_plain", ["area"], f"file://{tmp_path}/versions")
    assert spark.table("clickscope_test_plain").count() == 1
    assert len(list((tmp_path / "versions").iterdir())) == 1
