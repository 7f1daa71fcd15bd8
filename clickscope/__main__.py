"""Command line: run one of the four applications, or all of them.

    python -m clickscope all --tables /shared/clickstream \\
        --results /shared/results --start-date 2018-11-01 --end-date 2018-12-28 \\
        --start-age 20 --end-age 50 --flow 1,2,3,4,5,6,7

``--tables`` reads ``<dir>/<table>`` parquet folders, ``--catalog [DB]``
reads the session catalog, ``--driver-dir`` derives the tables from the
driver's test files.  Under ``spark-submit`` (with the package shipped via
``--py-files``) the session comes from the launcher; ``--master`` is for
local runs only.  Results go to a folder (``--results``) or to existing tables
of a database (``--jdbc-url``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from clickscope.config import FilterSpec
from clickscope.plans import apps
from clickscope.sinks.results import JdbcResultStore, ResultStore, new_task_id
from clickscope.sources.tables import ClickstreamTables

APPS = ("category-top10", "category-session-top10", "page-jump-rate", "area-top3", "all")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clickscope", description=__doc__.splitlines()[0])
    p.add_argument("app", choices=APPS)
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder with user_visit_action/, user_info/, ...")
    src.add_argument("--catalog", nargs="?", const="", help="read the tables from the catalog")
    src.add_argument("--driver-dir", help="derive the tables from driver test files")
    store = p.add_mutually_exclusive_group()
    store.add_argument("--results", help="result store folder")
    store.add_argument("--jdbc-url", help="database that holds the result tables")
    p.add_argument(
        "--jdbc-property", action="append", default=[], metavar="NAME=VALUE", help="user, password, driver, ..."
    )
    p.add_argument("--task-id", help="run id (default: a new UUID)")
    p.add_argument("--start-date")
    p.add_argument("--end-date")
    p.add_argument("--start-age")
    p.add_argument("--end-age")
    p.add_argument("--flow", default="", help="target page flow, e.g. 1,2,3,4,5,6,7")
    p.add_argument("--genders", default="", help="comma-separated; empty: all")
    p.add_argument("--professionals", default="", help="comma-separated; empty: all")
    p.add_argument("--cities", default="", help="comma-separated ids; empty: all")
    p.add_argument("--keywords", default="", help="comma-separated; empty: all")
    p.add_argument("--categories", default="", help="category jobs: comma-separated ids; empty: all")
    p.add_argument("--conditions", help="properties file with the job parameters (instead of the flags above)")
    p.add_argument("--output", help="area-top3 and all: write the area result as parquet here")
    p.add_argument("--show", type=int, default=20, help="rows to print of each result")
    p.add_argument("--master", help="local runs only, e.g. local[8]")
    return p


def _tables(spark: SparkSession, args: argparse.Namespace) -> ClickstreamTables:
    if args.tables:
        from clickscope.sources.tables import read_parquet_tables

        return read_parquet_tables(spark, args.tables)
    if args.driver_dir:
        from clickscope.sources.adapter import from_driver_tables

        return from_driver_tables(spark, args.driver_dir)
    from clickscope.sources.tables import read_catalog_tables

    return read_catalog_tables(spark, args.catalog or None)


def _builder(args: argparse.Namespace) -> SparkSession.Builder:
    builder = SparkSession.builder.appName(f"clickscope-{args.app}")
    if args.master:
        builder = builder.master(args.master)
    if args.catalog is not None:
        builder = builder.enableHiveSupport()
    return builder


def _spec(args: argparse.Namespace) -> FilterSpec:
    if args.conditions:
        with open(args.conditions, encoding="utf-8") as handle:
            return FilterSpec.from_properties(handle.read())
    return FilterSpec(
        start_date=args.start_date,
        end_date=args.end_date,
        start_age=args.start_age,
        end_age=args.end_age,
        target_page_flow=args.flow,
        genders=args.genders,
        professionals=args.professionals,
        city_ids=args.cities,
        keywords=args.keywords,
        category_ids=args.categories,
    )


def _area_spec(args: argparse.Namespace, spec: FilterSpec) -> FilterSpec | None:
    """The bounds that the area job takes; those on users it cannot honour."""
    if spec.start_age is not None or spec.end_age is not None or spec.genders or spec.professionals:
        if args.app == "area-top3":
            raise SystemExit("area-top3 reads no users: age, gender and professional bounds do not apply")
    return spec


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spec = _spec(args)
    if args.app != "area-top3" and not (args.results or args.jdbc_url):
        print("--results or --jdbc-url is required for this application", file=sys.stderr)
        return 2
    area_spec = _area_spec(args, spec)
    spark = _builder(args).getOrCreate()
    tables = _tables(spark, args)

    if args.app != "area-top3":
        properties = dict(p.split("=", 1) for p in args.jdbc_property)
        store = JdbcResultStore(args.jdbc_url, properties) if args.jdbc_url else ResultStore(args.results)
        task_id = args.task_id or new_task_id()
        runners = {
            "category-top10": [apps.run_category_top10],
            "category-session-top10": [apps.run_category_session_top10],
            "page-jump-rate": [apps.run_page_jump_rate],
            "all": [apps.run_category_top10, apps.run_category_session_top10, apps.run_page_jump_rate],
        }[args.app]
        for run in runners:
            run(tables, spec, store, task_id).show(args.show, truncate=False)
        print(f"task_id={task_id}")
    if args.app in ("area-top3", "all"):
        result = apps.run_area_top3(tables, area_spec)
        if args.output:
            result.write.mode("overwrite").parquet(args.output)
        result.orderBy("area", "area_rank", "city_id").show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
