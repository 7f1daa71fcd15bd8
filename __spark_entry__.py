"""

``entry(spark)`` runs the flagship job (category top 10) on sf0.001.
``queries()`` builds every job of the library on the driver's tables;
``oracle_sql()`` gives, for each, an independent DuckDB query over the same
parquet views.  Both sides derive the clickstream tables from the driver's
``events`` / ``customer`` / ``part`` / ``nation`` / ``region`` tables with
the same integer arithmetic (see ``clickscope/sources/adapter.py``).
"""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession

from clickscope import plans
from clickscope.config import DRIVER_SPEC, PARAMS_KEY, FilterSpec
from clickscope.plans import apps, sql_text
from clickscope.session import ensure_checkpoint_dir
from clickscope.sinks.results import ResultStore, as_result, preview, publish_table, with_task_id
from clickscope.sources.adapter import from_driver_tables
from clickscope.sources.tables import (
    ClickstreamTables,
    read_parquet_tables,
    write_bucketed_tables,
    write_parquet_tables,
)



def _optional(name: str) -> ModuleType | None:
    """A module of the optional training-data part; None only if that part is not there."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as gone:
        if gone.name in ("clickscope.llm", "clickscope.llm.queries", "corpus_pipeline"):
            return None
        raise


_llm = _optional("clickscope.llm.queries")
_pipeline = _optional("corpus_pipeline")

SMOKE_DIR = "/root/testdata/sf0.001"
SPEC: FilterSpec = DRIVER_SPEC
#: No bound at all (F5), and every optional list that the category jobs take (F14).
UNBOUNDED = FilterSpec()
LISTED = FilterSpec(
    start_date=DRIVER_SPEC.start_date,
    end_date=DRIVER_SPEC.end_date,
    genders=("F",),
    professionals=("BUILDING", "MACHINERY"),
    city_ids=tuple(range(0, 25, 2)),
    category_ids=(1, 2, 3, 5, 8, 13, 17),
)
#: Searches match no click, so the keyword list is registered on the rows themselves.
SEARCHED = FilterSpec(keywords=("kw_1", "kw_4"), start_age=20)
TASK = "registered"
#: The parameters of ``SPEC`` as a properties file has them (S16).
PROPERTIES = (
    f'{PARAMS_KEY}={{startDate:"{SPEC.start_date}", endDate:"{SPEC.end_date}", '
    f'startAge: "{SPEC.start_age}", endAge: "{SPEC.end_age}", \\\n'
    f'targetPageFlow:"{",".join(map(str, SPEC.target_page_flow))}"}}\n'
)
BUCKETS = 8

TablesOf = Callable[[SparkSession, str], ClickstreamTables]


def entry(spark: SparkSession) -> DataFrame:
    return clickstream_queries()["category_top10"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = clickstream_queries()
    if _llm is not None:
        found.update(_llm.queries())
    if _pipeline is not None:
        found["pipeline"] = _pipeline.run
    return found


def clickstream_queries(tables: TablesOf = from_driver_tables) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The clickstream jobs; by default the tables are derived inside each query."""

    def filtered(s: SparkSession, d: str, spec: FilterSpec = SPEC) -> DataFrame:
        return plans.filtered_actions(tables(s, d), spec)

    def top10(s: SparkSession, d: str) -> DataFrame:
        return plans.category_top10(filtered(s, d))

    def session_top10(s: SparkSession, d: str) -> DataFrame:
        actions = filtered(s, d)
        return plans.category_session_top10(actions, plans.category_top10(actions))

    def session_counts(s: SparkSession, d: str) -> DataFrame:
        actions = filtered(s, d)
        return plans.category_session_counts(actions, plans.category_top10(actions))

    def jump_rate(s: SparkSession, d: str) -> DataFrame:
        return plans.page_jump_rate(filtered(s, d), SPEC)

    def saved(name: str, job: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda s, d: with_task_id(as_result(name, job(s, d)), TASK)

    def folder(s: SparkSession, purpose: str) -> str:
        """A new folder name under the session's shared folder."""
        return f"{ensure_checkpoint_dir(s).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

    def top10_cube(s: SparkSession, d: str) -> DataFrame:
        """A3: the cube is stored, then answers the spec's range without the fact table."""
        at = folder(s, "cube")
        plans.build_cube(tables(s, d), at)
        return plans.category_top10_from_cube(plans.read_cube(s, at), SPEC)

    def session_top10_threshold(s: SparkSession, d: str) -> DataFrame:
        actions = filtered(s, d)
        return plans.category_session_top10_by_threshold(actions, plans.category_top10(actions))

    def bucketed(s: SparkSession, d: str) -> DataFrame:
        """J1 on tables bucketed by user, in a database of this call."""
        name, at = f"clickscope_{uuid.uuid4().hex[:12]}", folder(s, "buckets")
        s.sql(f"CREATE DATABASE {name} LOCATION '{at}'")
        return plans.filtered_actions(write_bucketed_tables(tables(s, d), name, BUCKETS, at), SPEC)

    def along_the_curve(s: SparkSession, d: str) -> DataFrame:
        at = folder(s, "curve")
        write_parquet_tables(tables(s, d), at, layout="curve")
        return plans.filtered_actions(read_parquet_tables(s, at), SPEC)

    def published(s: SparkSession, d: str) -> DataFrame:
        """Q13: publish a first version, switch to the second, and preview what readers see."""
        name, at = f"clickscope_{uuid.uuid4().hex[:12]}", folder(s, "published")
        top = plans.area_product_top3(tables(s, d))
        publish_table(top.where("area_rank = 1"), name, location=at)
        publish_table(top, name, location=at)
        return preview(s.table(name))

    def stored_run(s: SparkSession, d: str) -> DataFrame:
        """S16, Q12, S6, F13: the spec of a properties text, two runs in one store, one read back by its id."""
        store, t = ResultStore(folder(s, "results")), tables(s, d)
        apps.run_category_top10(t, UNBOUNDED, store, "another")
        return apps.run_category_top10(t, FilterSpec.from_properties(PROPERTIES), store, TASK)

    return {
        "filtered_actions": filtered,
        "filtered_actions_unbounded": lambda s, d: filtered(s, d, UNBOUNDED),
        "filtered_actions_searched": lambda s, d: filtered(s, d, SEARCHED),
        "category_behavior_counts": lambda s, d: plans.category_behavior_counts(filtered(s, d)),
        "category_top10": top10,
        "category_top10_listed": lambda s, d: plans.category_top10(
            filtered(s, d, LISTED), categories=LISTED.category_ids
        ),
        "category_session_counts": session_counts,
        "category_session_top10": session_top10,
        "page_visit_counts": lambda s, d: plans.page_visit_counts(filtered(s, d), SPEC),
        "page_jump_counts": lambda s, d: plans.page_jump_counts(filtered(s, d), SPEC),
        "page_jump_rate": jump_rate,
        "area_product_city_rows": lambda s, d: plans.area_product_city_rows(tables(s, d)),
        "area_product_clicks": lambda s, d: plans.area_product_clicks(tables(s, d)),
        "area_product_top3": lambda s, d: plans.area_product_top3(tables(s, d)),
        "area_product_city_clicks": lambda s, d: plans.area_product_city_clicks(tables(s, d)),
        "area_city_share": lambda s, d: plans.area_city_share(tables(s, d)),
        "category_top10_result": saved("category_top10", top10),
        "category_session_top10_result": saved("category_session_top10", session_top10),
        "page_jump_rate_result": saved("page_jump_rate", jump_rate),
        "category_top10_cube": top10_cube,
        "category_session_top10_threshold": session_top10_threshold,
        "filtered_actions_bucketed": bucketed,
        "filtered_actions_curve": along_the_curve,
        "filtered_actions_sql": lambda s, d: sql_text.run_text(tables(s, d), sql_text.filtered_actions_text, SPEC),
        "area_product_city_rows_sql": lambda s, d: sql_text.run_text(tables(s, d), sql_text.area_product_city_rows_text),
        "area_product_top3_published": published,
        "category_top10_stored": stored_run,
    }


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB).  The views below rebuild the clickstream tables from
# the driver's tables; each query is then plain SQL over them.
# ---------------------------------------------------------------------------


def _sql_list(values: tuple[int, ...]) -> str:
    return ", ".join(str(v) for v in dict.fromkeys(values))


def _jump_predicate(spec: FilterSpec) -> str:
    pairs = list(dict.fromkeys(spec.jump_pairs))
    if not pairs:
        return "FALSE"
    return " OR ".join(f"(from_page_id = {a} AND to_page_id = {b})" for a, b in pairs)


def _where(spec: FilterSpec) -> str:
    """The bounds and lists of a spec over actions ``t`` and users ``u``."""

    def listed(column: str, values: tuple) -> str:
        return f"{column} IN ({', '.join(repr(v) for v in values)})" if values else ""

    terms = [
        f"t.date >= '{spec.start_date}'" if spec.start_date else "",
        f"t.date <= '{spec.end_date}'" if spec.end_date else "",
        f"u.age >= {spec.start_age}" if spec.start_age is not None else "",
        f"u.age <= {spec.end_age}" if spec.end_age is not None else "",
        listed("u.professional", spec.professionals),
        listed("u.gender", spec.genders),
        listed("t.city_id", spec.city_ids),
        listed("t.search_keyword", spec.keywords),
    ]
    return " AND ".join(["1 = 1", *filter(None, terms)])


def _views(spec: FilterSpec) -> str:
    return f"""
WITH ev AS (
    SELECT event_id, ts, user_id, event_type,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events
),
user_visit_action AS (
    SELECT
        strftime(ts, '%Y-%m-%d') AS date,
        CAST(user_id AS BIGINT) AS user_id,
        CAST(user_id AS VARCHAR) || '-' || CAST(CAST(floor((day(ts) - 1) / 5) AS BIGINT) AS VARCHAR)
            AS session_id,
        CAST(k % 10 + 1 AS BIGINT) AS page_id,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
        CASE WHEN event_type = 'error' THEN 'kw_' || CAST(k % 6 AS VARCHAR) END AS search_keyword,
        CAST(CASE WHEN event_type IN ('click', 'view') THEN (event_id % 23) % 20 + 1 ELSE -1 END
             AS BIGINT) AS click_category_id,
        CAST(CASE WHEN event_type IN ('click', 'view') THEN (k * k + event_id % 7) % 60 ELSE -1 END
             AS BIGINT) AS click_product_id,
        CASE WHEN event_type = 'signup' THEN concat_ws(',',
                CAST(event_id % 19 + 1 AS VARCHAR),
                CASE WHEN k % 3 >= 1 THEN CAST((event_id + 5) % 19 + 1 AS VARCHAR) END,
                CASE WHEN k % 3 = 2 THEN CAST((event_id + 11) % 19 + 1 AS VARCHAR) END)
        END AS order_category_ids,
        CAST(NULL AS VARCHAR) AS order_product_ids,
        CASE WHEN event_type = 'purchase' THEN concat_ws(',',
                CAST(event_id % 17 + 1 AS VARCHAR),
                CASE WHEN k % 2 = 1 THEN CAST((event_id + 4) % 17 + 1 AS VARCHAR) END)
        END AS pay_category_ids,
        CAST(NULL AS VARCHAR) AS pay_product_ids,
        CAST((event_id * 3 + k) % 25 AS BIGINT) AS city_id,
        CAST(event_id AS BIGINT) AS action_seq
    FROM ev
),
user_info AS (
    SELECT CAST(c_custkey AS BIGINT) AS userId, c_name AS userName, c_name AS name,
           CAST(10 + c_custkey % 50 AS INTEGER) AS age, c_mktsegment AS professional,
           CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
    FROM customer
),
product_info AS (
    SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_name, p_type AS extend_info
    FROM part
),
city_info AS (
    SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
filtered AS (
    SELECT t.*
    FROM user_visit_action t JOIN user_info u ON u.userId = t.user_id
    WHERE {_where(spec)}
),
every_behavior AS (
    SELECT 'click' AS kind, click_category_id AS category_id
    FROM filtered WHERE click_category_id <> -1
    UNION ALL
    SELECT 'order' AS kind, CAST(x AS BIGINT) AS category_id
    FROM (SELECT unnest(string_split(order_category_ids, ',')) AS x
          FROM filtered WHERE click_category_id = -1 AND order_category_ids IS NOT NULL)
    WHERE x <> ''
    UNION ALL
    SELECT 'pay' AS kind, CAST(x AS BIGINT) AS category_id
    FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS x
          FROM filtered WHERE click_category_id = -1 AND order_category_ids IS NULL
                          AND pay_category_ids IS NOT NULL)
    WHERE x <> ''
),
behavior AS (
    SELECT * FROM every_behavior
    WHERE {f"category_id IN ({_sql_list(spec.category_ids)})" if spec.category_ids else "1 = 1"}
),
category_counts AS (
    SELECT category_id,
           count(*) FILTER (WHERE kind = 'click') AS click_count,
           count(*) FILTER (WHERE kind = 'order') AS order_count,
           count(*) FILTER (WHERE kind = 'pay') AS pay_count
    FROM behavior GROUP BY category_id
),
top10 AS (
    SELECT * FROM category_counts
    ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id ASC
    LIMIT 10
),
session_counts AS (
    SELECT click_category_id AS category_id, session_id, count(*) AS click_count
    FROM filtered
    WHERE click_category_id IN (SELECT category_id FROM top10)
    GROUP BY click_category_id, session_id
),
jumps AS (
    SELECT from_page_id, to_page_id, count(*) AS jump_count
    FROM (
        SELECT page_id AS from_page_id,
               lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_seq)
                   AS to_page_id
        FROM filtered WHERE click_product_id <> -1
    )
    WHERE {_jump_predicate(spec)}
    GROUP BY from_page_id, to_page_id
),
visits AS (
    SELECT page_id, count(*) AS visit_count
    FROM filtered WHERE page_id IN ({_sql_list(spec.target_page_flow)})
    GROUP BY page_id
),
area_rows AS (
    SELECT p.product_id, p.product_name, c.city_id, c.city_name, c.area
    FROM user_visit_action t
    JOIN city_info c ON t.city_id = c.city_id
    JOIN product_info p ON p.product_id = t.click_product_id
),
area_city AS (
    SELECT area, product_id, product_name, city_id, city_name, count(*) AS click_count
    FROM area_rows GROUP BY area, product_id, product_name, city_id, city_name
),
area_product AS (
    SELECT area, product_id, product_name, count(*) AS click_count
    FROM area_rows GROUP BY area, product_id, product_name
),
area_top AS (
    SELECT * FROM (
        SELECT area, CAST(row_number() OVER (PARTITION BY area
                          ORDER BY click_count DESC, product_id ASC) AS BIGINT) AS area_rank,
               product_id, product_name, click_count
        FROM area_product
    ) WHERE area_rank <= 3
)
"""


_SESSION_TOP10 = """
SELECT category_id, session_id, click_count, session_rank FROM (
    SELECT category_id, session_id, click_count,
           CAST(row_number() OVER (PARTITION BY category_id
                                   ORDER BY click_count DESC, session_id ASC) AS BIGINT)
               AS session_rank
    FROM session_counts
) WHERE session_rank <= 10"""

_JUMP_RATE = """
SELECT j.from_page_id, j.to_page_id,
       CAST(j.from_page_id AS VARCHAR) || '-' || CAST(j.to_page_id AS VARCHAR) AS page_flow,
       j.jump_count,
       coalesce(v.visit_count, 1) AS visit_count,
       CAST(j.jump_count AS DOUBLE) / coalesce(v.visit_count, 1) AS rate
FROM jumps j LEFT JOIN visits v ON j.from_page_id = v.page_id"""


def _oracle_bodies() -> dict[str, str]:
    return {
        "filtered_actions": "SELECT * FROM filtered",
        "category_behavior_counts": "SELECT * FROM category_counts",
        "category_top10": "SELECT * FROM top10",
        "category_session_counts": "SELECT * FROM session_counts",
        "category_session_top10": _SESSION_TOP10,
        "page_visit_counts": "SELECT * FROM visits",
        "page_jump_counts": "SELECT * FROM jumps",
        "page_jump_rate": _JUMP_RATE,
        "area_product_city_rows": "SELECT * FROM area_rows",
        "area_product_clicks": "SELECT * FROM area_product",
        "area_product_top3": "SELECT * FROM area_top",
        "area_product_city_clicks": "SELECT * FROM area_city",
        "area_city_share": """
SELECT c.area, t.area_rank, c.product_id, c.product_name,
       t.click_count AS product_click_count,
       c.city_id, c.city_name, c.click_count AS city_click_count,
       CAST(c.click_count AS DOUBLE) / t.click_count AS city_share
FROM area_city c JOIN area_top t ON c.area = t.area AND c.product_id = t.product_id""",
        "category_top10_result": f"SELECT '{TASK}' AS task_id, category_id, click_count, order_count, pay_count FROM top10",
        "category_session_top10_result": f"""
SELECT '{TASK}' AS task_id, category_id, session_id, click_count FROM ({_SESSION_TOP10})""",
        "page_jump_rate_result": f"SELECT '{TASK}' AS task_id, page_flow, rate FROM ({_JUMP_RATE})",
        "category_top10_cube": "SELECT * FROM top10",
        "category_session_top10_threshold": _SESSION_TOP10,
        "filtered_actions_bucketed": "SELECT * FROM filtered",
        "filtered_actions_curve": "SELECT * FROM filtered",
        "filtered_actions_sql": "SELECT * FROM filtered",
        "area_product_city_rows_sql": "SELECT * FROM area_rows",
        "area_product_top3_published": "SELECT * FROM area_top",
        "category_top10_stored": f"SELECT '{TASK}' AS task_id, category_id, click_count, order_count, pay_count FROM top10",
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express (same column names)."""
    views = _views(SPEC)
    found = {name: views + body for name, body in _oracle_bodies().items()}
    found["filtered_actions_unbounded"] = _views(UNBOUNDED) + "SELECT * FROM filtered"
    found["filtered_actions_searched"] = _views(SEARCHED) + "SELECT * FROM filtered"
    found["category_top10_listed"] = _views(LISTED) + "SELECT * FROM top10"
    if _llm is not None:
        found.update(_llm.oracle_sql())
    if _pipeline is not None and _pipeline.ORACLE_SQL is not None:
        found["pipeline"] = _pipeline.ORACLE_SQL
    return found
