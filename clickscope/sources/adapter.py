"""Derive the four clickstream tables from the driver's test tables.

The driver ships TPC-H-like tables plus an ``events`` stream, not a
clickstream.  The mapping below turns them into the clickstream shape with
integer arithmetic only, so Spark and an independent SQL engine derive
identical rows (``__spark_entry__.oracle_sql`` holds the SQL twin).  Every
column is a projection of one input row, so the derivation runs inside the
scan's own tasks, whatever the input's size, and needs no shuffle.

Mapping (``k`` is the integer ``props.k`` of an event):

* ``action_seq`` = event_id; ``date`` / ``action_time`` = ts formatted
* ``session_id`` = user_id, "-", (day of month - 1) / 5 (integer division)
* ``page_id`` = k % 10 + 1
* ``search_keyword`` = "kw_" + k % 6 for ``error`` events
* clicks (``click``/``view``): category (id % 23) % 20 + 1,
  product (k*k + id % 7) % 60; everything else -1
* orders (``signup``): id % 19 + 1, then (id+5) % 19 + 1 when k % 3 >= 1,
  then (id+11) % 19 + 1 when k % 3 = 2, comma-joined
* pays (``purchase``): id % 17 + 1, then (id+4) % 17 + 1 when k % 2 = 1
* ``city_id`` = (id*3 + k) % 25
* users from ``customer`` (age = 10 + key % 50), products from ``part``,
  cities from ``nation`` joined to ``region`` (area = region name)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickscope import schemas
from clickscope.constants import DATE_FORMAT, TIME_FORMAT
from clickscope.sources.tables import ClickstreamTables

# Schemas of the driver's tables that the adapter reads.
# Declaring them skips a footer read per table per query.
DRIVER_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

# The derivation as SQL expressions: one projection, parsed once on the JVM.
_EVENT_BASE = (
    "event_id",
    "ts",
    "user_id",
    "event_type",
    "cast(get_json_object(props, '$.k') as bigint) as k",
    # "yyyy-MM-dd HH:mm:ss[.ffffff]" of a timestamp without time zone: its
    # first len(TIME_FORMAT) / len(DATE_FORMAT) characters are the
    # second-resolution time and the date.
    "cast(ts as string) as ts_text",
)

_ACTION_COLUMNS = (
    f"substring(ts_text, 1, {len(DATE_FORMAT)}) as date",
    "user_id",
    "concat(cast(user_id as string), '-', cast(floor((dayofmonth(ts) - 1) / 5) as string))"
    " as session_id",
    "k % 10 + 1 as page_id",
    f"substring(ts_text, 1, {len(TIME_FORMAT)}) as action_time",
    "case when event_type = 'error' then concat('kw_', cast(k % 6 as string)) end"
    " as search_keyword",
    "case when event_type in ('click', 'view') then (event_id % 23) % 20 + 1 else -1 end"
    " as click_category_id",
    "case when event_type in ('click', 'view') then (k * k + event_id % 7) % 60 else -1 end"
    " as click_product_id",
    "case when event_type = 'signup' then concat_ws(',', cast(event_id % 19 + 1 as string),"
    " case when k % 3 >= 1 then cast((event_id + 5) % 19 + 1 as string) end,"
    " case when k % 3 = 2 then cast((event_id + 11) % 19 + 1 as string) end) end"
    " as order_category_ids",
    "cast(null as string) as order_product_ids",
    "case when event_type = 'purchase' then concat_ws(',', cast(event_id % 17 + 1 as string),"
    " case when k % 2 = 1 then cast((event_id + 4) % 17 + 1 as string) end) end"
    " as pay_category_ids",
    "cast(null as string) as pay_product_ids",
    "(event_id * 3 + k) % 25 as city_id",
    "event_id as action_seq",
)


def actions_from_events(events: DataFrame) -> DataFrame:
    derived = events.selectExpr(*_EVENT_BASE).selectExpr(*_ACTION_COLUMNS)
    return derived.selectExpr(
        *[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in schemas.USER_VISIT_ACTION.fields]
    )


def users_from_customer(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "c_custkey as userId",
        "c_name as userName",
        "c_name as name",
        "cast(10 + c_custkey % 50 as int) as age",
        "c_mktsegment as professional",
        "case when c_custkey % 2 = 0 then 'F' else 'M' end as gender",
    )


def products_from_part(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey as product_id", "p_name as product_name", "p_type as extend_info"
    )


def cities_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "inner")
    return joined.selectExpr(
        "cast(n_nationkey as bigint) as city_id", "n_name as city_name", "r_name as area"
    )


def from_driver_tables(spark: SparkSession, sf_dir: str) -> ClickstreamTables:
    def read(name: str) -> DataFrame:
        return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    return ClickstreamTables(
        actions=actions_from_events(read("events")),
        users=users_from_customer(read("customer")),
        products=products_from_part(read("part")),
        cities=cities_from_nation(read("nation"), read("region")),
    )
