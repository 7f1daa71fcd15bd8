"""Explicit schemas of the four input tables and the three result tables."""

from __future__ import annotations

from pyspark.sql import types as T

# One row per user action.  Ids that do not apply are -1 (clicks) or null
# (comma lists).  ``action_seq`` is a unique, time-ordered tie-break: the
# timestamp has one-second resolution and several actions share a second.
USER_VISIT_ACTION = T.StructType(
    [
        T.StructField("date", T.StringType()),  # yyyy-MM-dd
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.StringType()),  # yyyy-MM-dd HH:mm:ss
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.LongType()),
        T.StructField("click_product_id", T.LongType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.LongType()),
        T.StructField("action_seq", T.LongType()),
    ]
)

USER_INFO = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("userName", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("professional", T.StringType()),
        T.StructField("gender", T.StringType()),
    ]
)

PRODUCT_INFO = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("extend_info", T.StringType()),
    ]
)

CITY_INFO = T.StructType(
    [
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("area", T.StringType()),
    ]
)

INPUT_SCHEMAS = {
    "user_visit_action": USER_VISIT_ACTION,
    "user_info": USER_INFO,
    "product_info": PRODUCT_INFO,
    "city_info": CITY_INFO,
}

# Result tables, each carrying the id of the run that produced it.
CATEGORY_TOP10 = T.StructType(
    [
        T.StructField("task_id", T.StringType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("click_count", T.LongType()),
        T.StructField("order_count", T.LongType()),
        T.StructField("pay_count", T.LongType()),
    ]
)

CATEGORY_SESSION_TOP10 = T.StructType(
    [
        T.StructField("task_id", T.StringType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("click_count", T.LongType()),
    ]
)

PAGE_JUMP_RATE = T.StructType(
    [
        T.StructField("task_id", T.StringType()),
        T.StructField("page_flow", T.StringType()),
        T.StructField("rate", T.DoubleType()),
    ]
)

RESULT_SCHEMAS = {
    "category_top10": CATEGORY_TOP10,
    "category_session_top10": CATEGORY_SESSION_TOP10,
    "page_jump_rate": PAGE_JUMP_RATE,
}
