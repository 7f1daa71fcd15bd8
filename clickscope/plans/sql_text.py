"""Q1 and Q7 as SQL text over the tables' views, bounds bound as typed values.

The original built its text from the parameters.  Here the text has a named
marker for each bound that is set, and the values are arguments of
``spark.sql``: none is ever part of the text, so none can change it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from clickscope.config import FilterSpec
from clickscope.constants import NO_CLICK
from clickscope.sources.tables import ClickstreamTables


# The condition of each parameter, on actions ``t`` and on users ``u``.
_ON_ACTIONS = {
    "start_date": "t.date >= :start_date",
    "end_date": "t.date <= :end_date",
    "city_ids": "array_contains(:city_ids, t.city_id)",
    "keywords": "array_contains(:keywords, t.search_keyword)",
}
_ON_USERS = {
    "start_age": "u.age >= :start_age",
    "end_age": "u.age <= :end_age",
    "professionals": "array_contains(:professionals, u.professional)",
    "genders": "array_contains(:genders, u.gender)",
}


def filtered_actions_text(spec: FilterSpec, prefix: str = "") -> tuple[str, dict[str, object]]:
    """Text and arguments of Q1 over the views of ``register_views(prefix)``."""
    given = {name: getattr(spec, name) for name in (*_ON_ACTIONS, *_ON_USERS)}
    args = {name: list(v) if isinstance(v, tuple) else v for name, v in given.items() if v not in (None, ())}
    of_users = [term for name, term in _ON_USERS.items() if name in args]
    of_actions = [term for name, term in _ON_ACTIONS.items() if name in args]
    users = f"select u.userId as __dim_key from {prefix}user_info u"
    if of_users:
        users += " where " + " and ".join(of_users)
    text = f"select t.* from {prefix}user_visit_action t left semi join ({users}) k on t.user_id = k.__dim_key"
    if of_actions:
        text += " where " + " and ".join(of_actions)
    return text, args


def area_product_city_rows_text(prefix: str = "") -> tuple[str, dict[str, object]]:
    """Text and arguments of Q7, which takes no filter."""
    text = (
        "select p.product_id, p.product_name, city_id, c.city_name, c.area"
        f" from {prefix}user_visit_action t join {prefix}city_info c using (city_id)"
        f" join {prefix}product_info p on t.click_product_id = p.product_id"
        " where t.click_product_id != :no_click"
    )
    return text, {"no_click": NO_CLICK}


def run_text(tables: ClickstreamTables, text_of, *params) -> DataFrame:
    """The DataFrame of a text over ``tables``; its views are gone afterwards."""
    spark = tables.actions.sparkSession
    prefix = f"clickscope_{uuid.uuid4().hex[:12]}_"
    tables.register_views(prefix)
    try:
        text, args = text_of(*params, prefix)
        return spark.sql(text, args)
    finally:
        for name in tables.as_dict():
            spark.catalog.dropTempView(prefix + name)
