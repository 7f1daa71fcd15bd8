"""Q7-Q11: products leading each area, and each city's share of them.

Clicks are counted per (city, product) on the fact table *before* the
dimensions are joined.  The join then meets one row per (city, product)
instead of one per click, and a product clicked a billion times is one row
per city on each side of it.  Because ``city_id`` and ``product_id`` are
unique in their tables, counting first and joining after gives the same
counts as joining every click and counting after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.config import FilterSpec
from clickscope.constants import NO_CLICK, TOP_PRODUCTS
from clickscope.functions.predicates import action_predicates, all_of
from clickscope.operators.share import share_of_group
from clickscope.operators.topk import top_k_per_group
from clickscope.sources.tables import ClickstreamTables


def _actions(tables: ClickstreamTables, spec: FilterSpec | None) -> DataFrame:
    # The original area job applies no filter; a spec may add one.  Actions
    # that are no clicks name no product, so the joins would drop them: they
    # are left out in the scan, before they all meet on one key.
    actions = tables.actions.where(F.col("click_product_id") != F.lit(NO_CLICK))
    if spec is not None:
        pred = all_of(action_predicates(spec))
        if pred is not None:
            actions = actions.where(pred)
    return actions


def _cities(tables: ClickstreamTables) -> DataFrame:
    return tables.cities.select("city_id", "city_name", "area")


def _products(tables: ClickstreamTables) -> DataFrame:
    return tables.products.select("product_id", "product_name")


def area_product_city_rows(
    tables: ClickstreamTables, spec: FilterSpec | None = None
) -> DataFrame:
    """Q7: one row per click with a known city and product:
    ``product_id, product_name, city_id, city_name, area``.

    This is row-level output (its size is the number of clicks), so no
    aggregation can shrink it; join sides are left to Spark's size check.
    """
    actions = _actions(tables, spec).select("city_id", "click_product_id")
    with_city = actions.join(_cities(tables), "city_id", "inner")
    products = _products(tables)
    rows = with_city.join(
        products, with_city["click_product_id"] == products["product_id"], "inner"
    )
    return rows.select("product_id", "product_name", "city_id", "city_name", "area")


def area_product_city_clicks(
    tables: ClickstreamTables, spec: FilterSpec | None = None
) -> DataFrame:
    """Q10: clicks per (area, product, city).

    Counted on the fact table first (partial + final aggregate on two
    integer keys), then joined to the two dimensions.
    """
    cells = (
        _actions(tables, spec)
        .groupBy("city_id", F.col("click_product_id").alias("product_id"))
        .agg(F.count(F.lit(1)).alias("click_count"))
    )
    named = cells.join(_cities(tables), "city_id", "inner").join(
        _products(tables), "product_id", "inner"
    )
    return named.select(
        "area", "product_id", "product_name", "city_id", "city_name", "click_count"
    )


def area_product_clicks(
    tables: ClickstreamTables, spec: FilterSpec | None = None
) -> DataFrame:
    """Q8: clicks per (area, product), summed from the city cells."""
    return (
        area_product_city_clicks(tables, spec)
        .groupBy("area", "product_id", "product_name")
        .agg(F.sum("click_count").cast("bigint").alias("click_count"))
    )


def area_product_top3(
    tables: ClickstreamTables, spec: FilterSpec | None = None, k: int = TOP_PRODUCTS
) -> DataFrame:
    """Q9: the k most clicked products of each area (ties: lower id)."""
    ranked = top_k_per_group(
        area_product_clicks(tables, spec),
        group=["area"],
        order=[F.desc("click_count"), F.asc("product_id")],
        k=k,
        rank_col="area_rank",
    )
    return ranked.select("area", "area_rank", "product_id", "product_name", "click_count")


def area_city_share(
    tables: ClickstreamTables, spec: FilterSpec | None = None, k: int = TOP_PRODUCTS
) -> DataFrame:
    """Q11: for each area's top-k products, every city's clicks and its
    share of the product's clicks in that area.

    The ranking is on area totals (Q9), then the city cells (Q10) of the
    chosen products are joined back.  The top rows are the small side (k for
    each area, however many cells there are), so the join builds on them and
    the cells stay where they are.
    """
    cells = area_product_city_clicks(tables, spec)
    top = area_product_top3(tables, spec, k).select(
        "area", "product_id", "area_rank", F.col("click_count").alias("product_click_count")
    )
    chosen = cells.join(F.broadcast(top), ["area", "product_id"], "inner")
    return chosen.select(
        "area",
        "area_rank",
        "product_id",
        "product_name",
        "product_click_count",
        "city_id",
        "city_name",
        F.col("click_count").alias("city_click_count"),
        share_of_group("click_count", ["area", "product_id"], total_col="product_click_count").alias(
            "city_share"
        ),
    )
