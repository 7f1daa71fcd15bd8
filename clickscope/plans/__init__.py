"""The four clickstream jobs, each step a lazy DataFrame.

Every function takes the input tables (and a :class:`FilterSpec` where the
job is filtered) and returns a DataFrame; nothing is collected, so the
caller decides whether to show, write or chain it.
"""

from clickscope.plans.actions import filtered_actions
from clickscope.plans.area import (
    area_city_share,
    area_product_city_clicks,
    area_product_city_rows,
    area_product_clicks,
    area_product_top3,
)
from clickscope.plans.category import (
    category_behavior_counts,
    category_session_counts,
    category_session_top10,
    category_session_top10_by_threshold,
    category_top10,
)
from clickscope.plans.cube import build_cube, category_counts_from_cube, category_top10_from_cube, read_cube
from clickscope.plans.funnel import page_jump_counts, page_jump_rate, page_visit_counts

__all__ = [
    "area_city_share",
    "area_product_city_clicks",
    "area_product_city_rows",
    "area_product_clicks",
    "area_product_top3",
    "build_cube",
    "category_behavior_counts",
    "category_counts_from_cube",
    "category_session_counts",
    "category_session_top10",
    "category_session_top10_by_threshold",
    "category_top10",
    "category_top10_from_cube",
    "filtered_actions",
    "page_jump_counts",
    "page_jump_rate",
    "page_visit_counts",
    "read_cube",
]
