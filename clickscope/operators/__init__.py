"""Reusable operators the jobs are composed of."""

from clickscope.operators.adjacency import count_consecutive_pairs
from clickscope.operators.behavior import (
    CLICK,
    ORDER,
    PAY,
    behavior_category_ids,
    behavior_kind,
    behavior_rows,
    count_behaviors,
    is_click,
    of_categories,
)
from clickscope.operators.joins import restrict_to_keys
from clickscope.operators.share import share_of_group
from clickscope.operators.topk import top_k, top_k_per_group

__all__ = [
    "CLICK",
    "ORDER",
    "PAY",
    "behavior_category_ids",
    "behavior_kind",
    "behavior_rows",
    "count_behaviors",
    "count_consecutive_pairs",
    "is_click",
    "of_categories",
    "restrict_to_keys",
    "share_of_group",
    "top_k",
    "top_k_per_group",
]
