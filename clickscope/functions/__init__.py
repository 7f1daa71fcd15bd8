"""Column-level helpers (native expressions only; no Python UDFs)."""

from clickscope.functions.idlists import id_list, id_tokens
from clickscope.functions.predicates import (
    action_predicates,
    all_of,
    is_target_jump,
    page_in_flow,
    user_predicates,
)

__all__ = [
    "action_predicates",
    "all_of",
    "id_list",
    "id_tokens",
    "is_target_jump",
    "page_in_flow",
    "user_predicates",
]
