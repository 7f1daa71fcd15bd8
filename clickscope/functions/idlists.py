"""Comma-separated id lists (the order / pay columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickscope.constants import ID_LIST_SEPARATOR


def id_tokens_sql(column: str) -> str:
    """``"3,1,"`` -> ``["3", "1"]``: split on ``,`` and drop empty tokens.

    Spark's ``split`` keeps trailing empty strings where the JVM's
    ``String.split`` drops them, and an inner empty token (``"1,,2"``) would
    name no category; both are removed.  Null stays null.
    """
    return f"filter(split({column}, '{ID_LIST_SEPARATOR}'), token -> token != '')"


def id_list_sql(column: str) -> str:
    """Same as :func:`id_tokens_sql`, each token cast to ``bigint``."""
    return f"transform({id_tokens_sql(column)}, token -> cast(token as bigint))"


def id_tokens(column: str) -> Column:
    return F.expr(id_tokens_sql(column))


def id_list(column: str) -> Column:
    return F.expr(id_list_sql(column))
