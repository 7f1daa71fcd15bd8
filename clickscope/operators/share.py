"""Share of a total within a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def share_of_group(
    value_col: str, group: Sequence[str], total_col: str | None = None
) -> Column:
    """``value / sum(value) over (partition by group)`` as a double.

    When the caller already carries the group total (``total_col``), the
    division uses it and no window is needed.
    """
    value = F.col(value_col).cast("double")
    if total_col is not None:
        return value / F.col(total_col)
    return value / F.sum(value_col).over(Window.partitionBy(*group))
