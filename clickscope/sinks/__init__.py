"""Where job results go."""

from clickscope.sinks.results import (
    RESULT_COLUMNS,
    TASK_ID,
    JdbcResultStore,
    ResultStore,
    as_result,
    drop_old_versions,
    new_task_id,
    preview,
    publish_table,
    with_task_id,
)

__all__ = [
    "RESULT_COLUMNS",
    "TASK_ID",
    "JdbcResultStore",
    "ResultStore",
    "as_result",
    "drop_old_versions",
    "new_task_id",
    "preview",
    "publish_table",
    "with_task_id",
]
