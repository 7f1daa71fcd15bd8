"""Structured Streaming variants of the batch jobs."""

from clickscope.streaming.category_stream import (
    category_counts_stream,
    start_category_top10,
    stream_actions,
)

__all__ = ["category_counts_stream", "start_category_top10", "stream_actions"]
