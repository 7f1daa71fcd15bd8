"""The streaming category counts agree with the batch job."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from clickscope import plans
from clickscope.config import DRIVER_SPEC
from clickscope.sources import from_driver_tables
from clickscope.streaming import category_counts_stream, start_category_top10, stream_actions
from tests.conftest import sf_dir


def test_stream_counts_equal_batch(spark):
    tables = from_driver_tables(spark, sf_dir("0.01"))
    root = tempfile.mkdtemp(prefix="clickscope-stream-src-")
    src = f"{root}/actions"
    for i in range(3):
        tables.actions.where(F.col("action_seq") % 3 == i).write.mode("append").parquet(src)

    counts = category_counts_stream(stream_actions(spark, src, max_files_per_trigger=2), tables.users, DRIVER_SPEC)
    query = (
        counts.writeStream.outputMode("complete")
        .format("memory")
        .queryName("clickscope_stream_counts")
        .option("checkpointLocation", tempfile.mkdtemp(prefix="clickscope-ckpt-"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(300)
    streamed = spark.table("clickscope_stream_counts")
    batch = plans.category_behavior_counts(plans.filtered_actions(tables, DRIVER_SPEC))
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_stream_publishes_top10(spark):
    tables = from_driver_tables(spark, sf_dir("0.001"))
    root = tempfile.mkdtemp(prefix="clickscope-stream-src-")
    src = f"{root}/actions"
    tables.actions.write.parquet(src)
    out = f"{root}/top10"
    query = start_category_top10(
        spark, src, tables.users, DRIVER_SPEC, out,
        checkpoint=tempfile.mkdtemp(prefix="clickscope-ckpt-"), available_now=True,
    )
    query.awaitTermination(300)
    published = spark.read.parquet(out)
    last = published.agg(F.max("batch_id")).first()[0]
    got = sorted(tuple(r)[:4] for r in published.where(F.col("batch_id") == last).collect())
    expected = sorted(tuple(r) for r in plans.category_top10(plans.filtered_actions(tables, DRIVER_SPEC)).collect())
    assert got == expected
