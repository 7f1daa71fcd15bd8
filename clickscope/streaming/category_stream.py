"""Category behaviour counts kept up to date as action files arrive.

The same operators as the batch job (filter, semi join to users, classify,
explode, conditional counts) applied to a file stream.  The aggregate is
keyed by category only, so the streaming state holds one row per category
however many actions arrive; no watermark is needed to bound it.  Each
micro-batch publishes the current top 10 through ``foreachBatch``; the
write replaces that batch's partition, so a batch re-run after a failure
does not duplicate rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickscope import schemas
from clickscope.config import FilterSpec
from clickscope.functions.predicates import action_predicates, all_of, user_predicates
from clickscope.operators.behavior import behavior_rows, count_behaviors, of_categories
from clickscope.operators.joins import restrict_to_keys
from clickscope.operators.topk import top_k
from clickscope.plans.category import TOP_CATEGORIES, category_order


def stream_actions(
    spark: SparkSession, source: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of ``user_visit_action`` rows from parquet files under
    ``source`` (a fixed schema: streams do not infer one)."""
    reader = spark.readStream.schema(schemas.USER_VISIT_ACTION)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(source)


def category_counts_stream(actions: DataFrame, users: DataFrame, spec: FilterSpec) -> DataFrame:
    """Running clicks / orders / pays per category (complete-mode aggregate).

    ``users`` is a static table; the semi join against it is a stream-static
    join, planned per micro-batch like the batch job's.
    """
    pred = all_of(action_predicates(spec))
    if pred is not None:
        actions = actions.where(pred)
    kept = restrict_to_keys(
        actions, users, "user_id", "userId", dimension_filter=all_of(user_predicates(spec))
    )
    return count_behaviors(of_categories(behavior_rows(kept), spec.category_ids))


def start_category_top10(
    spark: SparkSession,
    source: str,
    users: DataFrame,
    spec: FilterSpec,
    output: str,
    checkpoint: str,
    available_now: bool = False,
    k: int = TOP_CATEGORIES,
) -> StreamingQuery:
    """Start the stream; every micro-batch writes the top k under its batch id.

    Output: parquet at ``output`` partitioned by ``batch_id``.
    ``checkpoint`` is a shared folder of this stream's own: it holds the file
    log and the counts that a restart goes on from.
    """
    counts = category_counts_stream(stream_actions(spark, source), users, spec)

    def publish(batch: DataFrame, batch_id: int) -> None:
        from pyspark.sql import functions as F

        top = top_k(batch, category_order(), k).withColumn("batch_id", F.lit(batch_id))
        (
            top.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(output)
        )

    writer = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(publish)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
