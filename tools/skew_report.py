"""A hot session: the sliced jump counts against the plain one-window plan.

    python tools/skew_report.py [clicks]

Both plans count the jumps of 4,000,000 made-up clicks (by default) of one day, in
short sessions and with one session that holds a third of them, under the same
settings, three times each, with Spark's event log written to a fresh scratch
folder.  For each the report gives the time of the last run and the largest
number of shuffle records that a single task read.

Partition coalescing is off and 64 shuffle partitions are used, so the input
stays cut into many partitions, as a cluster cuts a large one.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


def _events(log_dir: str):
    for path in sorted(glob.glob(f"{log_dir}/**/*", recursive=True)):
        if os.path.isfile(path) and "events" in os.path.basename(path) or path.endswith(".inprogress"):
            with open(path, encoding="utf-8") as handle:
                for line in handle:
                    yield json.loads(line)


def _task_reads(log_dir: str) -> dict[str, list[int]]:
    """Shuffle records read per task, grouped by job group."""
    stage_group: dict[int, str] = {}
    reads: dict[str, list[int]] = {}
    for ev in _events(log_dir):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            for stage in ev.get("Stage IDs", []):
                stage_group[stage] = group
        elif kind == "SparkListenerTaskEnd":
            group = stage_group.get(ev.get("Stage ID"))
            metrics = ev.get("Task Metrics") or {}
            read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            if group and read:
                reads.setdefault(group, []).append(read)
    return reads


def main() -> None:
    from pyspark.sql import DataFrame, Window
    from pyspark.sql import functions as F

    from clickscope.config import DRIVER_SPEC
    from clickscope.operators.adjacency import count_consecutive_pairs
    from clickscope.session import build_session

    count = int(sys.argv[1]) if len(sys.argv) > 1 else 4_000_000
    log_dir = tempfile.mkdtemp(prefix="clickscope-skew-")
    spark = build_session(
        master="local[8]",
        shuffle_partitions=64,
        conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    pairs = DRIVER_SPEC.jump_pairs
    # Ten clicks a session, all within one day.
    clicks = spark.range(count).select(
        (F.col("id") % (count // 10)).cast("string").alias("session_id"),
        F.lit(1).alias("day"),
        "id",
        (F.xxhash64("id") % 10 + 10).alias("page_id"),
    )
    clicks = clicks.withColumn("page_id", F.col("page_id") % 10 + 1)
    hot = clicks.withColumn("session_id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("session_id")))
    flows = {"7 pages": pairs, "1,000 pages": tuple((a, a % 1000 + 1) for a in range(1, 1001))}
    for flow, wanted in flows.items():
        for label, data in ((f"{flow}, even", clicks), (f"{flow}, a third in one session and day", hot)):

            def plain(data: DataFrame = data) -> DataFrame:
                window = Window.partitionBy("session_id").orderBy("day", "id")
                return (
                    data.select(F.col("page_id").alias("a"), F.lead("page_id").over(window).alias("b"))
                    .where(" or ".join(f"(a = {a} and b = {b})" for a, b in pairs))  # of 7 pages
                    .groupBy("a", "b")
                    .agg(F.count(F.lit(1)).alias("n"))
                )

            def sliced(data: DataFrame = data) -> DataFrame:
                return count_consecutive_pairs(data, ["session_id"], ["day", "id"], "page_id", wanted)

            got = {}
            for plan, build in (("sliced", sliced), ("plain window", plain)):
                for attempt in range(3):
                    group = f"{label}: {plan}"
                    spark.sparkContext.setJobGroup(group if attempt == 2 else "warm", group)
                    started = time.perf_counter()
                    got[plan] = sorted(tuple(r) for r in build().collect())
                    elapsed = time.perf_counter() - started
                print(f"{group}: {elapsed:.1f} s", flush=True)
            if wanted == pairs:
                assert got["sliced"] == got["plain window"], "the two plans disagree"
    spark.stop()
    for group, per_task in _task_reads(log_dir).items():
        if group != "warm":
            clicks_read = [n for n in per_task if n > 0.001 * sum(per_task)]  # not the summaries
            print(f"{group}: largest task {max(per_task)}, median {statistics.median(clicks_read):.0f} shuffle records")


if __name__ == "__main__":
    main()
