"""Sharding by fixed virtual slots.

Every row hashes into one of a fixed number of virtual slots.  Bytes are
aggregated per slot, and a small versioned table maps slots to shards.
Rebalancing edits that map: slots leave overfull shards and join the emptiest
ones, so rows move only with their slot.

A record is its ``doc_id`` and its text, so rows of one id are spread.  A slot
that weighs more than a ``HEAVY``-th of a shard (many equal rows, or one huge
text) is split by a second hash, of the row's place in the stored
table, into further slots of about that weight, at most ``2 x HEAVY`` for each shard.

Defined results: a null ``doc_id`` is hashed as null; a null text has
size 1 and checksum 0; repeated rows are rows of their own and take positions
of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from clickscope.llm.common import shared_folder, stored

VIRTUAL_SLOTS = 4096
SHARDS = 8
#: Share of a shard above which a slot is split.
HEAVY = 64

MAP_SCHEMA = T.StructType(
    [
        T.StructField("version", T.IntegerType()),
        T.StructField("vslot", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
    ]
)


def with_virtual_slots(docs: DataFrame, slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` and ``vslot`` of every row, and its
    ``place`` in the table."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(F.encode(body, "UTF-8")).cast("long").alias("text_crc32"),
    )
    vslot = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), "text_crc32", "size"), F.lit(slots)).cast("int")
    return rows.withColumn("vslot", vslot).withColumn("place", F.monotonically_increasing_id())


def split_heavy(rows: DataFrame, weight: list[int], count: list[int], shards: int) -> tuple[DataFrame, int]:
    """``rows`` with those of heavy slots in slots of their own, and how many slots there are then."""
    most = max(1, sum(weight) // (shards * HEAVY))
    slots, parts = len(weight), []
    for slot, heavy in enumerate(weight):
        if heavy > most and count[slot] > 1:
            into = min(-(-heavy // most), count[slot])
            parts.append((slot, slots, into))
            slots += into
    if not parts:
        return rows, slots
    table = rows.sparkSession.createDataFrame(parts, "vslot int, first int, into int")
    spread = F.expr("if(into is null, vslot, cast(first + pmod(xxhash64(place, text_crc32), into) as int))")
    return rows.join(F.broadcast(table), "vslot", "left").withColumn("vslot", spread).drop("first", "into"), slots


def first_map(shards: int = SHARDS, slots: int = VIRTUAL_SLOTS) -> list[int]:
    """Version 0: equal ranges of slots; entry i is the shard of slot i."""
    return [slot * shards // slots for slot in range(slots)]


def rebalance(mapping: list[int], weight: list[int], shards: int) -> list[int]:
    """An edited map whose shards weigh nearly the same.

    Shards over the mean release slots, largest first, as long as they stay
    at or above it; then the smallest one that takes them below it.  Released
    slots go, largest first, to the lightest shard.  What unevenness is left
    is reduced by moving or exchanging single slots of the heaviest and the
    lightest shard.  Works on the map alone, whose size is fixed.
    """
    mapping = list(mapping)
    load = [0] * shards
    members: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in enumerate(mapping):
        load[shard] += weight[slot]
        members[shard].add(slot)
    mean = sum(weight) / shards
    released: list[int] = []
    for shard in range(shards):
        for slot in sorted(members[shard], key=lambda s: (-weight[s], s)):
            if weight[slot] and load[shard] - weight[slot] >= mean:
                released.append(slot)
                load[shard] -= weight[slot]
                members[shard].discard(slot)
        over = [s for s in members[shard] if weight[s]]
        if load[shard] > mean and over:
            slot = min(over, key=lambda s: (weight[s], s))
            released.append(slot)
            load[shard] -= weight[slot]
            members[shard].discard(slot)
    heap = [(load[shard], shard) for shard in range(shards)]
    heapq.heapify(heap)
    for slot in sorted(released, key=lambda s: (-weight[s], s)):
        filled, shard = heapq.heappop(heap)
        mapping[slot] = shard
        members[shard].add(slot)
        load[shard] = filled + weight[slot]
        heapq.heappush(heap, (load[shard], shard))
    for _ in range(4 * shards):
        high = max(range(shards), key=lambda s: (load[s], -s))
        low = min(range(shards), key=lambda s: (load[s], s))
        gap = load[high] - load[low]
        give = sorted((weight[s], s) for s in members[high] if weight[s])
        take = [(0, -1), *sorted((weight[s], s) for s in members[low] if weight[s])]
        best, at = None, 0
        for w, s in give:  # the pair whose difference is nearest to half of the gap
            while at + 1 < len(take) and abs(2 * (w - take[at + 1][0]) - gap) <= abs(2 * (w - take[at][0]) - gap):
                at += 1
            left = abs(2 * (w - take[at][0]) - gap)
            if left < gap and (best is None or left < best[0]):
                best = (left, s, take[at][1])
        if best is None:
            break
        _, out, back = best
        for slot, source, target in ((out, high, low), (back, low, high)):
            if slot >= 0:
                members[source].discard(slot)
                members[target].add(slot)
                mapping[slot] = target
                load[source] -= weight[slot]
                load[target] += weight[slot]
    return mapping


def grow(mapping: list[int], weight: list[int], shards: int) -> list[int]:
    """The map edited for one more shard: slots move only into the new shard.

    Every old shard gives up slots until it weighs no more than the new mean.
    """
    mapping = list(mapping)
    mean = sum(weight) / (shards + 1)
    load = [0] * shards
    for slot, shard in enumerate(mapping):
        load[shard] += weight[slot]
    for slot in sorted(range(len(mapping)), key=lambda s: (-weight[s], s)):
        shard = mapping[slot]
        if weight[slot] and load[shard] - weight[slot] >= mean:
            mapping[slot] = shards
            load[shard] -= weight[slot]
    return mapping


def store_version(spark: SparkSession, folder: str, version: int, mapping: list[int]) -> None:
    """Write one version of the map; versions are never changed once written."""
    rows = [(version, slot, shard) for slot, shard in enumerate(mapping)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(
        f"{folder}/v{version}"
    )


def load_version(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/v{version}")


def slot_weights(rows: DataFrame, slots: int = VIRTUAL_SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot; the result has ``slots`` entries at most."""
    weight, count = [0] * slots, [0] * slots
    for r in rows.groupBy("vslot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        weight[r["vslot"]], count[r["vslot"]] = r["b"], r["n"]
    return weight, count


def assign_shards(docs: DataFrame, shards: int = SHARDS, slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """Shard and position of every row under the rebalanced map.

    Version 0 and the edited version 1 of the map are stored in the shared
    folder; rows are placed by the stored version 1.  A row's position counts
    from 0 without gaps inside its shard: rows are numbered inside their
    virtual slot, and the slot's offset (from the counts) is added, so no
    task ever holds a whole shard.
    """
    spark = docs.sparkSession
    rows = stored(with_virtual_slots(docs, slots), "slot-rows")
    weight, count = slot_weights(rows, slots)
    rows, slots = split_heavy(rows, weight, count, shards)
    if slots > len(weight):
        weight, count = slot_weights(rows, slots)
    folder = shared_folder(spark, "slot-map")
    zero = first_map(shards, slots)
    store_version(spark, folder, 0, zero)
    store_version(spark, folder, 1, rebalance(zero, weight, shards))
    placed = [0] * slots
    filled = [0] * shards
    for r in sorted(load_version(spark, folder, 1).collect(), key=lambda r: r["vslot"]):
        placed[r["vslot"]] = filled[r["shard"]]
        filled[r["shard"]] += count[r["vslot"]]
    offsets = spark.createDataFrame(list(enumerate(placed)), "vslot int, offset long")
    mapping = load_version(spark, folder, 1).join(offsets, "vslot").drop("version")
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("inside", F.row_number().over(inside))
        .join(F.broadcast(mapping), "vslot")  # as many rows as there are slots
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("offset") + F.col("inside") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "vslot",
        )
    )
