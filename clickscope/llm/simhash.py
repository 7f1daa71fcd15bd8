"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most two bits differ in at most two
of their eight bytes, so they share at least six bytes at their positions:
six is the guaranteed minimum count.  The index lists fingerprints under
every choice of six positions and the bytes there; a pair that reaches the
minimum meets in such a list and no other pair meets.  In a list the shared
bytes of each pair are tallied and the pair verified by its bits.

Only distinct fingerprints are indexed (copies are one entry).  A list leaves
just two bytes free, so it never holds more than 65,536 entries, whatever the
data; long lists are verified through the neighbourhood of each entry instead
of pair by pair.

Defined results: null and empty texts have fingerprint zero, linked like any
other; repeated rows each give a row; a null ``doc_id`` never names a group
unless the group has no other (then it is null); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.llm.common import binary_column, components, map_batches, stored

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_BITS = 2
BYTES = 8
#: Pairs are tallied directly in lists up to this length.
DIRECT = 48


def fingerprint(text: bytes | None, words_each: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash: bit set where over half of the shingle hashes have it."""
    words = (text or b"").lower().split()  # bytes: A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    count = max(1, len(words) - words_each + 1)
    starts = [0, *ends[: count - 1]]
    stops = ends[words_each - 1 :] if len(words) >= words_each else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a : b - 1], HASH_SEED) for a, b in zip(starts, stops)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, count, 8192):
        bits = np.unpackbits(hashes[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words_each: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's 64 bits as a long) of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t, words_each) for t in binary_column(batch, "text")], np.uint64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fp"]
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, work, "doc_id long, fp long")


def _flips(bits: int, width: int = 16) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for n in range(1, bits + 1) for c in combinations(range(width), n)])


def linked_in_list(fps: np.ndarray, free: tuple[int, int], min_shared: int, max_bits: int) -> np.ndarray:
    """For each fingerprint of a list, the position of its group's first member.

    ``free`` are the two byte positions in which the list's members differ.
    """
    m = len(fps)
    label = np.arange(m)
    if m <= DIRECT:
        octets = fps.view(np.uint8).reshape(m, BYTES)
        shared = np.zeros((m, m), np.int8)
        for position in range(BYTES):
            column = octets[:, position]
            shared += column[:, None] == column[None, :]
        linked = (shared >= min_shared) & (np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits)
        while True:
            low = np.where(linked, label[None, :], m).min(axis=1)
            if (low == label).all():
                return label
            label = low
    a, b = (np.uint64(8 * p) for p in free)
    byte = np.uint64(255)
    value = (((fps >> a) & byte) | (((fps >> b) & byte) << np.uint64(8))).astype(np.int64)
    low_of = np.full(1 << 16, m)
    while True:
        low_of[value] = label
        low = label
        for flip in _flips(max_bits):
            low = np.minimum(low, low_of[value ^ flip])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def similar_links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``u``, ``v`` that join fingerprints at ``max_bits`` or fewer.

    ``classes`` has distinct ``fp``.  Of the links inside one index list only
    those to the group's first member are returned, which joins the same
    fingerprints with at most one row for each member.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the index has lists for two bits at most")
    frees = list(combinations(range(BYTES), 2))

    def mask(free: tuple[int, int]) -> int:
        kept = sum(255 << (8 * p) for p in range(BYTES) if p not in free)
        return kept - (1 << 64) if kept >> 63 else kept

    lists = (
        classes.select(
            "fp",
            F.explode(
                F.array(
                    *(
                        F.struct(F.lit(i).alias("kind"), F.col("fp").bitwiseAND(F.lit(mask(free))).alias("shared"))
                        for i, free in enumerate(frees)
                    )
                )
            ).alias("entry"),
        )
        .groupBy("entry.kind", "entry.shared")
        .agg(F.collect_list("fp").alias("fps"))  # 65,536 at most
        .where(F.size("fps") > 1)
        .select("kind", "fps")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            column = batch.column("fps")
            flat, offsets = np.asarray(column.values), np.asarray(column.offsets)
            for i, kind in enumerate(batch.column("kind").to_pylist()):
                fps = np.sort(flat[offsets[i] : offsets[i + 1]])
                first = linked_in_list(fps.view(np.uint64), frees[kind], BYTES - 2, max_bits)
                other = first != np.arange(len(fps))
                us.append(fps[first[other]])
                vs.append(fps[other])
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"]
                )

    return lists.mapInArrow(run, "u long, v long")


def class_components(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp`` and ``root``, the same for all fingerprints that links join (stored)."""
    found = components(similar_links(classes, max_bits))
    return stored(
        classes.join(found, classes["fp"] == found["node"], "left").select("fp", F.coalesce("root", "fp").alias("root")),
        "roots",
    )


def near_duplicates(
    docs: DataFrame, words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (the smallest ``doc_id`` reachable)."""
    rows = stored(fingerprints(docs, words_each), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    rooted = classes.join(class_components(classes.select("fp"), max_bits), "fp")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = stored(rooted.join(named, "root").select("fp", "component_id"), "components")
    return rows.join(by_class, "fp").select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group, with all columns: the one with the smallest ``doc_id``.

    Of rows that share that ``doc_id`` one stays; a row with a null id stays
    only if its group has no other.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t, words_each) for t in binary_column(batch, "text")], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(values.view(np.int64))], names=["row", "fp"])

    packed = docs.select(F.struct("*").alias("row"), "text")  # no column name can clash
    schema = T.StructType([packed.schema["row"], T.StructField("fp", T.LongType())])
    rows = stored(
        map_batches(packed, work, schema).withColumn("number", F.monotonically_increasing_id()), "fingerprinted"
    )
    keys = rows.select("number", "fp", F.col("row.doc_id").cast("long").alias("doc_id"))
    roots = class_components(stored(keys.select("fp").distinct(), "classes"), max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "number")).alias("first")
    kept = stored(
        keys.groupBy("fp").agg(first).join(roots, "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.number"),
        "kept",
    )
    return rows.join(kept, "number", "left_semi").select("row.*")
