"""Helpers that the operators share: tables, shared scratch tables, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.session import ensure_checkpoint_dir

#: Texts are handed to vectorised code in blocks of about this many bytes.
BLOCK_BYTES = 4 << 20
#: White space of the word contracts: bytes 0x20 and 0x09 to 0x0D, which is
#: exactly what ``bytes.split()`` splits at.
LOWER_ASCII = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage (a lost executor costs only its running tasks) and
    lets adaptive execution split skewed joins on either side of the cut.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column of an Arrow batch as UTF-8 bytes (null: ``None``)."""
    column = batch.column(name)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def text_blocks(texts: list[bytes | None], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` of about ``limit`` bytes; one text is never cut."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= limit:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = work(batch)
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph, by large and small stars.

    ``edges`` has long columns ``u`` and ``v``.  A large star joins the larger
    neighbours of every node to the smallest of its neighbourhood, a small star
    the smaller ones; both keep what is connected connected and add no edges.
    Rounds of the two, a few for groups as they occur and growing with the
    logarithm of the longest chain, leave one star for each component, around
    its smallest node.  Returns ``node`` and ``root`` (that smallest node) for
    every node with an edge.  Minima are combined before the shuffle, and the
    joins read stored tables, so adaptive execution can split a hub's rows.
    """
    greater, least = F.greatest("u", "v"), F.least("u", "v")
    stars = stored(edges.where("u <> v").select(greater.alias("u"), least.alias("v")).distinct(), "edges")
    seen = None
    while True:
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()  # one row
        if now == seen:
            break
        seen = now
        both = stars.select("u", "v").union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = stored(large.distinct(), "edges")
        low = stored(stars.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = stars.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = stored(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
