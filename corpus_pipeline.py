"""Corpus pipeline: toxicity, SimHash near-dedup, substring dedup, decontamination, BPE.

``STAGES`` lists the stages.  Each takes ``(spark, docs, sf_dir)`` and returns
a DataFrame, which is written as Parquet and read again as the next stage's
``docs``.  All but the last return every column of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.llm import bpe, decontaminate, simhash, substring, toxicity
from clickscope.llm.common import read_table, stored
from clickscope.llm.queries import vocabulary_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold.

    The network is trained on the labelled documents of this stage's input.
    """
    network = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    packed = docs.select(F.struct("*").alias("row"), "text")
    return toxicity.score_column(packed, network).where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.first_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that stand twice or oftener."""
    return substring.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item's question and answer."""
    return decontaminate.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    return bpe.training_rows(docs, vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: A trained network, SimHash over XXH64 and BPE cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is stored before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
