"""Language identification by multilingual mixture inference.

A document is a mixture of languages: each of its byte trigrams comes from one
language, with that language's trigram probabilities.  Expectation-maximisation
estimates the proportions.  The languages that the document really holds are
chosen by penalised likelihood: languages are added, most likely proportion
first, while the gain in log-likelihood exceeds a penalty that grows with the
logarithm of the document's length.  The language with the largest proportion
among the chosen ones is the prediction, that proportion the score.

Defined results: a null text and one without a letter give ``und`` and score
0; so does every text when nothing could be learned; rows without a language
are never learned from; ties go to the language whose name sorts first; whole
texts are read; repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import LOWER_ASCII, binary_column, map_batches

UNKNOWN = "und"
GRAM_BUCKETS = 1 << 16
#: Bound of the sample that the model is fitted on, rows for each language (about).
SAMPLE_ROWS = 2000
SMOOTHING = 0.05
ROUNDS = 12
#: Gain in log-likelihood that one more language has to bring, for each unit
#: of the logarithm of the number of trigrams.
PENALTY = 2.0
_SAMPLE_TASKS = 8
_HASH_RANGE = 1_000_000
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    if _ASCII_LETTER.search(text):
        return True
    return not text.isascii() and any(c.isalpha() for c in text.decode())


def grams(text: bytes) -> np.ndarray:
    """Bucket of every trigram of bytes; spaces of any kind count as one kind."""
    joined = b" " + b" ".join(text.translate(LOWER_ASCII).split()) + b" "
    b = np.frombuffer(joined, np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(16)


@dataclass
class LanguageModel:
    """``probabilities``: one row for each gram bucket, one column for each language."""

    languages: list[str]
    probabilities: np.ndarray

    def proportions(self, weights: np.ndarray, likelihood: np.ndarray) -> tuple[np.ndarray, float]:
        """EM proportions of the columns of ``likelihood`` and the log-likelihood."""
        share = np.full(likelihood.shape[1], 1.0 / likelihood.shape[1])
        total = weights.sum()
        for _ in range(ROUNDS):
            mixed = likelihood @ share
            share = share * (likelihood.T @ (weights / mixed)) / total
        return share, float(weights @ np.log(likelihood @ share))

    def predict(self, text: bytes | None) -> tuple[str, float]:
        if text is None or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        seen, counts = np.unique(grams(text), return_counts=True)
        weights = counts.astype(np.float64)
        likelihood = self.probabilities[seen]
        share, _ = self.proportions(weights, likelihood)
        order = np.argsort(-share, kind="stable")
        chosen = order[:1]
        best, fit = np.ones(1), float(weights @ np.log(likelihood[:, order[0]]))
        price = PENALTY * np.log(weights.sum() + 1.0)
        for k in range(2, len(order) + 1):
            now, gained = self.proportions(weights, likelihood[:, order[:k]])
            if gained - fit <= price:
                break
            chosen, best, fit = order[:k], now, gained
        top = min(range(len(chosen)), key=lambda i: (-best[i], self.languages[chosen[i]]))
        return self.languages[chosen[top]], float(min(1.0, best[top]))


def learnable(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Rows that may be learned from: a language, and not in the held-out fold."""
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(folds, 0))


def held_out(folds: int, fold: int):
    """Whether crc32 of the id as text leaves ``fold`` modulo ``folds`` (a null id: no)."""
    rest = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % folds
    return F.coalesce(rest == fold, F.lit(False))


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn trigram probabilities from ``text`` and ``lang`` of a bounded sample.

    Rows of each language are kept by a hash of their text below a threshold
    that leaves about ``sample_rows`` of them.  Trigram counts are summed in
    a fixed number of tasks; the driver gets one vector of ``GRAM_BUCKETS``
    counts for each of them and language.
    """
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return LanguageModel([], np.zeros((GRAM_BUCKETS, 0)))
    limits = {k: max(1, int(_HASH_RANGE * min(1.0, sample_rows / n))) for k, n in totals.items()}
    below = F.pmod(F.xxhash64("text", "doc_id"), F.lit(_HASH_RANGE))
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    sample = rows.where(below < limit[F.col("lang")]).select("lang", "text").repartition(_SAMPLE_TASKS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), binary_column(batch, "text")):
                own = sums.setdefault(lang, np.zeros(GRAM_BUCKETS, np.int64))
                own += np.bincount(grams(text), minlength=GRAM_BUCKETS)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.astype("<i8").tobytes() for v in sums.values()], pa.binary())],
                names=["lang", "counts"],
            )

    counts = np.zeros((len(languages), GRAM_BUCKETS), np.int64)
    for r in sample.mapInArrow(count, "lang string, counts binary").collect():
        counts[languages.index(r["lang"])] += np.frombuffer(r["counts"], "<i8")
    smooth = counts + SMOOTHING
    return LanguageModel(languages, np.ascontiguousarray((smooth / smooth.sum(axis=1, keepdims=True)).T))


def identify(docs: DataFrame, model: LanguageModel, folds: int = 5) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score``; only the text is read for them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x GRAM_BUCKETS numbers

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.predict(t) for t in binary_column(batch, "text")]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ],
            names=["doc_id", "held_out", "lang_pred", "score"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(folds, 0).alias("held_out"), "text")
    return map_batches(rows, work, "doc_id long, held_out boolean, lang_pred string, score double")
