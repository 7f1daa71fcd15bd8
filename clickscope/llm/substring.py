"""Substring dedup: repeated runs of words found by an FM-index for each shard.

A window is ``WINDOW_WORDS`` consecutive words.  Its anchor is the group of
``GRAM_WORDS`` words in it with the smallest hash (the first of them), so equal
windows have equal anchors.  The windows of a text that share one anchor
follow each other and make up one piece; pieces go to shards by the hash of
their anchor, so all equal windows meet in one shard, and a piece whose anchor
stands nowhere else is never shipped.  Equal pieces are one entry with a
weight.  Each shard builds a compressed FM-index of its pieces and streams
them through it; matching statistics by backward search give, for each window,
how often its words stand in the shard.  Windows that stand twice or oftener
mark their words, and marked words are removed.

Hot keys: equal texts are one text with a weight from the start.  Pieces of an
anchor with more than ``HOT_PIECES`` different pieces are cut into their
windows, equal windows are combined before the shuffle, and each goes to a
shard by its own hash, so no shard grows with the number of texts that share a
passage.  A task works its rows off in shards of about ``SHARD_WORDS`` words.

Defined results: null and empty texts have no words, lose none, and have the
hash of the empty string; texts shorter than a window lose none; whole texts
are read, whatever their length; repeated rows are documents of their own (so
they remove each other's windows); an empty table gives an empty result; other
columns are ignored by ``removed_words`` and kept by ``deduplicated``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.llm.common import binary_column, stored, text_blocks
from clickscope.llm.fmindex import FMIndex
from clickscope.llm.wordsplit import Remembered

WINDOW_WORDS = 35
#: Words of an anchor; the windows of a piece begin at up to
#: WINDOW_WORDS - GRAM_WORDS + 1 places (62 at most, for the masks).
GRAM_WORDS = 6
HOT_PIECES = 256
SHARD_WORDS = 300_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Shuffle files go as soon as the write that needed them has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mixed(left * _A + right * _C)


class Hasher:
    """Hashes of words, of anchors and of runs of words; remembers words it has seen."""

    def __init__(self, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS) -> None:
        self.window, self.gram = window, gram
        self.of_word = Remembered(lambda w: xxhash.xxh64_intdigest(w, 7))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def words(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.of_word.__getitem__, words), np.uint64, len(words))

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            size = max(n + 1, 2 * len(self.powers))
            for name, base in (("powers", _BASE), ("inverses", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def runs(self, hashes: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of the words from ``first`` to ``stop`` of each run, wherever the run stands."""
        self._grow(len(hashes))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * self.powers[: len(hashes)])])
        value = (sums[stop] - sums[first]) * self.inverses[first]
        return _mixed(value + (stop - first).astype(np.uint64) * _A)

    def anchors(self, hashes: np.ndarray) -> np.ndarray:
        """Hash of the ``gram`` words from each place (the last places: the largest hash)."""
        n, out, have = len(hashes), None, 0
        power, size = hashes, 1
        while True:
            if self.gram & size:
                out = power if out is None else _joined(out[: n - have - size + 1], power[have : n - size + 1])
                have += size
            if 2 * size > self.gram:
                break
            power = _joined(power[: len(power) - size], power[size:])
            size *= 2
        filled = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        filled[: len(out)] = out
        return filled

    def pieces(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of texts laid end to end: each piece's text, first window, number of windows, anchor, hash."""
        ends = np.cumsum(counts)
        n = len(hashes)
        if n < self.window:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
        owner = np.repeat(np.arange(len(counts)), counts)
        starts = np.flatnonzero(np.arange(n) + self.window <= ends[owner])
        gram = self.anchors(hashes)
        # First smallest of ``width`` grams from each place, by doubling.
        width, size = self.window - self.gram + 1, 1
        best = np.arange(n)

        def first_least(best: np.ndarray, shift: int) -> np.ndarray:
            a, b = best[: len(best) - shift], best[shift:]
            return np.where(gram[b] < gram[a], b, a)

        while 2 * size <= width:
            best = first_least(best, size)
            size *= 2
        if width > size:
            best = first_least(best, width - size)
        at = best[starts]
        new = np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]) if len(starts) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        windows = np.diff(np.append(begin, len(starts)))
        first = starts[begin]
        hashed = self.runs(hashes, first, first + windows + self.window - 1)
        anchor = at[begin]
        return owner[first], first, windows, gram[anchor], _mixed(hashed + (anchor - first).astype(np.uint64))


def _texts(docs: DataFrame) -> DataFrame:
    """Distinct texts with a number of their own, how many rows hold each, and two hashes."""
    return (
        docs.where("text IS NOT NULL")
        .groupBy("text")
        .agg(F.count("*").alias("n"))
        .select(
            F.monotonically_increasing_id().alias("uid"),  # fixed once written
            "n",
            F.xxhash64("text").alias("h1"),
            F.xxhash64(F.lit(1), "text").alias("h2"),
            "text",
        )
    )


def _occurrences(texts: DataFrame) -> DataFrame:
    """Every piece of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            rows = binary_column(batch, "text")
            uid, n = np.asarray(batch.column("uid")), np.asarray(batch.column("n"))
            for begin, stop in text_blocks(rows):
                split = [t.split() for t in rows[begin:stop]]
                counts = np.array([len(w) for w in split], np.int64)
                owner, first, windows, anchor, piece = hasher.pieces(hasher.words([w for s in split for w in s]), counts)
                base = (np.cumsum(counts) - counts)[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(piece.view(np.int64)),
                        pa.array(uid[begin:stop][owner]),
                        pa.array((first - base).astype(np.int32)),
                        pa.array(windows.astype(np.int32)),
                        pa.array(n[begin:stop][owner]),
                    ],
                    names=["anchor", "piece", "uid", "first", "windows", "n"],
                )

    return texts.select("uid", "n", "text").mapInArrow(
        run, "anchor long, piece long, uid long, first int, windows int, n long"
    )


def _list_field(column: pa.ListArray, name: str) -> np.ndarray:
    return np.asarray(column.values.field(name))


def _entries(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """Words of the pieces to index; those of hot anchors window by window.

    ``k1``, ``k2`` name an entry: anchor and piece, or two hashes of a window.
    """
    by_text = wanted.groupBy("uid").agg(
        F.collect_list(F.struct("first", "windows", "anchor", "piece", "n", "hot")).alias("pieces")
    )
    joined = by_text.join(texts.select("uid", "text"), "uid").select("text", "pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            column = batch.column("pieces")
            offsets = np.asarray(column.offsets).tolist()
            first, windows, anchor, piece, n, hot = (
                _list_field(column, x).tolist() for x in ("first", "windows", "anchor", "piece", "n", "hot")
            )
            out: list[tuple] = []
            size = 0
            for i, text in enumerate(binary_column(batch, "text")):
                words = text.split()
                hashes = None
                for k in range(offsets[i], offsets[i + 1]):
                    stop = first[k] + windows[k] + WINDOW_WORDS - 1
                    if not hot[k]:
                        own = b" ".join(words[first[k] : stop])
                        out.append((False, anchor[k], piece[k], n[k], windows[k], own, anchor[k], piece[k], 0))
                        size += len(own)
                        continue
                    if hashes is None:
                        hashes = hasher.words(words)
                    start = np.arange(windows[k])
                    one = hasher.runs(hashes[first[k] : stop], start, start + WINDOW_WORDS).view(np.int64)
                    two = hasher.runs(_mixed(hashes[first[k] : stop] + _C), start, start + WINDOW_WORDS).view(np.int64)
                    for j, (a, b) in enumerate(zip(one.tolist(), two.tolist())):
                        own = b" ".join(words[first[k] + j : first[k] + j + WINDOW_WORDS])
                        out.append((True, a, b, n[k], 1, own, anchor[k], piece[k], j))
                        size += len(own)
                if size > 4 << 20:
                    yield _entry_batch(out)
                    out, size = [], 0
            if out:
                yield _entry_batch(out)

    return joined.mapInArrow(run, _ENTRY)


_ENTRY = "hot boolean, k1 long, k2 long, n long, windows int, words binary, anchor long, piece long, place int"


def _entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in _ENTRY.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kinds[kind]) for values, (_, kind) in zip(zip(*rows), fields)], names=[f for f, _ in fields]
    )


def _repeats(entries: DataFrame) -> DataFrame:
    """Entries with a window that stands twice: ``hot``, ``k1``, ``k2`` and the windows' bits."""

    def shard(rows: list[tuple]) -> pa.RecordBatch | None:
        index = FMIndex([r[0].split(b" ") for r in rows], np.array([r[1] for r in rows], np.int64), WINDOW_WORDS)
        bits = index.repeats()
        found = np.flatnonzero(bits)
        if not len(found):
            return None
        keys = [rows[i][2] for i in found.tolist()]
        kinds = (pa.bool_(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [*(pa.array([k[j] for k in keys], kind) for j, kind in enumerate(kinds)), pa.array(bits[found])],
            names=["hot", "k1", "k2", "bits"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        words, last = 0, None
        for batch in batches:
            columns = (batch.column(x).to_pylist() for x in ("words", "n", "hot", "k1", "k2", "windows"))
            for text, n, hot, k1, k2, windows in zip(*columns):
                if words >= SHARD_WORDS and k1 != last:  # an anchor's pieces stay together
                    out = shard(rows)
                    if out is not None:
                        yield out
                    rows, words = [], 0
                rows.append((text, n, (hot, k1, k2)))
                words += windows + WINDOW_WORDS - 1
                last = k1
        if rows:
            out = shard(rows)
            if out is not None:
                yield out

    cold = entries.where("NOT hot").select("hot", "k1", "k2", "n", "windows", "words")
    hot = (
        entries.where("hot")
        .groupBy("k1", "k2")
        .agg(F.sum("n").alias("n"), F.first("words").alias("words"))
        .select(F.lit(True).alias("hot"), "k1", "k2", "n", F.lit(1).alias("windows"), "words")
    )
    dealt = cold.union(hot).repartition("k1").sortWithinPartitions("k1")
    return dealt.mapInArrow(run, "hot boolean, k1 long, k2 long, bits long")


def _without_repeats(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """Of every text: hashes, words, removed words, and the kept words if any was removed."""
    by_text = marks.groupBy("uid").agg(F.collect_list(F.struct("first", "bits")).alias("marks"))
    joined = texts.select("uid", "h1", "h2", "text").join(by_text, "uid", "left").select("h1", "h2", "text", "marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window_bits = np.arange(63)
        for batch in batches:
            column = batch.column("marks")
            offsets = np.asarray(column.offsets).tolist()
            first, bits = _list_field(column, "first"), _list_field(column, "bits")
            texts = binary_column(batch, "text")
            for begin, stop in text_blocks(texts):
                counts, removed, digests, kept_texts = [], [], [], []
                for i in range(begin, stop):
                    words = texts[i].split()
                    kept = words
                    own = slice(offsets[i], offsets[i + 1])
                    if offsets[i + 1] > offsets[i] and column[i].is_valid:
                        row, bit = np.nonzero((bits[own][:, None] >> window_bits) & 1)
                        at = first[own][row] + bit
                        change = np.zeros(len(words) + 1, np.int64)
                        np.add.at(change, at, 1)
                        np.add.at(change, at + WINDOW_WORDS, -1)
                        keep = np.cumsum(change[:-1]) == 0
                        kept = [words[j] for j in np.flatnonzero(keep).tolist()]
                    whole = b" ".join(kept)
                    counts.append(len(words))
                    removed.append(len(words) - len(kept))
                    digests.append(hashlib.sha256(whole).hexdigest())
                    kept_texts.append(whole.decode() if len(kept) < len(words) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("h1").slice(begin, stop - begin),
                        batch.column("h2").slice(begin, stop - begin),
                        pa.array(counts, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.array(kept_texts, pa.string()),
                    ],
                    names=["h1", "h2", "n_words", "n_removed", "kept_sha256", "kept"],
                )

    return joined.mapInArrow(run, "h1 long, h2 long, n_words long, n_removed long, kept_sha256 string, kept string")


def by_text(docs: DataFrame) -> DataFrame:
    """The result for every distinct text, named by its two hashes (stored)."""
    with _shuffles_dropped(docs.sparkSession):
        texts = stored(_texts(docs), "texts")
        every = stored(_occurrences(texts), "pieces")
        again = stored(
            every.groupBy("anchor").agg(F.sum("n").alias("total")).where("total > 1").select("anchor"), "anchors"
        )
        pieces = stored(every.join(again, "anchor"), "shared-pieces")
        distinct = stored(
            pieces.groupBy("anchor", "piece").agg(
                F.sum("n").alias("n"), F.min(F.struct("uid", "first", "windows")).alias("at")
            ),
            "distinct-pieces",
        )
        hot = stored(
            distinct.groupBy("anchor").agg(F.count("*").alias("different")).where(F.col("different") > HOT_PIECES),
            "hot-anchors",
        )
        wanted = distinct.join(hot, "anchor", "left").select(
            "anchor", "piece", "n", "at.*", F.col("different").isNotNull().alias("hot")
        )
        entries = stored(_entries(wanted, texts), "entries")
        found = stored(_repeats(entries), "repeats")
        of_hot = (
            entries.where("hot")
            .select("k1", "k2", "anchor", "piece", "place")
            .join(found.where("hot").select("k1", "k2"), ["k1", "k2"])
            .groupBy("anchor", "piece")
            .agg(F.expr("bit_or(shiftleft(CAST(1 AS BIGINT), place)) AS bits"))
        )
        bits = stored(
            found.where("NOT hot").select(F.col("k1").alias("anchor"), F.col("k2").alias("piece"), "bits").union(of_hot),
            "marked-pieces",
        )
        marks = pieces.select("anchor", "piece", "uid", "first").join(bits, ["anchor", "piece"])
        return stored(_without_repeats(texts, marks.select("uid", "first", "bits")), "kept-texts")


def _hashes() -> list:
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")]


def removed_words(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` of every row."""
    results = by_text(docs).select("h1", "h2", "n_words", "n_removed", "kept_sha256")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").isNull().alias("none"), *_hashes())
    empty = hashlib.sha256(b"").hexdigest()
    nothing = rows.where("none").select(
        "doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit(empty).alias("kept_sha256")
    )
    some = rows.where("NOT none").join(results, ["h1", "h2"])
    return some.select("doc_id", "n_words", "n_removed", "kept_sha256").union(nothing)


def deduplicated(docs: DataFrame) -> DataFrame:
    """All rows and columns; texts that lose words are their kept words, spaced.

    ``n_chars``, if there, is the new text's number of characters.
    """
    changed = by_text(docs).where("n_removed > 0").select("h1", "h2", "kept")
    named = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*named).alias("row"), "text", *_hashes())
    joined = rows.join(changed, ["h1", "h2"], "left").select("row", F.coalesce("kept", "text").alias("new"), "kept")
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("new").alias(c))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            fresh = F.char_length("new").cast(kind)
            columns.append(F.when(F.col("kept").isNotNull(), fresh).otherwise(F.col("row")[c]).alias(c))
        else:
            columns.append(F.col("row")[c].alias(c))
    return joined.select(*columns)
