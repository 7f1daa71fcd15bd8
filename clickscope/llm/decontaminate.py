"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap.

The index holds the test items: for each term its postings (item, impact) in
item order, and the largest impact of the term in every aligned block of 4
items, of 16 and of 64.  An impact is the term's BM25 weight in the item,
divided by the weight of the whole item, so that one threshold means the same
share of every item.

Every passage of every document is a query: overlapping windows of words, long
enough that any item of the table lies whole inside one, whichever block of
the index it is in.  Block maxima are the only filter: for many passages at
once the maxima of a passage's terms are added up block by block, a block whose
sum is below the threshold is skipped with everything in it, and one that is
left is opened into the four it holds.  No posting is read on the way.  In the
blocks of four items that stay open WAND moves the passage's cursors from
pivot to pivot and returns every item at or above the threshold.

A retrieved item is verified in the document: the five-word shingles of its
question (all but its last sentence) and of its answer (the last sentence; an
item of one sentence is both) have to be found to a share of 0.8 each.  A part
of fewer than five words is one shingle and is found where the document has
just these words in a row.

Equal item texts are indexed once, and their ids joined to the hits.  Texts are
dealt by hash into index blocks of a bounded size, each built and written to
the shared folder by one task; the driver sees the blocks' numbers only.
Documents are read once: a task looks each piece of its documents up in one
index after another and keeps a few of them in memory.

Defined results: null and empty documents and items match nothing; texts of any
length are cut into passages whole; items with equal scores are all returned;
repeated items are items of their own, as are repeated documents;
a null ``item_id`` or ``doc_id`` is carried as null; an empty table on either
side gives an empty result; other columns are ignored.  Memory grows with the
longest single document and the longest single item, which are never cut.
"""

from __future__ import annotations

import math
import os
import pickle
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import binary_column, shared_folder, stored, text_blocks

K1, B = 1.2, 0.75
#: Share of an item's BM25 weight that a passage has to hold.
THRESHOLD = 0.6
SHINGLE_WORDS, OVERLAP = 5, 0.8
#: Passages are at least this long and begin every half of it.
PASSAGE_WORDS = 128
#: Items in a block of the finest level; a block of a coarser level holds as many finer ones.
FAN = 4
LEVELS = 3
#: Block maxima that are added up at once (some 50 bytes each).
POSTINGS_AT_ONCE = 1_000_000
#: Bytes of test items in one index, and items at most.
INDEX_BYTES, INDEX_ITEMS = 8 << 20, 20_000
#: Indexes that a task keeps in memory; it reads others again for each piece of its documents.
KEPT_INDEXES = 4

_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_SENTENCE_END = re.compile(rb"[.!?]+\s+|\n+")


def words_of(text: bytes | None) -> list[bytes]:
    """Words of letters, digits and other than ASCII characters; A-Z lower-cased."""
    return (text or b"").translate(_WORDS).split()


class Shingles:
    """Distinct runs of five words, spaced; one run of all words if there are fewer.

    ``part & text`` are the runs of ``part`` that stand in ``text``, which is
    cut into runs of the part's size for it; the two do not change places.
    """

    def __init__(self, words: list[bytes]) -> None:
        self.words, self.size = words, min(len(words), SHINGLE_WORDS)
        self.cut: dict[int, set[bytes]] = {}

    def runs(self, size: int) -> set[bytes]:
        if size not in self.cut:
            last = len(self.words) - size if size else -1
            self.cut[size] = {b" ".join(self.words[i : i + size]) for i in range(last + 1)}
        return self.cut[size]

    def __len__(self) -> int:
        return len(self.runs(self.size))

    def __and__(self, text: Shingles) -> set[bytes]:
        return self.runs(self.size) & text.runs(self.size)


def shingles(words: list[bytes]) -> Shingles:
    """Runs of five words, spaced; all words if there are fewer."""
    return Shingles(words)


def question_and_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """Words before and in the last sentence; an item of one sentence is both."""
    parts = [w for w in map(words_of, _SENTENCE_END.split(text)) if w]
    if len(parts) < 2:
        whole = words_of(text)
        return whole, whole
    return [w for part in parts[:-1] for w in part], parts[-1]


def _spans(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions ``first[i]`` to ``first[i] + counts[i]``, one run after another."""
    return np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


class _Level:
    """Largest impacts of the terms in aligned blocks, each with the run of finer entries in it."""

    def __init__(self, terms: np.ndarray, finer: np.ndarray, most: np.ndarray, finer_blocks: int) -> None:
        self.n = -(-finer_blocks // FAN)
        key = terms.astype(np.int64) * self.n + finer // FAN  # ascending, as the finer entries are
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        self.terms, self.block = terms[starts], (finer[starts] // FAN).astype(np.int32)
        self.most = np.maximum.reduceat(most, starts)
        self.first = np.append(starts, len(key))


class ItemIndex:
    """Block-max inverted index of test items; ``idf`` gives each term's weight.

    ``longest`` is the length of the longest item of the whole table, which
    sets that of the passages; these items' own longest if it is not given.
    """

    def __init__(
        self, items: list[tuple[int | None, bytes]], idf: dict[bytes, float], mean_words: float, longest: int = 1
    ) -> None:
        self.ids, self.texts, bags = [], [], []
        for item, text in items:
            bag = Counter(words_of(text))
            if bag:
                self.ids.append(item)
                self.texts.append(text)
                bags.append(bag)
        self.longest = max(longest, *(sum(b.values()) for b in bags), 1)
        self.terms: dict[bytes, int] = {}
        terms, numbers, impacts = [], [], []
        for number, bag in enumerate(bags):
            length = K1 * (1 - B + B * sum(bag.values()) / mean_words)
            weight = {w: idf[w] * n * (K1 + 1) / (n + length) for w, n in bag.items()}
            whole = sum(weight.values())
            terms.extend(self.terms.setdefault(w, len(self.terms)) for w in weight)
            numbers.extend([number] * len(weight))
            impacts.extend(x / whole for x in weight.values())
        if not bags:
            return
        term = np.array(terms, np.int32)
        order = np.argsort(term, kind="stable")  # the postings of a term stay in item order
        term, self.items, self.impacts = term[order], np.array(numbers, np.int32)[order], np.array(impacts)[order]
        self.of_term = np.searchsorted(term, np.arange(len(self.terms) + 1))
        level = _Level(term, self.items, self.impacts, len(bags))
        self.levels = [level]  # the coarsest first
        while len(self.levels) < LEVELS:
            level = _Level(level.terms, level.block, level.most, level.n)
            self.levels.insert(0, level)
        every = np.arange(len(self.terms) + 1)
        self.top = np.searchsorted(self.levels[0].terms, every)
        self.maxima = np.diff(np.searchsorted(self.levels[-1].terms, every))  # of each term, on the finest level

    def postings(self, term: int) -> tuple[list[int], list[float]]:
        low, high = self.of_term[term], self.of_term[term + 1]
        return self.items[low:high].tolist(), self.impacts[low:high].tolist()

    def candidates(
        self, terms: np.ndarray, passages: np.ndarray, threshold: float = THRESHOLD
    ) -> Iterator[tuple[int, int, float]]:
        """Passage, item and score of every item at or above the threshold, passages ascending.

        ``terms`` and ``passages`` run side by side, each pair once, passages
        ascending.  Passages go through together until their terms have
        ``POSTINGS_AT_ONCE`` block maxima; one passage is never cut.
        """
        if not len(passages):
            return
        limit = threshold - 1e-9
        ends = np.append(np.flatnonzero(np.diff(passages)), len(passages) - 1) + 1  # of each passage
        cost = np.cumsum(self.maxima[terms])[ends - 1] + np.arange(1, len(ends) + 1) * self.levels[0].n
        begin, told = 0, 0
        while begin < len(ends):
            stop = max(begin + 1, int(np.searchsorted(cost, told + POSTINGS_AT_ONCE, side="right")))
            low, high = ends[begin - 1] if begin else 0, ends[stop - 1]
            for passage, entries in self._open(terms[low:high], passages[low:high], limit):
                for item, score in self._wand(entries, limit):
                    yield passage, item, score
            begin, told = stop, cost[stop - 1]

    def _open(self, terms: np.ndarray, passages: np.ndarray, limit: float) -> Iterator[tuple[int, list[int]]]:
        """Blocks of the finest level that block maxima leave open: a passage and its terms' entries there."""
        new = np.diff(passages, prepend=-1) != 0
        top = self.levels[0]
        counts = self.top[terms + 1] - self.top[terms]
        entry = _spans(self.top[terms], counts)
        row = np.repeat(np.cumsum(new) - 1, counts) * top.n + top.block[entry]
        owner = np.repeat(passages[new], top.n)
        for depth, level in enumerate(self.levels):
            reach = np.bincount(row, level.most[entry], len(owner)) >= limit
            stays = reach[row]
            entry, row, owner = entry[stays], (np.cumsum(reach) - 1)[row[stays]], owner[reach]
            if depth + 1 < len(self.levels):
                counts = level.first[entry + 1] - level.first[entry]
                entry, row = _spans(level.first[entry], counts), np.repeat(row, counts) * FAN
                row += self.levels[depth + 1].block[entry] % FAN
                owner = np.repeat(owner, FAN)
        order = np.argsort(row, kind="stable")
        ends = np.cumsum(np.bincount(row, minlength=len(owner))).tolist()
        entries, begin = entry[order].tolist(), 0
        for passage, end in zip(owner.tolist(), ends):
            yield passage, entries[begin:end]
            begin = end

    def _wand(self, entries: list[int], limit: float) -> Iterator[tuple[int, float]]:
        """Items of one block at or above the limit: cursors move from pivot to pivot."""
        level, cursors = self.levels[-1], []  # next item, largest impact, the postings left
        for e in entries:
            low, high = level.first[e], level.first[e + 1]
            left = list(zip(self.items[low:high].tolist(), self.impacts[low:high].tolist()))[::-1]
            cursors.append([left[-1][0], float(level.most[e]), left])
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for item, most, _ in cursors:
                bound += most
                if bound >= limit:
                    pivot = item
                    break
            if pivot < 0:
                return
            if cursors[0][0] == pivot:
                score = sum(left[-1][1] for item, _, left in cursors if item == pivot)
                if score >= limit:
                    yield pivot, score
                pivot += 1
            for cursor in cursors:
                left = cursor[2]
                while left and left[-1][0] < pivot:
                    left.pop()
                cursor[0] = left[-1][0] if left else -1
            cursors = [c for c in cursors if c[0] >= 0]

    def search(self, terms: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """Every item at or above the threshold, for one passage of these terms."""
        one = np.array(terms, np.int64)
        return [(item, score) for _, item, score in self.candidates(one, np.zeros(len(one), np.int64), threshold)]

    def matches(self, texts: list[bytes | None]) -> list[list[tuple[int, float, float, float]]]:
        """For each text its verified items: number, best score, both overlaps."""
        return self.matches_of_words([words_of(t) for t in texts])

    def matches_of_words(self, split: list[list[bytes]]) -> list[list[tuple[int, float, float, float]]]:
        """The same for texts that are cut into words already."""
        out: list[list[tuple[int, float, float, float]]] = [[] for _ in split]
        if not self.ids:
            return out
        counts = np.array([len(w) for w in split], np.int64)
        get = self.terms.get
        ids = np.fromiter((get(w, -1) for words in split for w in words), np.int64, int(counts.sum()))
        half = max(PASSAGE_WORDS // 2, self.longest)
        # Passage k of a text is its words from k * half to (k + 2) * half.
        passages_each = np.maximum(-(-counts // half) - 1, 1)
        base = np.cumsum(passages_each) - passages_each
        begins = np.cumsum(counts) - counts
        text_of = np.repeat(np.arange(len(split)), counts)
        half_of = (np.arange(len(ids)) - begins[text_of]) // half
        known = np.flatnonzero(ids >= 0)
        owner, part = text_of[known], half_of[known]
        pairs = []
        for back in (0, 1):  # a word is in the passage that begins in its half, and in the one before
            k = part - back
            ok = (k >= 0) & (k < passages_each[owner])
            pairs.append((base[owner[ok]] + k[ok]) * len(self.terms) + ids[known[ok]])
        held = np.unique(np.concatenate(pairs))
        best: dict[int, dict[int, float]] = {}
        for passage, item, score in self.candidates(held % len(self.terms), held // len(self.terms)):
            of_text = best.setdefault(int(np.searchsorted(base, passage, side="right")) - 1, {})
            of_text[item] = max(score, of_text.get(item, 0.0))
        for text, found in best.items():
            there = shingles(split[text])
            for item, score in sorted(found.items()):
                parts = map(shingles, question_and_answer(self.texts[item]))
                overlaps = [len(p & there) / len(p) for p in parts]
                if min(overlaps) >= OVERLAP:
                    out[text].append((item, min(score, 1.0), *overlaps))
        return out


def _index_items(items: DataFrame) -> tuple[str, list[int], DataFrame]:
    """Write the indexes; returns their folder, their numbers and ``text_id``, ``item_id`` of the items.

    Term statistics are over all items, repeated ones included.
    """

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, terms, copies = [], [], []
            for block, n, text in zip(
                batch.column("block").to_pylist(), batch.column("copies").to_pylist(), binary_column(batch, "text")
            ):
                own = sorted(set(words_of(text)))
                terms.extend(own)
                blocks.extend([block] * len(own))
                copies.extend([n] * len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(terms, pa.binary()), pa.array(copies, pa.int64())],
                names=["block", "term", "n"],
            )

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [len(words_of(t)) for t in binary_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64()), batch.column("copies")], names=["n", "copies"])

    texts = stored(items.where("text IS NOT NULL").groupBy("text").agg(F.count("*").alias("copies")), "items")
    size = F.octet_length("text").cast("long")
    total = texts.agg(F.sum(size).alias("bytes"), F.count("*").alias("n")).first()
    blocks = max(1, -(-(total["bytes"] or 0) // INDEX_BYTES), -(-total["n"] // INDEX_ITEMS))
    keyed = texts.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)))
    shape = (
        texts.mapInArrow(lengths, "n long, copies long")
        .where("n > 0")
        .agg(F.sum("copies").alias("items"), F.sum(F.col("n") * F.col("copies")).alias("words"), F.max("n").alias("longest"))
        .first()
    )
    folder = shared_folder(items.sparkSession, "item-indexes")
    if not shape["items"]:
        return folder, [], items.select(F.lit(0).cast("long").alias("text_id"), "item_id").limit(0)
    count, mean, longest = shape["items"], shape["words"] / shape["items"], shape["longest"]

    def build(own: pd.DataFrame, frequency: pd.DataFrame) -> pd.DataFrame:
        if own.empty:
            return pd.DataFrame({"block": [], "text_id": [], "text": []})
        block = int(own["block"].iloc[0])
        rows = sorted(own["text"], key=str.encode)
        ids = [(block << 32) + k for k in range(len(rows))]
        idf = {
            bytes(w): math.log(1 + (count - n + 0.5) / (n + 0.5)) for w, n in zip(frequency["term"], frequency["n"])
        }
        index = ItemIndex([(i, t.encode()) for i, t in zip(ids, rows)], idf, mean, longest)
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"{root}/.{block}-{TaskContext.get().taskAttemptId()}-{os.getpid()}"
        with store.open_output_stream(name) as out:
            out.write(pickle.dumps(index, protocol=5))
        store.move(name, f"{root}/{block}")  # a task that runs again writes the same index
        return pd.DataFrame({"block": block, "text_id": ids, "text": rows})

    in_blocks = stored(
        keyed.mapInArrow(bags, "block long, term binary, n long").groupBy("block", "term").agg(F.sum("n").alias("n")), "terms"
    )
    everywhere = in_blocks.groupBy("term").agg(F.sum("n").alias("n"))
    frequency = in_blocks.select("block", "term").join(everywhere, "term")
    built = stored(
        keyed.select("block", "text")
        .groupBy("block")
        .cogroup(frequency.groupBy("block"))
        .applyInPandas(build, "block long, text_id long, text string"),
        "built",
    )
    numbers = sorted(r["block"] for r in built.select("block").distinct().collect())  # a number for each index
    return folder, numbers, stored(items.join(built, "text").select("text_id", "item_id"), "item-ids")


def _reader(folder: str, numbers: list[int]) -> Callable[[], Iterator[ItemIndex]]:
    """One index after another, as often as it is called; the first few stay in memory."""
    kept: dict[int, ItemIndex] = {}

    def read() -> Iterator[ItemIndex]:
        store, root = fs.FileSystem.from_uri(folder)
        for number in numbers:
            index = kept.get(number)
            if index is None:
                with store.open_input_stream(f"{root}/{number}") as file:
                    index = pickle.loads(file.read())
                if len(kept) < KEPT_INDEXES:
                    kept[number] = index
            yield index

    return read


def _plain(items: DataFrame) -> DataFrame:
    return items.select(F.col("item_id").cast("long").alias("item_id"), "text")


HIT_SCHEMA = "doc_id long, text_id long, score double, question_overlap double, answer_overlap double"
SCHEMA = HIT_SCHEMA.replace("text_id", "item_id")


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row for every document and test item whose question and answer it holds."""
    folder, numbers, names = _index_items(_plain(items))
    if not numbers:
        return docs.sparkSession.createDataFrame([], SCHEMA)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = _reader(folder, numbers)
        for batch in batches:
            texts, ids = binary_column(batch, "text"), batch.column("doc_id").to_pylist()
            hits = []
            for begin, stop in text_blocks(texts):
                split = [words_of(t) for t in texts[begin:stop]]
                for index in indexes():
                    for doc, found in zip(ids[begin:stop], index.matches_of_words(split)):
                        hits.extend((doc, index.ids[item], *rest) for item, *rest in found)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([h[i] for h in hits], kind) for i, kind in enumerate(kinds)],
                names=[c.split()[0] for c in HIT_SCHEMA.split(", ")],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (
        rows.mapInArrow(find, HIT_SCHEMA).join(names, "text_id").select(*(c.split()[0] for c in SCHEMA.split(", ")))
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, whose text holds no test item; one map over the rows."""
    folder, numbers, _ = _index_items(_plain(items))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = _reader(folder, numbers)
        for batch in batches:
            texts, keep = binary_column(batch, "text"), []
            for begin, stop in text_blocks(texts):
                split = [words_of(t) for t in texts[begin:stop]]
                left = [True] * len(split)
                for index in indexes():
                    left = [ok and not found for ok, found in zip(left, index.matches_of_words(split))]
                keep.extend(left)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
