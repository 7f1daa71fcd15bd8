"""Token ids as length-delimited binary records with an offset index.

A file holds one record after another: the payload's length (8 bytes), the
masked CRC-32C of those 8 bytes, the payload, the masked CRC-32C of the
payload.  A payload is one document's sequence: the bytes each id takes (2 or
4), whether there is a ``doc_id``, the ``doc_id``, the ids; all little-endian.
Beside it stands the index: offset and length (8 bytes each) of every payload,
so records can be read in any order.

Rows are range-partitioned by ``doc_id`` and sorted inside a partition, so
the files in order hold the documents in ascending order.  A task writes under
a name of its own and renames at the end: a task that runs again after a lost
executor replaces the file by the same bytes.

Defined results: null and empty texts give just the end id; rows with a null
``doc_id`` come first; rows with equal ``doc_id`` are ordered by their text's
hash; whole texts of any length are one record; an empty table gives no file
and an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.llm.common import binary_column, shared_folder, text_blocks
from clickscope.llm.crc import crc32c, masked
from clickscope.llm.wordsplit import WordSplitter

_HEAD = "<BBq"
_HEAD_BYTES = struct.calcsize(_HEAD)
_READ_BYTES = 4 << 20


class LibraryCoder:
    """Ids as the tokenizers library gives them; words it has seen are remembered."""

    def __init__(self, path: str) -> None:
        self.splitter = WordSplitter(path, self._word)
        library = self.splitter.library
        self.width = 2 if library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self._model = library.model
        self._letters = library.pre_tokenizer
        from clickscope.llm.bpe import byte_alphabet

        self._letter = byte_alphabet()

    def _word(self, word: str | int) -> bytes:
        if isinstance(word, int):
            ids = [word]
        else:
            spelled = word if word.isascii() and word.isprintable() else "".join([self._letter[b] for b in word.encode()])
            ids = [t.id for t in self._model.tokenize(spelled)]
        return b"".join([i.to_bytes(self.width, "little") for i in ids])

    def encode(self, text: bytes) -> bytes:
        return b"".join(self.splitter.values(text))


def frame(payloads: list[bytes]) -> list[bytes]:
    """One record for each payload."""
    sizes = [len(p).to_bytes(8, "little") for p in payloads]
    size_sums = masked(crc32c(sizes)).astype("<u4")
    sums = masked(crc32c(payloads)).astype("<u4")
    return [
        b"".join((s, a.tobytes(), p, b.tobytes())) for s, a, p, b in zip(sizes, size_sums, payloads, sums)
    ]


def unframe(block: bytes, offsets: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Payloads at the given offsets of ``block``; raises on any wrong checksum."""
    heads = [block[o - 12 : o - 4] for o in offsets.tolist()]
    payloads = [block[o : o + n] for o, n in zip(offsets.tolist(), sizes.tolist())]
    said = [
        np.frombuffer(b"".join(block[o : o + 4] for o in at.tolist()), "<u4") for at in (offsets - 4, offsets + sizes)
    ]
    if (
        heads != [n.to_bytes(8, "little") for n in sizes.tolist()]
        or (masked(crc32c(heads)) != said[0]).any()
        or (masked(crc32c(payloads)) != said[1]).any()
    ):
        raise ValueError("a record's checksum or length is wrong")
    return payloads


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_records(docs: DataFrame, path: str, folder: str, end_id: int) -> list[dict]:
    """Write the record files and their indexes; returns the manifest by part.

    The manifest has one entry for each file: as many as there are partitions.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        coder = LibraryCoder(path)
        end = end_id.to_bytes(coder.width, "little")
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        own = f"{root}/.part-{part:06d}-{TaskContext.get().taskAttemptId()}-{os.getpid()}"
        index: list[np.ndarray] = []
        at = tokens = 0
        with store.open_output_stream(f"{own}.rec") as out:
            for batch in (b for some in ([first], batches) for b in some):
                texts, ids = binary_column(batch, "text"), batch.column("doc_id").to_pylist()
                for begin, stop in text_blocks(texts):
                    payloads = [
                        struct.pack(_HEAD, coder.width, doc is not None, doc or 0) + coder.encode(text or b"") + end
                        for doc, text in zip(ids[begin:stop], texts[begin:stop])
                    ]
                    sizes = np.array([len(p) for p in payloads], np.int64)
                    ends = at + np.cumsum(sizes + 16)
                    index.append(np.stack([ends - sizes - 4, sizes], axis=1))
                    at = int(ends[-1])
                    tokens += int((sizes - _HEAD_BYTES).sum()) // coder.width
                    out.write(b"".join(frame(payloads)))
        with store.open_output_stream(f"{own}.idx") as out:
            out.write(np.concatenate(index).astype("<i8").tobytes())
        for kind in ("idx", "rec"):
            store.move(f"{own}.{kind}", f"{root}/part-{part:06d}.{kind}")
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([tokens])], names=["part", "n_tokens"])

    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
    )
    parts = rows.mapInArrow(write, "part long, n_tokens long").collect()
    return sorted(({"part": r["part"], "n_tokens": r["n_tokens"]} for r in parts), key=lambda p: p["part"])


def read_records(spark: SparkSession, folder: str, manifest: list[dict]) -> DataFrame:
    """Every document of the files: ``doc_id``, ``start``, ``ids`` (raw bytes), ``width``."""
    starts = np.cumsum([0, *(p["n_tokens"] for p in manifest)]).tolist()
    rows = [(p["part"], int(s)) for p, s in zip(manifest, starts)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        for batch in batches:
            for part, start in zip(batch.column("part").to_pylist(), batch.column("start").to_pylist()):
                with store.open_input_stream(f"{root}/part-{part:06d}.idx") as file:
                    index = np.frombuffer(file.read(), "<i8").reshape(-1, 2)
                with store.open_input_file(f"{root}/part-{part:06d}.rec") as file:
                    begin = 0
                    while begin < len(index):
                        low = int(index[begin, 0]) - 12
                        stop = int(np.searchsorted(index[:, 0], low + _READ_BYTES))
                        stop = max(stop, begin + 1)
                        high = int(index[stop - 1].sum()) + 4
                        file.seek(low)
                        payloads = unframe(file.read(high - low), index[begin:stop, 0] - low, index[begin:stop, 1])
                        heads = [struct.unpack_from(_HEAD, p) for p in payloads]
                        ids = [p[_HEAD_BYTES :] for p in payloads]
                        counts = [len(i) // h[0] for i, h in zip(ids, heads)]
                        ends = start + np.cumsum(counts)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([h[2] if h[1] else None for h in heads], pa.int64()),
                                pa.array(ends - np.array(counts, np.int64), pa.int64()),
                                pa.array(ids, pa.binary()),
                                pa.array([h[0] for h in heads], pa.int32()),
                            ],
                            names=["doc_id", "start", "ids", "width"],
                        )
                        start = int(ends[-1])
                        begin = stop

    parts = spark.createDataFrame(rows, "part long, start long").repartition(max(1, len(rows)))
    return parts.mapInArrow(read, "doc_id long, start long, ids binary, width int")


def id_checksums(records: DataFrame) -> DataFrame:
    """``n_tokens`` and the crc32 of the ids as 32-bit integers, for every record."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sums = [], []
            for ids, width in zip(batch.column("ids").to_pylist(), batch.column("width").to_pylist()):
                wide = np.frombuffer(ids, f"<u{width}").astype("<u4")
                counts.append(len(wide))
                sums.append(zlib.crc32(wide.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return records.mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_to_records(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Write all documents to record files in the shared folder and read them back."""
    folder = shared_folder(docs.sparkSession, "token-records")
    manifest = write_records(docs, path, folder, end_id)
    return read_records(docs.sparkSession, folder, manifest)
