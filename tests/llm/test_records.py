from __future__ import annotations

import os
import zlib

import numpy as np
import pytest

from clickscope.llm import records
from clickscope.llm.crc import crc32c, masked
from clickscope.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


def _slow(data: bytes) -> int:
    c = 0xFFFFFFFF
    for x in data:
        c ^= x
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def test_checksums():
    assert crc32c([b"123456789"])[0] == 0xE3069283
    strings = [os.urandom(n) for n in (0, 1, 7, 8, 255, 256, 257, 1000, 3000)]
    assert crc32c(strings).tolist() == [_slow(s) for s in strings]
    assert crc32c([]).tolist() == []
    crc = np.array([0x12345678], np.uint32)
    assert masked(crc)[0] == (((0x12345678 >> 15) | (0x12345678 << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_frames_and_damage():
    payloads = [b"one", b"", b"x" * 1000]
    framed = records.frame(payloads)
    block = b"".join(framed)
    sizes = np.array([len(p) for p in payloads])
    offsets = np.cumsum(sizes + 16) - sizes - 4
    assert records.unframe(block, offsets, sizes) == payloads
    assert records.unframe(block, offsets[[2, 0]], sizes[[2, 0]]) == [payloads[2], payloads[0]]  # any order
    for at in (0, 9, 13, len(block) - 1):
        wrong = bytearray(block)
        wrong[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(wrong), offsets, sizes)


def _want(rows):
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    return {
        (r.doc_id, r.text): library.encode(r.text or "", add_special_tokens=False).ids + [1] for r in rows
    }


def test_files_hold_every_document_in_order(awkward):
    got = records.id_checksums(records.encode_to_records(awkward, vocabulary_path(), 1)).collect()
    ids = _want(awkward.collect())
    want = sorted(
        (r.doc_id is not None, r.doc_id or 0, len(ids[r.doc_id, r.text]),
         zlib.crc32(np.array(ids[r.doc_id, r.text], "<u4").tobytes()))
        for r in awkward.collect()
    )
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *(r.n_tokens for r in ordered)])[:-1].tolist()
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert keys == sorted(keys)  # null ids first, then ascending


def test_rerun_replaces_a_file(spark, awkward, tmp_path):
    folder = f"file://{tmp_path}/records"
    first = records.write_records(awkward, vocabulary_path(), folder, 1)
    before = {p.name: p.read_bytes() for p in (tmp_path / "records").iterdir()}
    assert records.write_records(awkward, vocabulary_path(), folder, 1) == first
    assert {p.name: p.read_bytes() for p in (tmp_path / "records").iterdir()} == before


def test_empty_table(nothing):
    assert records.encode_to_records(nothing, vocabulary_path(), 1).count() == 0
