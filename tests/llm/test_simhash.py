from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from clickscope.llm import simhash as S
from tests.llm.conftest import make_docs, prose


def _slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _roots(values):
    """Position of the first member of each value's component, by brute force."""
    root = list(range(len(values)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(values))]


@pytest.mark.parametrize("text", [None, "", " \t ", "One", "one TWO", "a b c", "É é É x", "la " * 50, prose(3, 400)])
def test_fingerprint(text):
    assert S.fingerprint(None if text is None else text.encode()) == _slow_fingerprint(text)


@pytest.mark.parametrize("count", [2, 10, 300, 3000])
def test_lists_short_and_long(count):
    r = random.Random(count)
    free = (2, 5)
    values = {(0x1122330000440000 | r.randrange(256) << 16 | r.randrange(256) << 40) for _ in range(count)}
    fps = np.array(sorted(values), np.uint64)
    label = S.linked_in_list(fps, free, 6, 2)
    want = _roots([int(x) for x in fps]) if len(fps) <= 300 else None
    if want is not None:
        assert label.tolist() == want
    else:
        assert label.tolist() == S_direct(fps)


def S_direct(fps):
    label = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    while True:
        low = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (low == label).all():
            return label.tolist()
        label = low


def test_components_of_planted_fingerprints(spark):
    r = random.Random(9)
    values = set()
    for _ in range(12):
        base = r.getrandbits(64)
        values.add(base)
        for _ in range(15):
            base ^= 1 << r.randrange(64)
            base ^= 1 << r.randrange(64)
            values.add(base)
    values = sorted(values)
    rows = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    got = {r.fp % (1 << 64): r.root for r in S.class_components(rows).collect()}
    want = _roots(values)
    assert len(got) == len(values)
    names = {}
    for v, root in zip(values, want):
        assert names.setdefault(root, got[v]) == got[v]
    assert len(set(names.values())) == len(names)


def _want(rows):
    rows = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0))
    roots = _roots([_slow_fingerprint(r.text) for r in rows])
    return rows, roots


def test_every_row(awkward):
    rows, roots = _want(awkward.collect())
    want = sorted((str(r.doc_id), _slow_fingerprint(r.text), str(rows[root].doc_id)) for r, root in zip(rows, roots))
    got = S.near_duplicates(awkward).collect()
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got) == want


def test_one_row_of_each_group(spark, awkward, nothing):
    rows, roots = _want(awkward.collect())
    kept = S.first_of_each(awkward)
    assert kept.columns == awkward.columns
    got = kept.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(rows[i].doc_id) for i in set(roots))
    source = awkward.collect()
    assert all(r in source for r in got)
    assert S.first_of_each(nothing).count() == 0 and S.near_duplicates(nothing).count() == 0


def test_many_copies_of_one_text(spark):
    docs = make_docs(spark, [(i, "same words here again") for i in range(200)] + [(500, "other words stand here")])
    got = {r.doc_id: r.component_id for r in S.near_duplicates(docs).collect()}
    assert set(got.values()) == {0, 500}
    assert S.first_of_each(docs).count() == 2
