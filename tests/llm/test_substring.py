from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from clickscope.llm import substring as S
from clickscope.llm.fmindex import FMIndex, WaveletMatrix
from tests.llm.conftest import make_docs, prose


def _brute(texts):
    """Words, removed words and kept text of each text."""
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + 35]) for w in split for i in range(len(w) - 34))
    out = []
    for words in split:
        keep = np.ones(len(words), bool)
        for i in range(len(words) - 34):
            if seen[tuple(words[i : i + 35])] > 1:
                keep[i : i + 35] = False
        kept = b" ".join(w for w, k in zip(words, keep) if k)
        out.append((len(words), int((~keep).sum()), kept))
    return out


def test_wavelet_ranks():
    r = np.random.default_rng(1)
    for symbols in (1, 2, 5, 64, 300):
        sequence = r.integers(0, symbols, 500)
        matrix = WaveletMatrix(sequence, symbols)
        symbol, at = r.integers(0, symbols, 400), r.integers(0, 501, 400)
        got = matrix.place(symbol, at) - matrix.begin[symbol]
        assert got.tolist() == [int((sequence[:i] == s).sum()) for s, i in zip(symbol, at)]


@pytest.mark.parametrize("depth", [1, 2, 3, 5, 8, 9])
def test_matching_statistics_against_counting(depth):
    r = random.Random(depth)
    passages = [[r.choice([b"a", b"b", b"c"]) for _ in range(r.randrange(depth, depth + 25))] for _ in range(30)]
    weights = np.array([r.choice([1, 1, 1, 3]) for _ in passages])
    seen = Counter()
    for p, w in zip(passages, weights):
        for i in range(len(p) - depth + 1):
            seen[tuple(p[i : i + depth])] += int(w)
    want = [sum(1 << i for i in range(len(p) - depth + 1) if seen[tuple(p[i : i + depth])] > 1) for p in passages]
    assert FMIndex(passages, weights, depth).repeats().tolist() == want


def test_equal_windows_have_equal_anchors():
    hasher = S.Hasher()
    words = prose(5, 400).encode().split()
    texts = [words, words[100:300], [b"x"] * 20 + words[150:260] + [b"y"] * 20, [b"la"] * 90, words[:34], []]
    hashes = hasher.words([w for t in texts for w in t])
    counts = np.array([len(t) for t in texts])
    base = np.cumsum(counts) - counts
    anchor_of = {}
    covered = Counter()
    for owner, first, windows, anchor, _ in zip(*(x.tolist() for x in hasher.pieces(hashes, counts))):
        for k in range(windows):
            at = first + k - base[owner]
            window = tuple(texts[owner][at : at + 35])
            assert len(window) == 35
            assert anchor_of.setdefault(window, anchor) == anchor
            covered[owner] += 1
    assert [covered[i] for i in range(len(texts))] == [max(0, len(t) - 34) for t in texts]


@pytest.mark.parametrize("hot", [0, 2, 256])
def test_every_row(spark, awkward, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT_PIECES", hot)
    if hot == 2:
        monkeypatch.setattr(S, "SHARD_WORDS", 100)
    rows = awkward.collect()
    want = sorted(
        (str(r.doc_id), n, gone, hashlib.sha256(kept).hexdigest())
        for r, (n, gone, kept) in zip(rows, _brute([r.text for r in rows]))
    )
    got = S.removed_words(awkward).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert sum(r.n_removed for r in got) > 400


def test_passage_shared_by_many_texts(spark):
    shared = prose(1, 50)
    texts = [f"{prose(10 + i, 30)} {shared} {prose(900 + i, 30)}" for i in range(300)]
    docs = make_docs(spark, list(enumerate(texts)))
    want = _brute(texts)
    got = {r.doc_id: r for r in S.removed_words(docs).collect()}  # 300 different pieces: over HOT_PIECES
    assert [(got[i].n_words, got[i].n_removed, got[i].kept_sha256) for i in range(300)] == [
        (n, gone, hashlib.sha256(kept).hexdigest()) for n, gone, kept in want
    ]


def test_documents_without_repeats(spark, awkward, nothing):
    rows = awkward.collect()
    out = S.deduplicated(awkward)
    assert out.columns == awkward.columns and out.dtypes == awkward.dtypes
    want = []
    for r, (_, gone, kept) in zip(rows, _brute([r.text for r in rows])):
        own = r.asDict()
        if gone:
            own["text"], own["n_chars"] = kept.decode(), len(kept.decode())
        want.append(str(sorted(own.items(), key=str)))
    assert sorted(str(sorted(r.asDict().items(), key=str)) for r in out.collect()) == sorted(want)
    assert S.removed_words(nothing).count() == 0 and S.deduplicated(nothing).count() == 0
