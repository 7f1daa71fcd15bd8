from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickscope.llm import bpe
from clickscope.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def coder():
    return bpe.WordBpe(vocabulary_path())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


PIECES = ["a", "b", "aaaa", "lll", "!!!", "9", " ", "  ", "'s", "'re", "é", "É", "é", "İ", "Σ",
          "<|endoftext|>", "<|startoftext|>", "\n", " ", " ", "\x1c", "你", "\U0001f600", "ing", "The", "×"]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=25), st.lists(st.sampled_from(PIECES), max_size=12).map("".join)))
def test_same_as_the_library(text):
    coder, library = _CODERS()
    want = library.encode(text, add_special_tokens=False).ids
    ids, decoded = coder.encode_decode(text.encode())
    got = np.frombuffer(ids, "<u4").tolist()
    assert got == want
    assert decoded.decode() == library.decode(want, skip_special_tokens=False) == coder.decode(got)


_made = []


def _CODERS():
    if not _made:
        _made.append((bpe.WordBpe(vocabulary_path()), tokenizers.Tokenizer.from_file(vocabulary_path())))
    return _made[0]


def test_merge_gadgets_on_a_small_vocabulary():
    # ab, then aba is reached by (ab)(a); aa merges from the left
    vocab = {x: i for i, x in enumerate(["a", "b", "aa", "ab", "aba"])}
    automaton = bpe.MergeAutomaton(vocab, [("a", "a"), ("a", "b"), ("ab", "a")])
    table = automaton.spellings({"a", "b"})

    def merged(word):
        symbols = list(word)
        for u, v in [("a", "a"), ("a", "b"), ("ab", "a")]:
            i, out = 0, []
            while i < len(symbols):
                if symbols[i : i + 2] == [u, v]:
                    out.append(u + v)
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    for n in range(1, 9):
        for k in range(2**n):
            word = "".join("ab"[(k >> j) & 1] for j in range(n))
            path = [automaton.label[t] for t in automaton.encode(word, n, table)]
            assert path == merged(word), word


def test_every_row(awkward, library):
    rows = bpe.digest_documents(awkward, vocabulary_path()).collect()
    want = []
    for r in awkward.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_ids_and_texts(awkward, coder):
    for r in bpe.encode_documents(awkward, vocabulary_path()).collect():
        assert r.n_tokens == len(r.ids) and coder.decode(r.ids) == r.decoded


def test_empty_table(nothing):
    assert bpe.digest_documents(nothing, vocabulary_path()).count() == 0
