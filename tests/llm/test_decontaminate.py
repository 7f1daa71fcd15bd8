from __future__ import annotations

import math
import random
import subprocess
import sys
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from clickscope.llm import decontaminate as C
from clickscope.llm.queries import op10_decontaminate
from tests.conftest import sf_dir
from tests.llm.conftest import make_docs, prose

ROOT = Path(__file__).resolve().parents[2]


def _index(items):
    df = Counter(w for _, t in items for w in set(C.words_of(t)))
    n = len(items)
    idf = {w: math.log(1 + (n - v + 0.5) / (v + 0.5)) for w, v in df.items()}
    return C.ItemIndex(items, idf, sum(len(C.words_of(t)) for _, t in items) / n)


def _items(count, seed=0):
    return [(i, f"{prose(seed + i, 12)}. {prose(500 + seed + i, 8)}".encode()) for i in range(count)]


@pytest.mark.parametrize("threshold", [0.9, 0.6, 0.3, 0.1])
def test_wand_returns_what_full_scoring_returns(threshold):
    index = _index(_items(120))
    r = random.Random(7)
    found = 0
    for _ in range(60):
        words = prose(r.randrange(10_000), 60).encode().split() + C.words_of(r.choice(_items(120))[1])[: r.randrange(30)]
        terms = sorted({index.terms[w] for w in words if w in index.terms})
        full = Counter()
        for t in terms:
            for item, x in zip(*index.postings(t)):
                full[item] += x
        want = {i: s for i, s in full.items() if s >= threshold - 1e-9}
        got = dict(index.search(terms, threshold))
        assert got.keys() == want.keys()
        assert all(abs(got[i] - want[i]) < 1e-9 for i in got)
        found += len(got)
    assert found


def _brute(text, items):
    there = C.shingles(C.words_of(text))
    out = set()
    for item, t in items:
        parts = [C.shingles(p) for p in C.question_and_answer(t)]
        if all(p and len(p & there) / len(p) >= C.OVERLAP for p in parts):
            out.add(item)
    return out


def test_documents_against_brute_force():
    items = _items(40) + [(90, b"one two three four"), (91, b"word"), (92, b""), (93, prose(8, 300).encode())]
    index = _index([i for i in items if i[1]])
    r = random.Random(3)
    texts = [None, b"", prose(1, 20_000).encode(), b"one two three four", b"a word here"]
    for i in range(60):
        words = prose(2000 + i, r.randrange(0, 400)).split()
        own = items[r.randrange(len(items))][1].decode().split()
        if i % 3 == 0:
            own[len(own) // 2 : len(own) // 2 + 1] = []  # a near copy
        at = r.randrange(len(words) + 1)
        texts.append(" ".join(words[:at] + own + words[at:]).encode())
    got = [{index.ids[m[0]] for m in found} for found in index.matches(texts)]
    assert got == [_brute(t, items) for t in texts]
    assert sum(map(len, got)) > 30


def test_query_against_brute_force(spark):
    got = {(r.doc_id, r.item_id) for r in op10_decontaminate(spark, sf_dir("0.001")).collect()}
    items = [(r.item_id, r.text.encode()) for r in spark.read.parquet(f"{sf_dir('0.001')}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf_dir('0.001')}/documents.parquet").collect()
    assert got == {(d.doc_id, i) for d in docs for i in _brute(d.text.encode(), items)}


def test_several_index_blocks_give_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, t.decode()) for i, t in _items(30)] + [(None, None), (77, ""), (3, "x y")], "item_id long, text string")
    docs = make_docs(spark, [(i, prose(i, 30) + " " + t.decode()) for i, t in _items(30)[:6]] + [(50, None), (None, "x y")])

    def found():
        return sorted((str(r.doc_id), str(r.item_id), round(r.score, 9)) for r in C.contaminated(docs, items).collect())

    whole = found()
    monkeypatch.setattr(C, "INDEX_ITEMS", 9)
    assert found() == whole and len(whole) == 7


def test_awkward_rows_and_empty_tables(spark, awkward, nothing):
    items = spark.createDataFrame([(1, prose(1, 60))], "item_id long, text string")
    hits = C.contaminated(awkward, items).collect()
    assert sorted(str(r.doc_id) for r in hits) == sorted(["1", "5", "6", "6", "None"])
    kept = C.without_contaminated(awkward, items)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 5
    assert C.contaminated(nothing, items).count() == 0
    assert C.contaminated(awkward, items.limit(0)).count() == 0
    assert C.without_contaminated(awkward, items.limit(0)).count() == awkward.count()


def _stands_in(part, words):
    """Share of the part's runs of five words, or of all its words if fewer, that the text has in a row."""
    n = min(5, len(part))
    runs = {" ".join(part[i : i + n]) for i in range(len(part) - n + 1)}
    text = f" {' '.join(words)} "
    return sum(f" {run} " in text for run in runs) / len(runs)


@pytest.mark.parametrize("asked", [1, 2, 3, 4, 5, 9])
@pytest.mark.parametrize("answered", [1, 2, 3, 4, 5, 9])
def test_items_with_short_parts_are_found(asked, answered):
    question, answer = ([f"{side}{i}" for i in range(n)] for side, n in (("q", asked), ("a", answered)))
    before, after = prose(1, 90).split(), prose(2, 90).split()
    others = _items(20)
    index = _index([(7, f"{' '.join(question)}? {' '.join(answer)}.".encode()), *others])
    texts = [
        before + question + answer + after,
        question + answer,
        before + answer + after[:9] + question,
        before + question + answer[:-1] + after,  # the answer's last word is not there
        before + question[1:] + answer + after,
        before + question + answer[::-1] + after,
        before + [w + "x" for w in question + answer],
    ]
    got = [{index.ids[m[0]] for m in found} for found in index.matches([" ".join(t).encode() for t in texts])]
    want = [{7} if min(_stands_in(question, t), _stands_in(answer, t)) >= 0.8 else set() for t in texts]
    assert got == want and all(want[:3])


def test_whole_items_of_one_to_four_words_are_found():
    items = [(n, " ".join(f"s{n}{i}" for i in range(n)).encode()) for n in (1, 2, 3, 4)]
    index = _index(items + _items(20))
    for n, text in items:
        assert [index.ids[m[0]] for m in index.matches([b"some words before " + text + b" and behind it"])[0]] == [n]


def test_query_finds_what_plain_lists_find(spark):
    found = {(r.doc_id, r.item_id) for r in op10_decontaminate(spark, sf_dir("0.001")).collect()}
    items = [(r.item_id, r.text.encode()) for r in spark.read.parquet(f"{sf_dir('0.001')}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf_dir('0.001')}/documents.parquet").collect()
    docs = [(r.doc_id, [w.decode() for w in C.words_of(r.text.encode())]) for r in docs]
    want, short = set(), 0
    for item, text in items:
        parts = [[w.decode() for w in part] for part in C.question_and_answer(text)]
        for doc, words in docs:
            if all(_stands_in(p, words) >= 0.8 for p in parts):
                want.add((doc, item))
                short += min(map(len, parts)) < 5
    assert found == want and short


def test_block_cuts_do_not_change_how_far_apart_the_parts_may_stand(spark, monkeypatch):
    # The long item makes passages of 600 words, in which a short item's parts stand 250 words apart.
    short = [(i, f"{prose(600 + i, 12)}. {prose(700 + i, 8)}") for i in range(12)]
    items = spark.createDataFrame([*short, (90, prose(9, 300))], "item_id long, text string")
    apart = [(i, t.replace(". ", f" {'filler ' * 250}")) for i, t in short]
    docs = make_docs(spark, apart)

    def found():
        return sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in C.contaminated(docs, items).collect())

    whole = found()
    assert [(d, i) for d, i, _ in whole] == [(i, i) for i, _ in short]
    monkeypatch.setattr(C, "INDEX_ITEMS", 4)
    assert found() == whole
    kept = C.without_contaminated(docs, items)
    assert kept.count() == 0


def test_many_items_in_bounded_memory():
    """20,000 items and 60,000 Zipf words in one block: what is planted, in bounded memory."""
    r = np.random.default_rng(5)
    shares = 1 / np.arange(1, 60_001)
    ranks = r.choice(60_000, 20_000 * 30 + 60_000, p=shares / shares.sum())
    words = np.char.add("w", ranks.astype(str)).tolist()
    items = [(k, (" ".join(words[30 * k : 30 * k + 22]) + ". " + " ".join(words[30 * k + 22 : 30 * k + 30])).encode())
             for k in range(20_000)]
    index = _index(items)
    rest = words[600_000:]
    texts = [" ".join(rest[k : k + 2_500]).encode() for k in range(0, 60_000, 2_500)]
    planted = {3: 77, 10: 19_999, 23: 0}
    for text, item in planted.items():
        texts[text] = texts[text][:5_000] + b" " + items[item][1] + b" " + texts[text][5_000:]
    tracemalloc.start()
    found = index.matches(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400_000_000, peak
    assert {k: [f[0] for f in hits] for k, hits in enumerate(found) if hits} == {k: [i] for k, i in planted.items()}


def test_batches_of_postings_change_nothing(monkeypatch):
    items = _items(60)
    texts = [prose(k, 700).encode() + b" " + items[k][1] for k in range(30)]
    whole = _index(items).matches(texts)
    monkeypatch.setattr(C, "POSTINGS_AT_ONCE", 50)
    assert _index(items).matches(texts) == whole and any(whole)


def _zipf(count, words, law):
    r = np.random.default_rng(11)
    shares = 1 / np.arange(1, 60_001) ** law
    drawn = np.char.add("w", r.choice(60_000, 30 * count + words, p=shares / shares.sum()).astype(str)).tolist()
    items = [(k, f"{' '.join(drawn[30 * k : 30 * k + 22])}. {' '.join(drawn[30 * k + 22 : 30 * k + 30])}".encode())
             for k in range(count)]
    return items, drawn[30 * count :]


@pytest.mark.parametrize("law", [1.0, 1.2])
def test_many_items_score_as_in_full(law):
    items, words = _zipf(20_000, 2_560, law)
    index = _index(items)
    r, found = random.Random(1), 0
    for k in range(0, 2_560, 128):
        own = C.words_of(items[r.randrange(20_000)][1])[: r.randrange(16, 31)]
        terms = sorted({index.terms[w] for w in [*(w.encode() for w in words[k : k + 128]), *own] if w in index.terms})
        full = np.zeros(20_000)
        for t in terms:
            numbers, impacts = index.postings(t)
            full[numbers] += impacts
        got = dict(index.search(terms))
        assert sorted(got) == np.flatnonzero(full >= C.THRESHOLD - 1e-9).tolist()
        assert all(abs(full[i] - s) < 1e-9 for i, s in got.items())
        found += len(got)
    assert found > 5


_FULL_BLOCK = """
import resource
from clickscope.llm.common import BLOCK_BYTES
from tests.llm.test_decontaminate import _index, _zipf
items, words = _zipf(20_000, 1_000_000, 1.0)
text = " ".join(words).encode()[:BLOCK_BYTES]
assert len(text) == BLOCK_BYTES
index = _index(items)
cut = [text[: BLOCK_BYTES // 2] + b" " + items[4321][1], items[17][1] + b" " + text[BLOCK_BYTES // 2 :]]
found = [[hit[0] for hit in hits] for hits in index.matches(cut)]
assert found == [[4321], [17]], found
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10)
"""


def test_a_full_block_of_documents_against_many_items_in_bounded_memory():
    done = subprocess.run([sys.executable, "-c", _FULL_BLOCK], capture_output=True, text=True, cwd=ROOT)
    assert not done.returncode, done.stderr
    assert int(done.stdout) < 1_000, f"{done.stdout} MB"


def test_repeated_items_and_indexes_that_are_read_again(spark, monkeypatch):
    own = [(i, t.decode()) for i, t in _items(24)]
    items = spark.createDataFrame([*own, *((1000 + k, own[5][1]) for k in range(300)), (None, own[5][1])], "item_id long, text string")
    docs = make_docs(spark, [(i, prose(i, 30) + " " + t) for i, t in own[3:8]])
    want = sorted([(str(i), str(i)) for i in range(3, 8)] + [("5", str(1000 + k)) for k in range(300)] + [("5", "None")])

    def found():
        return sorted((str(r.doc_id), str(r.item_id)) for r in C.contaminated(docs, items).collect())

    assert found() == want
    monkeypatch.setattr(C, "INDEX_ITEMS", 3)
    monkeypatch.setattr(C, "KEPT_INDEXES", 1)
    assert found() == want
    assert C.without_contaminated(docs, items).count() == 0
