from __future__ import annotations

import re
import time

import pytest

from clickscope.llm import licences as L
from tests.conftest import sf_dir

pytest.importorskip("ahocorasick")


def _brute(text: str | None):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in L.BASE_PHRASES.items():
        own = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(own)] == own:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


TEXTS = [
    "Licensed under CC BY-NC 4.0. CC-BY-NC cc by nc by nc",
    "under the MIT License under the MIT license, version 2",
    "Apache License, Version 2.0; apache license version 2",
    "apache license version 2.0 café Apache  License\n\nversion 2",
    "x" * 5 + " under the mit licenses",
    "",
    None,
    "cc by nc " * 300,
]


def test_places_against_brute_force():
    scanner = L.LicenceScanner()
    for text in TEXTS:
        got = scanner.scan((text or "").encode())
        assert (got[0], got[1], got[2], got[3], ",".join(sorted(got[4]))) == _brute(text), text
        assert 0.0 <= got[6] <= 1.0 and got[4] <= got[5]


@pytest.mark.parametrize(
    "text, postfix, permissive",
    [
        ("MIT", ["mit"], True),
        ("MIT OR GPL-2.0-only AND Apache-2.0", ["mit", "gpl-2.0-only", "apache-2.0", "and", "or"], True),
        ("(MIT OR GPL-2.0-only) AND GPL-3.0", ["mit", "gpl-2.0-only", "or", "gpl-3.0", "and"], False),
        ("GPL-2.0 WITH Classpath-exception-2.0 AND MIT", ["gpl-2.0", "classpath-exception-2.0", "with", "mit", "and"], True),
        ("GPL-2.0 WITH other-exception", ["gpl-2.0", "other-exception", "with"], False),
        ("Apache-2.0 */", ["apache-2.0"], True),
        ("MIT and some prose", ["mit"], True),
        ("MIT and then-1.0 with", ["mit", "then-1.0", "and"], False),
        ("Curl or Zed and more", ["curl", "zed", "or"], False),
        ("((MIT))", ["mit"], True),
    ],
)
def test_expressions(text, postfix, permissive):
    assert L.parse_expression(text) == postfix
    assert L.evaluate(postfix)[0] is permissive


@pytest.mark.parametrize("text", ["", "OR MIT", "(MIT", "()", "AND", ")"])
def test_malformed_expressions(text):
    assert L.parse_expression(text) is None


def test_tags_add_labels():
    got = L.LicenceScanner().scan(b"// SPDX-License-Identifier: MIT OR (GPL-2.0-only WITH Classpath-exception-2.0)\nx")
    assert got[5] == {"spdx:mit", "spdx:gpl-2.0-only"} and got[7] is True and got[1] == 0
    assert L.LicenceScanner().scan(b"SPDX-License-Identifier: AND")[5] == {"spdx:invalid"}


def test_prose_after_an_expression_adds_no_label():
    got = L.LicenceScanner().scan(b"SPDX-License-Identifier: MIT and then some more")
    assert got[5] == {"spdx:mit"} and got[7] is True


def test_long_texts_and_expressions_in_proportion():
    scanner = L.LicenceScanner()
    text = b"apache license version 2 under the mit license cc by nc by nc " * 165_000
    begun = time.perf_counter()
    got = scanner.scan(text)
    assert len(text) > 10_000_000 and time.perf_counter() - begun < 20
    assert got[:4] == (165_000 * 13, 165_000 * 3, 0, 164_999 * 13 + 8) and got[4] == {"apache-2", "mit", "cc-by-nc"}
    expression = " or ".join(["MIT"] * 170_000)
    begun = time.perf_counter()
    postfix = L.parse_expression(expression)
    assert len(expression) > 1_000_000 and len(postfix) == 2 * 170_000 - 1 and L.evaluate(postfix) == (True, {"mit"})
    assert time.perf_counter() - begun < 20


def test_every_row(awkward, nothing):
    got = sorted(
        ((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels))
        for r in L.scan_licences(awkward).collect()
    )
    assert got == sorted(
        (r.doc_id is None, r.doc_id or 0, *(str(x) if i in (2, 3) else x for i, x in enumerate(_brute(r.text))))
        for r in awkward.collect()
    )
    assert L.scan_licences(nothing).count() == 0


def test_base_columns_of_a_table(spark):
    docs = spark.read.parquet(f"{sf_dir('0.01')}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = L.scan_licences(docs).collect()
    assert len(rows) == len(texts) and any(r.n_base for r in rows)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _brute(texts[r.doc_id])
