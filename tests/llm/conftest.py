"""Small tables with every awkward case: nulls, empties, long texts, repeats, clashing columns."""

from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "n long, fp long, size long, score double, row string, uid long, kept string, h1 long, number long, part int"
)


def make_docs(spark, pairs):
    """``pairs`` of doc_id and text, with columns whose names the operators use inside."""
    rows = [
        (i, t, None if k % 5 == 4 else "en", None if k % 3 == 2 else "s", None if t is None else len(t),
         k, None, 7, 0.5, "r", None, "k", 1, 2, 3)
        for k, (i, t) in enumerate(pairs)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    vocabulary = [f"w{r.randrange(400)}" for _ in range(300)]
    return " ".join(r.choice(vocabulary) for _ in range(words))


def awkward_pairs():
    shared = prose(1, 60)
    long = prose(2, 30_000)
    return [
        (1, prose(3, 50) + " " + shared + " " + prose(4, 40)),
        (2, None),
        (3, ""),
        (4, " \t\n\r\x0b\x0c "),
        (5, shared),
        (6, shared),
        (6, shared),
        (None, shared + " tail"),
        (None, None),
        (7, long),
        (8, "café 你好 \U0001f600  x y \x1c İΣ <|endoftext|> it's"),
        (9, "la " * 200),
        (10, prose(5, 34)),
        (11, prose(5, 34)),
        (12, "x"),
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    return make_docs(spark, awkward_pairs()).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return make_docs(spark, []).cache()
