"""The distributed manifest against a plain recursive tree, and what versions share."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from clickscope.llm import manifest as M
from clickscope.llm.ranks import ranked


def hexed(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return hexed(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([hexed(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def way_up(levels, at):
    """Left and right siblings at every level."""
    for nodes in levels[:-1]:
        run = at // 3 * 3
        yield nodes[run:at], nodes[at + 1 : run + 3]
        at //= 3


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row["source"]].append((row["doc_id"], leaf(row, row["text"]), row))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = levels_of([x[1] for x in groups[s]])
    top = levels_of([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for at, (doc, digest, row) in enumerate(groups[s]):
            way = [*way_up(trees[s], at), *way_up(top, k)]
            text, now = row["text"], digest
            if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 2 == 0:
                now = leaf(row, text.replace("\n", ""))
            for left, right in way:
                now = hexed(*left, now, *right)
            proof = hexed(*(d for left, right in way for d in (*left, *right)))
            out.append((doc, digest, trees[s][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "rank long, pos long, tree long, digest string, n int, block int, leaf string"
)
FIELDS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark, rows):
    return spark.createDataFrame([(*(r[f] for f in FIELDS), 1, 2, 3, "x", 4, 5, "y") for r in rows], SCHEMA)


def got(df):
    return sorted(
        ((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()), key=str
    )


def make(seed, sizes, start=0):
    r = random.Random(seed)
    texts = [None, "", "a\nb", "plain", "é\n\n你", "\n", "x" * 40_000 + "\n"]
    rows, doc = [], start
    for source, size in sizes:
        for _ in range(size):
            doc += r.randrange(1, 4)
            text = r.choice(texts)
            rows.append({"doc_id": doc, "text": text, "lang": r.choice([None, "en", ""]), "source": source,
                         "n_chars": r.choice([None, 0, -3, 12345])})
    return rows


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_against_a_plain_tree(spark, depth):
    rows = make(1, [(None, 5), ("", 1), ("a", 28), ("é", 9), ("Z", 10), ("z\U0001f600", 2), ("z\uffff", 4), ("b", 27)])
    assert got(M.verify_manifest(table(spark, rows).repartition(5), depth)) == brute(rows)


def test_one_row_one_source_and_many_sources(spark):
    one = make(2, [("s", 1)])
    assert got(M.verify_manifest(table(spark, one))) == brute(one)
    single = make(3, [("s", 750)])
    assert got(M.verify_manifest(table(spark, single).repartition(3))) == brute(single)
    many = make(4, [(f"s{k}", 1) for k in range(760)])
    assert got(M.verify_manifest(table(spark, many).repartition(3))) == brute(many)


def test_repeated_and_null_ids(spark):
    rows = make(5, [("hot", 800), ("b", 3)])
    rows += rows[::5]  # whole rows repeated
    rows += [dict(r, doc_id=None) for r in rows[:4]] + [dict(r, text="other\n", n_chars=1) for r in rows[:3]]
    assert got(M.verify_manifest(table(spark, rows).repartition(6))) == brute(rows)


def test_empty_table(spark):
    assert M.verify_manifest(table(spark, [])).count() == 0


def test_a_version_copies_ancestors_only():
    leaves = [bytes([k]) * 32 for k in range(20)]
    first = M.grown(leaves, 3)
    way = M.steps(13, 3)
    other = M.version(first, way, b"x" * 32)
    assert first == M.grown(leaves, 3)  # the first version is what it was
    assert other == M.grown([*leaves[:13], b"x" * 32, *leaves[14:]], 3)

    def nodes(tree):
        return {id(tree)}.union(*map(nodes, tree[1])) if tree[1] else {id(tree)}

    assert len(nodes(other) - nodes(first)) == 3 + 1  # its ancestors and itself
    assert M.climbed(b"x" * 32, M.trail(first, way)) == other[0]


def test_positions_of_equal_rows_cross_partitions(spark):
    df = spark.range(3000).selectExpr("'same' as a", "1L as b").repartition(7)
    rows = ranked(df, ["a", "b"], "ranks").collect()
    assert sorted(r["rank"] for r in rows) == list(range(3000))
    mixed = spark.range(500).selectExpr("if(id % 5 = 0, null, id % 7) as a", "id as b").repartition(4)
    rows = ranked(mixed, ["a", "b"], "ranks").collect()
    assert [(r.a, r.b) for r in sorted(rows, key=lambda r: r["rank"])] == sorted(
        ((r.a, r.b) for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1])
    )
