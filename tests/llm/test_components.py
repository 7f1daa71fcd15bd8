from __future__ import annotations

import random

from clickscope.llm.common import components, text_blocks


def _brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def test_components_of_chains_stars_and_random_graphs(spark):
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 60)]
    edges += [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)] + [(-5, 7), (500, 501), (500, 501)]
    edges += [(900, 900)]
    edges += [(2000 + 7 * i % 97, 2000 + 7 * (i + 1) % 97) for i in range(90)]
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    want = _brute([e for e in edges if e[0] != e[1]])
    assert sorted(r.node for r in found) == sorted(want)
    assert all(row.root == want[row.node] for row in found)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_blocks_keep_texts_whole():
    texts = [b"a" * 10, None, b"b" * 100, b"", b"c"]
    assert list(text_blocks(texts, 50)) == [(0, 3), (3, 5)]
    assert list(text_blocks([], 50)) == []
