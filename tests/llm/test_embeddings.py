from __future__ import annotations

import numpy as np
import pytest

from clickscope.llm import embeddings as E


def _brute(vectors, cosine):
    """Links of each vector and its component's smallest id; vectors are (id, list or None)."""
    good = [
        k for k, (_, v) in enumerate(vectors)
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = np.zeros(len(vectors), int)
    label = [i for i, _ in vectors]
    edges = []
    for a in good:
        for b in good:
            if a < b and len(vectors[a][1]) == len(vectors[b][1]):
                x, y = (np.array(vectors[k][1], np.float64) for k in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[a] += 1
                    links[b] += 1
                    edges.append((a, b))
    for _ in vectors:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return links.tolist(), label


def _planted(seed, groups, dims=16):
    r = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        base = r.standard_normal(dims)
        for _ in range(r.integers(1, 12)):
            out.append((base + r.uniform(0, 0.6) * r.standard_normal(dims)) * r.uniform(0.1, 10))
    return [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(out)]


@pytest.mark.parametrize("block_rows", [7, 50, 100_000])
def test_against_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(E, "BLOCK_ROWS", block_rows)
    vectors = _planted(1, 30)
    vectors += [(1000 + i, vectors[3][1]) for i in range(5)]  # copies
    got = {r.vec_id: r for r in E.near_duplicates(spark.createDataFrame(vectors, "vec_id long, embedding array<float>")).collect()}
    links, label = _brute(vectors, 0.9)
    for (i, _), n, root in zip(vectors, links, label):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, root, root == i), i


def test_trees_cover_and_nest():
    points = E.unit_rows(np.random.default_rng(2).standard_normal((300, 8)))
    tree = E.BlockTree(points)
    under = tree.leaf
    for level, centres in enumerate(tree.centres):
        gap = np.linalg.norm(points - points[centres[under]], axis=1)
        assert (gap <= tree.radius[level][under] + 1e-9).all()
        if level + 1 < len(tree.centres):
            assert set(tree.centres[level + 1]) <= set(centres)
            under = tree.parent[level][under]
    for cosine in (0.99, 0.9, 0.5):
        again = E.BlockTree.unpacked(points, tree.packed())
        rows, columns, open_, whole = E.meet(tree, again, cosine)
        count = len(tree.centres[0])
        full = {name: np.zeros((count, count), bool) for name in ("open", "whole")}
        full["open"][np.ix_(rows, columns)], full["whole"][np.ix_(rows, columns)] = open_, whole
        near = points @ points.T >= cosine
        pairs = np.ix_(tree.leaf, tree.leaf)
        assert not (near & ~(full["open"] | full["whole"])[pairs]).any()  # nothing that links is pruned
        assert near[full["whole"][pairs]].all()


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 1), (4, [], 1), (5, [0.0, 0.0], None), (6, [nan, 1.0], 0),
        (7, [inf, 1.0], 0), (8, [None, 1.0], 0), (9, [1.0, 0.0, 0.0], 0), (10, [0.0, 1.0], 0), (11, [1.0, 0.0], 0),
        (11, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (12, [1e-30, 1e-31], 0), (13, [3e38, 3e37], 0), (14, [-0.0, 1.0], 5),
    ]
    got = E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    by = {r.vec_id: r for r in got}
    assert len(got) == len(rows)
    same = {1, 2, 11, 12, 13}
    assert all(by[i].component_id == 1 and by[i].n_links == 5 for i in same)
    assert by[10].n_links == by[14].n_links == 1 and by[14].component_id == 10
    for i in (3, 4, 5, 6, 7, 8, 9, None):
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True)


def test_empty_table(spark):
    assert E.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("block_rows", [40, 100_000])
def test_doubles_are_compared_as_doubles(spark, monkeypatch, block_rows):
    """Pairs a few 1e-9 above and below the threshold, which single precision would mix up."""
    monkeypatch.setattr(E, "BLOCK_ROWS", block_rows)
    r = np.random.default_rng(8)
    vectors = []
    for k in range(60):
        x, other = r.standard_normal((2, 12))
        x /= np.linalg.norm(x)
        other -= (other @ x) * x
        cosine = 0.9 + (1 if k % 2 else -1) * 10 ** r.uniform(-9, -8)
        y = cosine * x + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)
        vectors += [(2 * k, x.tolist()), (2 * k + 1, (y * r.uniform(0.1, 10)).tolist())]
    vectors += [(900, [1e300, 1e299]), (901, [1e-300, 1e-301]), (902, [1.0, 0.1])]
    got = {r.vec_id: r for r in E.near_duplicates(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()}
    links, label = _brute(vectors[:-3], 0.9)
    for (i, _), n, root in zip(vectors, links, label):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, root, root == i), i
    assert all((got[i].n_links, got[i].component_id) == (2, 900) for i in (900, 901, 902))
    single = _brute([(i, np.float32(v).tolist()) for i, v in vectors[:-3]], 0.9)
    assert sum(links) >= 60 and single[0] != links
