"""Embedding near-duplicates by dual traversal of cover trees: exact threshold pairs.

Distances are chords between unit vectors, so cosine >= c is distance <=
sqrt(2 - 2c).  Distinct vectors are assigned to the nearest of a bounded
number of top nodes, each top node's vectors are dealt into blocks of about
``BLOCK_ROWS``, and every block gets a cover tree of its own: nested levels
(each level's centres are centres of the level below) with halving radii, and
for every node the true radius that covers all vectors under it.

Pairs of top nodes whose covering radii keep them apart are pruned; the blocks
of the others meet in pairs, one row each.  Two blocks' trees are traversed
together, level by level: a pair of nodes is pruned if the distance of its
centres exceeds the threshold by more than both radii, taken whole if it is
below it by as much, and otherwise its children are looked at; at the bottom
the cosines are computed in double precision.  Components stay as the table
has them: four bytes if it holds floats, else eight.  A block pair returns how many
links each vector has there and a spanning forest of them, not the pairs.

Vectors spread evenly in many dimensions are far apart at all but the lowest
level, so there the traversal prunes little above it and work grows with the
square of the number of blocks; memory does not.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing (a component of their own); vectors of different
lengths never link; equal vectors are one class and each other's links;
repeated rows are vectors of their own; rows that share a ``vec_id`` are one
node; a row with a null id links with nothing; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.llm.common import components, stored

COSINE = 0.9
BLOCK_ROWS = 3000
#: Top nodes at most, and the bounded sample that they are chosen from.
TOP_NODES, TOP_SAMPLE = 64, 4096
TOP_RADIUS = 1.0
#: Radii of the levels of a block's tree, from the lowest.
LEVEL_RADII = (0.2, 0.4, 0.8)
_TILE = 1024
_SLACK = 1e-9  # kept from every bound, so that rounding never decides
_ROUGH = 1e-4  # more than a product of unit vectors is off in single precision


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def greedy_centres(points: np.ndarray, radius: float, limit: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Centres more than ``radius`` apart, and the centre (its place in the list) of every point.

    With a limit, points that no centre covers go to the nearest.
    """
    owner = np.full(len(points), -1)
    centres: list[int] = []
    rough = points.astype(np.float32)
    for begin in range(0, len(points), _TILE):
        tile = begin + np.flatnonzero(owner[begin : begin + _TILE] < 0)
        near = rough[tile] @ rough.T >= 1.0 - radius * radius / 2.0
        for point, row in zip(tile.tolist(), near):
            if limit is not None and len(centres) >= limit:
                break
            if owner[point] < 0:
                row &= owner < 0
                row[point] = True
                owner[row] = len(centres)
                centres.append(point)
    left = np.flatnonzero(owner < 0)
    if len(left):
        owner[left] = np.argmax(points[left] @ points[centres].T, axis=1)
    return np.array(centres, np.int64), owner


class BlockTree:
    """Nested levels over one block; level 0 are the lowest nodes.

    ``centres[l]``: rows of the block; ``parent[l]``: node of level l + 1 that
    holds each node; ``radius[l]``: covering radius of each node; ``leaf``:
    level-0 node of each row.
    """

    def __init__(self, points: np.ndarray, levels: dict[str, np.ndarray] | None = None) -> None:
        self.points = points
        self.rough = points.astype(np.float32)
        if levels is not None:
            self.leaf = levels["leaf"]
            count = sum(name.startswith("centres") for name in levels)
            self.centres = [levels[f"centres{i}"] for i in range(count)]
            self.radius = [levels[f"radius{i}"] for i in range(count)]
            self.parent = [levels[f"parent{i}"] for i in range(count - 1)]
            return
        first, self.leaf = greedy_centres(points, LEVEL_RADII[0])
        self.centres, self.parent, self.radius = [first], [], []
        under = self.leaf
        self.radius.append(self._cover(first, under))
        for radius in LEVEL_RADII[1:]:
            below = self.centres[-1]
            chosen, owner = greedy_centres(points[below], radius)
            if 2 * len(chosen) > len(below):
                continue  # a level that hardly gathers anything prunes nothing
            self.parent.append(owner)
            self.centres.append(below[chosen])
            under = owner[under]
            self.radius.append(self._cover(self.centres[-1], under))

    def _cover(self, centres: np.ndarray, under: np.ndarray) -> np.ndarray:
        gap = np.sqrt(np.maximum(2.0 - 2.0 * np.einsum("ij,ij->i", self.points, self.points[centres[under]]), 0.0))
        out = np.zeros(len(centres))
        np.maximum.at(out, under, gap)
        return out

    def packed(self) -> bytes:
        """The levels as bytes (the points travel beside them)."""
        out = io.BytesIO()
        rows = {"leaf": self.leaf}
        for name in ("centres", "radius", "parent"):
            rows |= {f"{name}{i}": values for i, values in enumerate(getattr(self, name))}
        np.savez(out, **rows)
        return out.getvalue()

    @classmethod
    def unpacked(cls, points: np.ndarray, levels: bytes) -> BlockTree:
        with np.load(io.BytesIO(levels)) as rows:
            return cls(points, dict(rows))


def meet(a: BlockTree, b: BlockTree, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Dual traversal of two trees.

    Returns the lowest nodes of each that have a partner left, and for every
    pair of those whether it is still open and whether it links whole.  On
    each level a product in single precision, with room for its error, finds
    the few pairs for which the bound is then computed in double precision.
    """
    reach = float(np.sqrt(2.0 - 2.0 * cosine))
    la, lb = len(a.centres) - 1, len(b.centres) - 1
    rows, columns = np.arange(len(a.centres[la])), np.arange(len(b.centres[lb]))
    alive = None
    while True:
        ra, rb = a.radius[la][rows], b.radius[lb][columns]
        widest = reach + ra.max(initial=0.0) + rb.max(initial=0.0)
        at_a, at_b = a.centres[la][rows], b.centres[lb][columns]
        near = a.rough[at_a] @ b.rough[at_b].T >= 1.0 - widest * widest / 2.0 - _ROUGH
        if alive is not None:
            near &= alive
        on_a, on_b = near.any(axis=1), near.any(axis=0)
        rows, columns, near = rows[on_a], columns[on_b], near[np.ix_(on_a, on_b)]
        gap = distances(a.points[at_a[on_a]], b.points[at_b[on_b]])
        radii = ra[on_a][:, None] + rb[on_b][None, :]
        near &= gap <= reach + radii + _SLACK
        if not la and not lb:
            whole = near & (gap <= reach - radii - _SLACK)
            return rows, columns, near & ~whole, whole
        if la >= lb:
            la -= 1
            place = np.full(len(a.centres[la + 1]), -1)
            place[rows] = np.arange(len(rows))
            under = place[a.parent[la]]
            rows = np.flatnonzero(under >= 0)
            alive = near[under[rows]]
        else:
            lb -= 1
            place = np.full(len(b.centres[lb + 1]), -1)
            place[columns] = np.arange(len(columns))
            under = place[b.parent[lb]]
            columns = np.flatnonzero(under >= 0)
            alive = near[:, under[columns]]


def _members(tree: BlockTree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the block under the given lowest nodes, and the place of each one's node among them."""
    place = np.full(len(tree.centres[0]), -1)
    place[nodes] = np.arange(len(nodes))
    under = place[tree.leaf]
    rows = np.flatnonzero(under >= 0)
    rows = rows[np.argsort(under[rows], kind="stable")]  # near rows together, so that a tile has few partners
    return rows, under[rows]


def links_between(a: BlockTree, b: BlockTree, cosine: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Tiles of the links: rows of ``a``, rows of ``b``, and which of them link."""
    nodes_a, nodes_b, open_, whole = meet(a, b, cosine)
    some = open_ | whole
    rows, under_a = _members(a, nodes_a)
    others, under_b = _members(b, nodes_b)
    for i in range(0, len(rows), _TILE):
        tile, own = rows[i : i + _TILE], under_a[i : i + _TILE]
        wanted = some[own].any(axis=0)[under_b]
        columns, partner = others[wanted], under_b[wanted]
        if not len(columns):
            continue
        pairs = np.ix_(own, partner)
        linked = ((a.points[tile] @ b.points[columns].T >= cosine) & open_[pairs]) | whole[pairs]
        if same:
            linked &= tile[:, None] != columns[None, :]
        yield tile, columns, linked


def forest(label: np.ndarray, rows: np.ndarray, columns: np.ndarray, linked: np.ndarray) -> None:
    """Lower the labels of linked nodes to a common one, in place."""
    while True:
        row, column = label[rows], label[columns]
        low_row = np.minimum(row, np.where(linked, column[None, :], np.iinfo(np.int64).max).min(axis=1))
        low_column = np.minimum(column, np.where(linked, low_row[:, None], np.iinfo(np.int64).max).min(axis=0))
        if (low_row == row).all() and (low_column == column).all():
            return
        # What a node was joined to before moves along with it.
        for old, new in ((row, low_row), (column, low_column)):
            for o, n in {(o, n) for o, n in zip(old.tolist(), new.tolist()) if o != n}:
                label[label == o] = min(n, o)


def compare_blocks(a: BlockTree, b: BlockTree, a_ids, b_ids, a_sizes, b_sizes, cosine: float, same: bool):
    """Links of each vector here (``ids``, ``counts``) and joining links (``u``, ``v``)."""
    na = len(a_ids)
    counts = np.zeros(na + (0 if same else len(b_ids)), np.int64)
    label = np.arange(len(counts))
    shift = 0 if same else na
    for rows, columns, linked in links_between(a, b, cosine, same):
        counts[rows] += linked @ b_sizes[columns]
        if not same:
            counts[shift + columns] += a_sizes[rows] @ linked
        on_r, on_c = linked.any(axis=1), linked.any(axis=0)
        if not on_r.any():
            continue
        forest(label, rows[on_r], shift + columns[on_c], linked[np.ix_(on_r, on_c)])
    ids = a_ids if same else np.concatenate([a_ids, b_ids])
    seen, joined = np.flatnonzero(counts), np.flatnonzero(label != np.arange(len(label)))
    return ids[seen], counts[seen], ids[joined], ids[label[joined]]


def _top_nodes(classes: DataFrame, dims: int, count: int) -> np.ndarray:
    """Centres of the top level, from a bounded sample of the vectors of one length."""
    want = min(TOP_NODES, max(1, -(-count // BLOCK_ROWS)))
    share = min(1.0, TOP_SAMPLE / count)
    below = F.pmod(F.xxhash64("cid"), F.lit(1_000_000)) < int(1_000_000 * share)
    sample = classes.where((F.col("dims") == dims) & below).select("cid", "embedding").collect()
    if not sample:
        return np.eye(1, dims)
    points = unit_rows(np.array([r["embedding"] for r in sorted(sample, key=lambda r: r["cid"])]))
    return points[greedy_centres(points, TOP_RADIUS, want)[0]]


def _place(classes: DataFrame, tops: dict[int, np.ndarray]) -> DataFrame:
    """Nearest top node of every class and its distance."""
    shared = classes.sparkSession.sparkContext.broadcast(tops)  # TOP_NODES vectors of each length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = np.asarray(batch.column("dims"))
            column = batch.column("embedding")
            flat, offsets = np.asarray(column.values), np.asarray(column.offsets)
            top, gap = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                points = unit_rows(flat[offsets[own][:, None] + np.arange(d)])
                apart = distances(points, shared.value[int(d)])
                top[own] = apart.argmin(axis=1)
                gap[own] = apart.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(top), pa.array(gap)], names=[*batch.schema.names, "top", "gap"]
            )

    schema = T.StructType([*classes.schema.fields, T.StructField("top", T.IntegerType()), T.StructField("gap", T.DoubleType())])
    return classes.mapInArrow(run, schema)


def _block_pairs(spark: SparkSession, placed: DataFrame, tops: dict[int, np.ndarray], cosine: float) -> tuple[DataFrame, DataFrame]:
    """Rows with their block, and the pairs of blocks whose top nodes are not kept apart."""
    reach = float(np.sqrt(2.0 - 2.0 * cosine)) + _SLACK
    nodes: dict[int, list] = {}
    stats = placed.groupBy("dims", "top").agg(F.count("*").alias("n"), F.max("gap").alias("radius"))
    for r in stats.collect():  # TOP_NODES rows for each length
        nodes.setdefault(r["dims"], []).append((r["top"], -(-r["n"] // BLOCK_ROWS), r["radius"]))
    sizes, near = [], []
    for dims, own in nodes.items():
        apart = distances(tops[dims], tops[dims])
        sizes += [(dims, top, blocks) for top, blocks, _ in own]
        near += [
            (dims, a, b)
            for a, _, ra in own
            for b, _, rb in own
            if a <= b and apart[a, b] <= reach + ra + rb
        ]
    size = stored(spark.createDataFrame(sizes, "dims int, top int, blocks long"), "nodes")
    pair = spark.createDataFrame(near, "dims int, top_a int, top_b int")
    rows = placed.join(F.broadcast(size), ["dims", "top"]).withColumn(
        "block", F.pmod(F.xxhash64("cid", F.lit(7)), "blocks").cast("int")
    )
    left = size.select("dims", F.col("top").alias("top_a"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block_a"))
    right = size.select("dims", F.col("top").alias("top_b"), F.col("blocks").alias("blocks_b"))
    pairs = (
        pair.join(left, ["dims", "top_a"])
        .join(right, ["dims", "top_b"])
        .withColumn("block_b", F.explode(F.sequence(F.lit(0), F.col("blocks_b") - 1)))
        .where("top_a < top_b OR block_a <= block_b")
        .select("dims", "top_a", F.col("block_a").cast("int").alias("block_a"), "top_b", F.col("block_b").cast("int").alias("block_b"))
    )
    return rows, pairs


def _numbers(vectors: DataFrame) -> type:
    """The type of the components: single precision only if the table holds no other."""
    return np.float32 if vectors.schema["embedding"].dataType.elementType == T.FloatType() else np.float64


def _pack(rows: DataFrame) -> DataFrame:
    """One row for each block: its vectors, cover tree, ids and class sizes as bytes.

    The tree is built here, once, however many other blocks this one meets.
    """

    kind = _numbers(rows)

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("cid")
        vectors = np.array(frame["embedding"].tolist(), kind)
        ids = frame["cid"].to_numpy(np.int64)
        sizes = frame["n"].to_numpy(np.int64)
        tree = BlockTree(unit_rows(vectors)).packed()
        return pd.DataFrame(
            [[*key, vectors.tobytes(), tree, ids.tobytes(), sizes.tobytes()]],
            columns=["dims", "top", "block", "vectors", "tree", "ids", "sizes"],
        )

    return rows.groupBy("dims", "top", "block").applyInPandas(
        pack, "dims int, top int, block int, vectors binary, tree binary, ids binary, sizes binary"
    )


def _compare(pairs: DataFrame, cosine: float, kind: type) -> DataFrame:
    """Runs the dual traversal for every row (two packed blocks of components of ``kind``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                side = {}
                for s in "ab":
                    points = unit_rows(np.frombuffer(row[f"vectors_{s}"], kind).reshape(-1, row["dims"]))
                    side[s] = BlockTree.unpacked(points, row[f"tree_{s}"]), *(np.frombuffer(row[f"{x}_{s}"], np.int64) for x in ("ids", "sizes"))
                same = (row["top_a"], row["block_a"]) == (row["top_b"], row["block_b"])
                (ta, ia, na), (tb, ib, nb) = side["a"], side["b"]
                ids, counts, u, v = compare_blocks(ta, tb, ia, ib, na, nb, cosine, same)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([ids, u])),
                        pa.array(np.concatenate([counts, np.zeros(len(u), np.int64)])),
                        pa.array(np.concatenate([ids, v])),
                    ],
                    names=["cid", "links", "root"],
                )

    return pairs.mapInArrow(run, "cid long, links long, root long")


def near_duplicates(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every vector."""
    spark = table.sparkSession
    fine = F.coalesce(
        (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    ) & F.col("vec_id").isNotNull()
    kind = "float" if _numbers(table) is np.float32 else "double"
    rows = stored(
        table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
        .withColumn("fine", fine),
        "vectors",
    )
    classes = stored(
        rows.where("fine")
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("cid"), F.count("*").alias("n"))
        .withColumn("dims", F.size("embedding")),
        "classes",
    )
    tops = {
        r["dims"]: _top_nodes(classes, r["dims"], r["n"])
        for r in classes.groupBy("dims").agg(F.count("*").alias("n")).collect()
    }
    if not tops:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    dealt, pairs = _block_pairs(spark, stored(_place(classes, tops), "placed"), tops, cosine)
    packed = stored(_pack(dealt.select("dims", "top", "block", "cid", "embedding", "n")), "blocks")

    def side(s: str) -> DataFrame:
        return packed.select(
            "dims", *(F.col(c).alias(f"{c}_{s}") for c in ("top", "block", "vectors", "tree", "ids", "sizes"))
        )

    met = pairs.join(side("a"), ["dims", "top_a", "block_a"]).join(side("b"), ["dims", "top_b", "block_b"])
    found = stored(_compare(met, cosine, _numbers(dealt)), "links")
    counts = found.where("links > 0").groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(found.where("links = 0").select(F.col("cid").alias("u"), F.col("root").alias("v")))
    named = joined.join(joined.groupBy("root").agg(F.min("node").alias("component_id")), "root").select(
        F.col("node").alias("cid"), "component_id"
    )
    summary = stored(
        classes.join(counts, "cid", "left")
        .join(named, "cid", "left")
        .select(
            F.col("embedding"),
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "cid").alias("component_id"),
        ),
        "summary",
    )
    linked = rows.where("fine").join(summary, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
