"""Merkle manifest of a dataset: a persistent, path-copying tree in distributed blocks.

Every row is a leaf, the SHA-256 of its fields.  Inside a source, leaves in
ascending ``doc_id`` are hashed three at a time, level by level, until one node
is left (the source's subroot); subroots in order of their source go on
likewise to the root.

Trees are built in aligned blocks of ``FANOUT ** DEPTH`` neighbours:
one group of a Spark job makes the block's nodes, and the blocks' roots are the
leaves of the next, upper tree.  A hot source is many blocks.  Nodes are never
changed.  A tampered leaf makes a new version of its block: new ancestors
inside the block only, which share every untouched node with the first version.
The version goes on in the upper trees with the siblings of its block there
(the *trail*, computed once for a block and met by a shuffle on the block), so
versions continue wherever the block is, not in one upper task.

Defined results: a null field hashes as ``-``; null sources are one source,
before all others; a null ``doc_id`` comes first and is never tampered;
rows equal in ``source`` and ``doc_id`` come in the order of their digests, and
equal rows each give a row; an empty text is ``0:``; a very long text is hashed
whole by the JVM, only digests move; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import stored
from clickscope.llm.ranks import ranked

FANOUT = 3
#: Levels of a block; it has ``FANOUT ** DEPTH`` leaves.
DEPTH = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: A node is its digest and its children.
Node = tuple[bytes, tuple]


def parent_digest(digests: Iterable[bytes]) -> bytes:
    """Digest of a node: its children's, as lowercase hexadecimal text, joined."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def levels_above(n: int) -> int:
    """Levels until one of ``n`` neighbours is left."""
    levels, reach = 0, 1
    while reach < n:
        levels, reach = levels + 1, reach * FANOUT
    return levels


def grown(leaves: Sequence[bytes], levels: int) -> Node:
    """The tree over at most ``FANOUT ** levels`` leaves, with exactly that many levels."""
    nodes: list[Node] = [(d, ()) for d in leaves]
    for _ in range(levels):
        runs = [tuple(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
        nodes = [(parent_digest(c[0] for c in run), run) for run in runs]
    return nodes[0]


def steps(place: int, levels: int) -> list[int]:
    """Which child to take at each level, from the root down to the leaf."""
    return [place // FANOUT**k % FANOUT for k in reversed(range(levels))]


def version(node: Node, way: Sequence[int], leaf: bytes) -> Node:
    """``node`` with another leaf at the end of ``way``: copies the ancestors, shares the rest."""
    if not way:
        return leaf, ()
    children = node[1]
    copy = version(children[way[0]], way[1:], leaf)
    children = (*children[: way[0]], copy, *children[way[0] + 1 :])
    return parent_digest(c[0] for c in children), children


def trail(node: Node, way: Sequence[int]) -> bytes:
    """The siblings met from the leaf up, packed: for each level how many stand
    left and right, then their digests."""
    found = []
    for step in way:
        others = [c[0] for k, c in enumerate(node[1]) if k != step]
        found.append(bytes((step, len(others) - step)) + b"".join(others))
        node = node[1][step]
    return b"".join(reversed(found))


def trail_levels(packed: bytes) -> Iterable[tuple[list[bytes], list[bytes]]]:
    at = 0
    while at < len(packed):
        left, right = packed[at], packed[at + 1]
        digests = [packed[k : k + 32] for k in range(at + 2, at + 2 + 32 * (left + right), 32)]
        yield digests[:left], digests[left:]
        at += 2 + 32 * (left + right)


def climbed(digest: bytes, packed: bytes) -> bytes:
    """The digest that the end of a trail has, if its beginning has ``digest``."""
    for left, right in trail_levels(packed):
        digest = parent_digest([*left, digest, *right])
    return digest


def proof(packed: bytes) -> str:
    """Digest over all siblings of a trail, in order."""
    return parent_digest(d for left, right in trail_levels(packed) for d in (*left, *right)).hex()


def leaf_digest(text: Column | None = None) -> Column:
    """SHA-256 of a row's fields, each ``-`` or its length in bytes, a colon and itself."""

    def field(name: str) -> Column:
        value = text if text is not None and name == "text" else F.col(name).cast("string")
        return F.when(F.col(name).isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        )

    return F.unhex(F.sha2(F.concat(*map(field, FIELDS)).cast("binary"), 256))


def _height(table: pa.Table, depth: int) -> int:
    """Levels that a block of a tree of ``n`` nodes goes up."""
    return min(depth, levels_above(table.column("n")[0].as_py()))


def _block_roots(table: pa.Table, depth: int) -> pa.Table:
    table = table.sort_by("pos")
    tree, n, pos = (table.column(c)[0].as_py() for c in ("tree", "n", "pos"))
    root = grown(table.column("digest").to_pylist(), _height(table, depth))[0]
    return pa.table(
        {
            "tree": pa.array([tree], pa.int64()),
            "n": pa.array([-(-n // FANOUT**depth)], pa.int64()),
            "pos": pa.array([pos // FANOUT**depth], pa.int64()),
            "digest": pa.array([root], pa.binary()),
        }
    )


def _block_trails(table: pa.Table, above: pa.Table, depth: int) -> pa.Table:
    table = table.sort_by("pos")
    levels = _height(table, depth)
    node = grown(table.column("digest").to_pylist(), levels)
    upper, top = above.column("trail")[0].as_py(), above.column("top")[0].as_py()
    found = [trail(node, steps(k, levels)) + upper for k in range(table.num_rows)]
    return pa.table(
        {
            "tree": table.column("tree"),
            "pos": table.column("pos"),
            "digest": table.column("digest"),
            "trail": pa.array(found, pa.binary()),
            "top": pa.array([top] * table.num_rows, pa.binary()),
        }
    )


def _by_block(nodes: DataFrame, depth: int):
    return nodes.groupBy("tree", F.expr(f"pos div {FANOUT**depth}").alias("block"))


def _grow(nodes: DataFrame, purpose: str, depth: int) -> list[DataFrame]:
    """``nodes`` (tree, n, pos, digest) and the stored upper trees, up to one node for each tree."""
    layers = [nodes]
    while (layers[-1].agg(F.max("n")).first()[0] or 0) > 1:  # one number
        found = _by_block(layers[-1], depth).applyInArrow(
            lambda t: _block_roots(t, depth), "tree long, n long, pos long, digest binary"
        )
        layers.append(stored(found, purpose))
    return layers


def _descend(layers: list[DataFrame], trails: DataFrame, depth: int) -> DataFrame:
    """Trails (tree, pos, digest, trail, top) of the lowest of ``layers``, from
    those of the layer above them."""
    for layer in reversed(layers):
        above = trails.groupBy("tree", F.col("pos").alias("block"))
        found = _by_block(layer.select("tree", "n", "pos", "digest"), depth).cogroup(above).applyInArrow(
            lambda t, up: _block_trails(t, up, depth),
            "tree long, pos long, digest binary, trail binary, top binary",
        )
        trails = stored(found, "trails")
    return trails


_MANIFEST = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean, tampered boolean"
)


def _verified_block(table: pa.Table, above: pa.Table, depth: int) -> pa.Table:
    """The rows of a block, and a version of its tree for every tampered leaf."""
    table = table.sort_by("pos")
    levels = _height(table, depth)
    leaves, changed = table.column("digest").to_pylist(), table.column("tampered").to_pylist()
    upper, subroot, root = (above.column(c)[0].as_py() for c in ("trail", "subroot", "top"))
    first = grown(leaves, levels)
    proofs, folded = [], []
    for k, (leaf, other) in enumerate(zip(leaves, changed)):
        way = steps(k, levels)
        within = trail(first, way)
        proofs.append(proof(within + upper))
        if other is None:
            folded.append(climbed(leaf, within + upper))
        else:
            folded.append(climbed(version(first, way, other)[0], upper))
    rows = table.num_rows
    return pa.table(
        {
            "doc_id": table.column("doc_id"),
            "leaf": pa.array([d.hex() for d in leaves], pa.string()),
            "subroot": pa.array([subroot.hex()] * rows, pa.string()),
            "root": pa.array([root.hex()] * rows, pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array([d.hex() for d in folded], pa.string()),
            "verified": pa.array([d == root for d in folded], pa.bool_()),
            "tampered": pa.array([d is not None for d in changed], pa.bool_()),
        }
    )


def tampered_text() -> Column:
    """What tampering makes of a text: it loses its line feeds."""
    return F.translate("text", "\n", "")


def verify_manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The manifest of ``docs``, and whether each row still folds to its root.

    Rows whose unsigned CRC-32 of the decimal ``doc_id`` is even are tampered
    with; ``tampered`` says whether that changed anything.
    """
    touched = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & (F.instr("text", "\n") > 0)
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf_digest().alias("digest"),
        F.when(touched, leaf_digest(tampered_text())).alias("tampered"),
    )
    placed = ranked(leaves, ["source", "doc_id", "digest"], "leaves")
    sizes = placed.groupBy("source").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    sources = ranked(sizes, ["source"], "sources", "tree").withColumnRenamed("source", "__source")
    joined = placed.join(sources, F.col("source").eqNullSafe(F.col("__source")))
    nodes = stored(
        joined.select("tree", "n", (F.col("rank") - F.col("first")).alias("pos"), "digest", "doc_id", "tampered"),
        "nodes",
    )

    layers = _grow(nodes, "blocks", depth)
    subroots = layers[-1].select("tree", "digest")
    count = subroots.count()
    upper = _grow(
        stored(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"),
                               F.col("tree").alias("pos"), "digest"), "subroots"),
        "blocks",
        depth,
    )
    top = upper[-1].select("tree", "pos", "digest", F.lit(b"").alias("trail"), F.col("digest").alias("top"))
    of_sources = _descend(upper[:-1], top, depth)  # the trail from each subroot to the root
    of_sources = of_sources.select(
        F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "digest", "trail", "top"
    )
    subroot = of_sources.select("tree", F.col("digest").alias("subroot"))
    of_blocks = _descend(layers[1:-1], of_sources, depth) if len(layers) > 1 else of_sources
    above = of_blocks.join(subroot, "tree").groupBy("tree", F.col("pos").alias("block"))
    return _by_block(nodes, depth).cogroup(above).applyInArrow(
        lambda t, up: _verified_block(t, up, depth), _MANIFEST
    )
