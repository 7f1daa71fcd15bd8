"""Conversation structure repair by one integer minimum.

A conversation is repaired when its roles' initials read ``(s?(ua)+)?``.  Rows
may be kept, given another role, deleted, and empty ones inserted.  The dearest
digits of a weight are the cost; below them every row has a field of two base-8
digits (``FIELD``), the letters of what happens there, with zeros at its end.
No field's letters begin another field's (an insertion comes before a row's
own letter), so comparing the digits compares the audit strings, and the
smallest integer is the cheapest repair with the ASCII-least audit.  An edge of
the DAG (row, state) -> (row + 1, state) has one fixed integer, and an ordinary
minimum over sums decides everything.

One insertion before a row is enough: two of them either return to the state
they left, or give one that is no better, or do as well at the end of the
conversation, where two are allowed.

A conversation may be a third of all rows.  Rows get their global place by a
range partition, ``BLOCK_ROWS`` neighbours of a conversation are a block, and a
block's weights from each state to each are made in parallel; they are joined
pairwise (costs add, digits follow each other).  Only the digits of a
conversation, which its ``audit`` returns anyway, and the running SHA-256
of its text, which has to see rows in order, pass through one task, the latter
as a stream that holds one row.

Defined results: null roles and texts are one space, as is a null id or turn in
the key of the damage; a null ``conv_id`` is a conversation; rows are taken by
turn (nulls first), then role, then text; equal rows are duplicates; an empty
role has no initial, so keeping it changes no state and it is illegal
beside another; roles of other initials can only be changed or deleted; very
long texts and conversations are read whole; a conversation that
damage leaves no rows has zeros, an empty audit and the hash of nothing; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import stored
from clickscope.llm.ranks import ranked

#: States: nothing yet, after s, after u, after a.  Insertions and new roles
#: take the only step that a state has to u or a.
STATES = range(4)
ENDS = {0: 0, 1: 2, 2: 1, 3: 0}  # insertions that a state needs at the end
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "e": {q: q for q in STATES}, "x": {}}
#: Costs of the edits, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Audit letters in ASCII order, as digits; zero is padding.
LETTERS = "0DIKR"
D, I, K, R = 1, 2, 3, 4
#: Bits of a digit and of a row's field.
DIGIT = 3
FIELD = 2 * DIGIT
BLOCK_ROWS = 256
#: Blocks whose weights a worker remembers.
CACHE = 50_000

BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"
_DELETED = "d"

Weights = tuple[tuple[int | None, ...], ...]


def _edges(code: str) -> list[tuple[int, int, int, int]]:
    """From, to, cost and field of a row: its initial, in capitals if it is
    truncated, or ``d`` if it has to go."""
    cut = TRUNCATED if code.isupper() else 0
    found = []
    for start in STATES:
        for inserted in (False, True):
            state, paid = (NEXT[start], INSERT) if inserted else (start, 0)
            choices = [(state, DELETE, D)]
            if code != _DELETED:
                choices.append((NEXT[state], REROLE + cut, R))
                if state in STEPS[code.lower()]:
                    choices.append((STEPS[code.lower()][state], cut, K))
            for end, cost, letter in choices:
                field = (I << DIGIT) | letter if inserted else letter << DIGIT
                found.append((start, end, paid + cost, field))
    return found


EDGES = {code: _edges(code) for code in ("s", "u", "a", "e", "x", "S", "U", "A", "E", "X", _DELETED)}


@lru_cache(CACHE)
def block_weights(codes: str) -> Weights:
    """The smallest weight from each state to each over a block's rows."""
    rows = len(codes)
    found = []
    for start in STATES:
        best: list[int | None] = [None] * 4
        best[start] = 0
        for row, code in enumerate(codes):
            place = FIELD * (rows - 1 - row)
            reached: list[int | None] = [None] * 4
            for q, p, cost, field in EDGES[code]:
                if best[q] is not None:
                    weight = best[q] + (cost << FIELD * rows) + (field << place)
                    if reached[p] is None or weight < reached[p]:
                        reached[p] = weight
            best = reached
        found.append(tuple(best))
    return tuple(found)


def joined(left: Weights, n_left: int, right: Weights, n_right: int) -> Weights:
    """Weights over ``n_left`` rows and the ``n_right`` that follow."""
    rows = n_left + n_right
    low = (1 << FIELD * n_right) - 1

    def follow(a: int, b: int) -> int:
        return (a << FIELD * n_right) + (b >> FIELD * n_right << FIELD * rows) + (b & low)

    return tuple(
        tuple(
            min((follow(a, right[m][p]) for m, a in enumerate(line) if a is not None and right[m][p] is not None),
                default=None)
            for p in STATES
        )
        for line in left
    )


def whole(blocks: Iterable[tuple[Weights, int]]) -> tuple[Weights, int]:
    """All blocks joined, neighbours of like size first."""
    heap: list[tuple[Weights, int]] = []
    for weights, rows in blocks:
        heap.append((weights, rows))
        while len(heap) > 1 and heap[-2][1] <= heap[-1][1]:
            (right, m), (left, n) = heap.pop(), heap.pop()
            heap.append((joined(left, n, right, m), n + m))
    while len(heap) > 1:
        (right, m), (left, n) = heap.pop(), heap.pop()
        heap.append((joined(left, n, right, m), n + m))
    return heap[0]


def cheapest(weights: Weights, rows: int) -> tuple[int, str]:
    """Cost and digits of the best repair: two digits a row, two for the end."""
    width = FIELD * (rows + 1)
    ends = []
    for state, weight in enumerate(weights[0]):
        if weight is not None:
            n = ENDS[state]
            field = (I << DIGIT | I) if n == 2 else I << DIGIT if n else 0
            ends.append((weight << FIELD) + (n * INSERT << width) + field)
    best = min(ends)
    return best >> width, format(best & ((1 << width) - 1), f"0{2 * (rows + 1)}o")


def repair(codes: str) -> tuple[int, str]:
    """Cost and audit of one conversation, from its rows' codes."""
    cost, digits = cheapest(block_weights(codes), len(codes))
    return cost, audit_of(digits)


_TO_LETTERS = str.maketrans("1234", LETTERS[1:], "0")


def audit_of(digits: str) -> str:
    return digits.translate(_TO_LETTERS)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) that damage leaves, nulls as one space."""

    def spaced(name: str) -> str:
        return f"coalesce(cast(`{name}` as string), ' ')"

    rows = conversations.selectExpr(
        "cast(conv_id as long) as conv_id", "cast(turn as long) as turn",
        f"{spaced('role')} as role", f"{spaced('text')} as text",
        f"crc32(concat({spaced('conv_id')}, ':', {spaced('turn')})) % 20 as harm",
    )
    return rows.where("harm <> 0").selectExpr(
        "conv_id", "turn", "if(harm = 4, 'user', role) as role",
        "case harm when 1 then '' when 2 then translate(text, '.!?', '') else text end as text",
        "explode(if(harm = 3, array(0, 1), array(0))) as copy",
    )


_SPACES = "concat(' ', char(9), char(10), char(11), char(12), char(13))"


def with_faults(rows: DataFrame) -> DataFrame:
    """Each row's first fault, its initial's code, and which equal row it is."""
    alike = Window.partitionBy("conv_id", "role", "text").orderBy("turn", "copy")
    return (
        rows.withColumn("nth", F.row_number().over(alike))
        .withColumn("last", F.expr(f"right(rtrim({_SPACES}, text), 1)"))
        .withColumn(
            "fault",
            F.expr(
                f"case when last = '' then '{BLANK}' when nth > 1 then '{DUPLICATE}' "
                f"when last not in ('.', '!', '?') then '{CUT}' end"
            ),
        )
        .withColumn("initial", F.expr("if(role = '', 'e', left(role, 1))"))
        .withColumn("initial", F.expr("if(role = '' or initial in ('s', 'u', 'a'), initial, 'x')"))
        .withColumn(
            "code",
            F.expr(
                f"case when fault in ('{BLANK}', '{DUPLICATE}') then '{_DELETED}' "
                f"when fault = '{CUT}' then upper(initial) else initial end"
            ),
        )
        .drop("copy", "last", "initial")
    )


def _packed(weights: Weights) -> list[bytes | None]:
    return [None if w is None else w.to_bytes(w.bit_length() // 8 + 1, "big") for line in weights for w in line]


def _unpacked(packed: list[bytes | None]) -> Weights:
    flat = [None if w is None else int.from_bytes(w, "big") for w in packed]
    return tuple(tuple(flat[4 * q : 4 * q + 4]) for q in STATES)


def _weights_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch.column("codes").to_pylist()
        yield pa.record_batch(
            {
                "conv_id": batch.column("conv_id"),
                "block": batch.column("block"),
                "n": pa.array([len(c) for c in codes], pa.int64()),
                "weights": pa.array([_packed(block_weights(c)) for c in codes], pa.list_(pa.binary())),
            }
        )


#: Rows of output that a worker gathers before it hands them on.
_OUT_ROWS = 4096
_PLAN = "conv_id long, block long, digits string, cost long"


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block of a conversation (in order) the digits of its rows; the
    last also has the end's digits, and all have the cost."""
    out: list[tuple] = []

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [()] * 4
        out.clear()
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64())
        names = ("conv_id", "block", "digits", "cost")
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))

    for conv, blocks in _groups(batches, ("block", "n", "weights")):
        sizes: list[tuple[int, int]] = []

        def each(blocks=blocks, sizes=sizes):
            for block, n, weights in blocks:
                sizes.append((block, n))
                yield _unpacked(weights), n

        cost, digits = cheapest(*whole(each()))
        at = 0
        for k, (block, n) in enumerate(sizes):
            end = at + 2 * n if k + 1 < len(sizes) else len(digits)
            out.append((conv, block, digits[at:end], cost))
            at = end
            if len(out) >= _OUT_ROWS:
                yield flushed()
    yield flushed()


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Consecutive rows of equal ``conv_id``; a group has to be read to its end before the next."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(batch.column("conv_id").to_pylist(), *(batch.column(n).to_pylist() for n in names))

    stream = rows()
    ahead = next(stream, None)
    while ahead is not None:
        conv = ahead[0]

        def members(conv=conv) -> Iterator[tuple]:
            nonlocal ahead
            while ahead is not None and ahead[0] == conv:
                yield ahead[1:]
                ahead = next(stream, None)

        yield conv, members()


_RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)
_LEGAL = {"su", "ua", "au"}
_ROLES = {2: "user", 3: "assistant"}


class _Repaired:
    """The running digest of a repaired conversation."""

    def __init__(self) -> None:
        self.digest, self.state, self.any = sha256(), 0, False

    def put(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.any else "").encode() + role.encode() + b":" + text.encode())
        self.any = True

    def insert(self) -> None:
        self.state = NEXT[self.state]
        self.put(_ROLES[self.state], "")

    def row(self, letter: str, role: str, text: str) -> None:
        if letter == "R":
            self.state = NEXT[self.state]
            self.put(_ROLES[self.state], text)
        elif letter == "K":
            self.state = STEPS[role[:1] or "e"][self.state]
            self.put(role, text)


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation, from its plan's blocks, each before the rows it is for."""
    out: list[tuple] = []
    names = [part.split()[0] for part in _RESULT.split(", ")]
    kinds = [pa.string() if " string" in part else pa.int64() for part in _RESULT.split(", ")]

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [()] * len(names)
        out.clear()
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for conv, rows in _groups(batches, ("digits", "cost", "turn", "role", "text", "fault", "kind")):
        counts = dict.fromkeys((BLANK, DUPLICATE, CUT, "illegal"), 0)
        told, audit, least, most, turns = _Repaired(), [], None, None, 0
        total, before, fields, at = 0, None, "", 0
        for digits, cost, turn, role, text, fault, kind in rows:
            if kind == 0:  # the conversation's mark
                continue
            if kind == 1:
                fields, at, total = digits, 0, cost
                audit.append(audit_of(digits))
                continue
            if fault is not None:
                counts[fault] += 1
            initial = role[:1]
            if before is not None and before + initial not in _LEGAL:
                counts["illegal"] += 1
            before = initial
            if turn is not None and turn != most:
                turns += 1
                least, most = turn if least is None else least, turn
            field = audit_of(fields[at : at + 2])
            at += 2
            if len(field) > 1:
                told.insert()
            told.row(field[-1], role, text)
        for _ in audit_of(fields[at:]):
            told.insert()
        gaps = 0 if most is None else most - least + 1 - turns
        out.append((conv, gaps, counts[BLANK], counts[DUPLICATE], counts[CUT], counts["illegal"],
                    total, "".join(audit), told.digest.hexdigest()))
        if len(out) >= _OUT_ROWS:
            yield flushed()
    yield flushed()


def repair_plans(rows: DataFrame) -> DataFrame:
    """Digits and cost for each block of the placed ``rows`` (conv_id, place, code)."""
    block = F.expr(f"place div {BLOCK_ROWS}").alias("block")
    ordered = F.array_sort(F.collect_list(F.struct("place", "code")))  # at most BLOCK_ROWS
    codes = F.array_join(F.transform(ordered, lambda x: x["code"]), "").alias("codes")
    blocks = rows.groupBy("conv_id", block).agg(codes)
    weights = blocks.mapInArrow(_weights_of_blocks, "conv_id long, block long, n long, weights array<binary>")
    return weights.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_plans, _PLAN)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row for each ``conv_id``: its faults and its cheapest repair after damage."""
    rows = ranked(with_faults(damaged(conversations)), ["conv_id", "turn", "role", "text", "nth"], "turns", "place")
    plans = stored(repair_plans(rows), "repairs")
    marks = conversations.selectExpr("cast(conv_id as long) as conv_id").distinct()
    told = (
        marks.selectExpr("conv_id", "-1L as block", "0 as kind", "0L as place", "'' as digits", "0L as cost",
                         "cast(null as long) as turn", "'' as role", "'' as text", "cast(null as string) as fault")
        .unionByName(
            plans.selectExpr("conv_id", "block", "1 as kind", "0L as place", "digits", "cost",
                             "cast(null as long) as turn", "'' as role", "'' as text", "cast(null as string) as fault"))
        .unionByName(
            rows.selectExpr("conv_id", f"place div {BLOCK_ROWS} as block", "2 as kind", "place", "'' as digits",
                            "0L as cost", "turn", "role", "text", "fault"))
    )
    lined = told.repartition("conv_id").sortWithinPartitions("conv_id", "block", "kind", "place")
    return lined.mapInArrow(_results, _RESULT)
