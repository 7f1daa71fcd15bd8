"""Conversation repair against an enumeration of edits, a DP over strings, and awkward tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from clickscope.llm import conversations as C

SHAPE = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\x0b\x0c\r"


def enumerated(codes: str) -> tuple[int, str]:
    """Every choice of edits, two insertions at most in each gap."""
    gaps = ["", "u", "a", "ua", "au", "uu", "aa"]

    def choices(code: str):
        yield "", 3, "D"
        if code != "d":
            cut = code.isupper()
            for role in "ua":
                yield role, 2 + cut, "R"
            yield ("" if code.lower() == "e" else code.lower()), int(cut), "K"

    best = None
    for rows in itertools.product(*map(list, map(choices, codes))):
        for put in itertools.product(gaps, repeat=len(codes) + 1):
            roles = "".join(p + r[0] for p, r in zip(put, rows)) + put[-1]
            if SHAPE.fullmatch(roles):
                cost = sum(r[1] for r in rows) + 2 * sum(map(len, put))
                audit = "".join("I" * len(p) + r[2] for p, r in zip(put, rows)) + "I" * len(put[-1])
                if best is None or (cost, audit) < best:
                    best = cost, audit
    return best


def by_strings(codes: str) -> tuple[int, str, str]:
    """A minimum over (cost, audit) pairs, with the roles it gives."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", "")}
    for code in codes:
        spread = dict(best)
        for _ in range(3):
            for q, (c, a, r) in list(spread.items()):
                for role in "ua":
                    p = step.get((q, role))
                    if p and (c + 2, a + "I", r + role) < spread.get(p, (10**9,)):
                        spread[p] = (c + 2, a + "I", r + role)
        reached = {}
        # an insertion before a deletion is never better than after it, so both tables may be merged
        for q, (c, a, r) in spread.items():
            options = [(q, 3, "D", "")]
            if code != "d":
                cut = int(code.isupper())
                options += [(step[q, x], 2 + cut, "R", x) for x in "ua" if (q, x) in step]
                kept = code.lower()
                if kept == "e":
                    options.append((q, cut, "K", ""))
                elif (q, kept) in step:
                    options.append((step[q, kept], cut, "K", kept))
            for p, cost, letter, role in options:
                new = (c + cost, a + letter, r + role)
                if new < reached.get(p, (10**9,)):
                    reached[p] = new
        best = reached
    ended = [best[q] for q in ("", "a") if q in best]
    if "s" in best:
        c, a, r = best["s"]
        ended.append((c + 4, a + "II", r + "ua"))
    if "u" in best:
        c, a, r = best["u"]
        ended.append((c + 2, a + "I", r + "a"))
    return min(ended)


def test_every_short_conversation_against_all_edits():
    for n in (1, 2):
        for codes in itertools.product("suaxeSUAXEd", repeat=n):
            assert C.repair("".join(codes)) == enumerated("".join(codes)), codes
    r = random.Random(5)
    for _ in range(12):
        codes = "".join(r.choice("suaxSUAd") for _ in range(3))
        assert C.repair(codes) == enumerated(codes), codes


@pytest.mark.parametrize("seed", range(4))
def test_long_conversations_and_joined_blocks(seed):
    r = random.Random(seed)
    for n in (4, 7, 12, 40, 150):
        codes = "".join(r.choice("ssuuuuaaaaxeSUAd") for _ in range(n))
        want = by_strings(codes)[:2]
        assert C.repair(codes) == want
        cuts = sorted(r.sample(range(1, n), min(3, n - 1)))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, n])]
        cost, digits = C.cheapest(*C.whole((C.block_weights(p), len(p)) for p in parts))
        assert (cost, C.audit_of(digits)) == want


def test_packing_keeps_weights():
    weights = C.block_weights("suaUd" * 20)
    assert C._unpacked(C._packed(weights)) == weights


def brute(rows):
    """The contract, row by row in plain Python."""
    harmed = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(key.encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        harmed += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    groups = defaultdict(list)
    for row in harmed:
        groups[row[0]].append(row[1:])
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, codes = set(), [], ""
        for _, role, text in mine:
            end = text.rstrip(SPACES)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x" if role else "e"
            codes += "d" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
        cost, audit, roles = by_strings(codes) if mine else (0, "", "")
        told, at, used = [], 0, 0
        name = {"u": "user", "a": "assistant"}
        for letter in audit:
            if letter == "I":
                told.append(name[roles[used]] + ":")
                used += 1
                continue
            _, role, text = mine[at]
            at += 1
            if letter == "R":
                role = name[roles[used]]
            if letter != "D":
                told.append(f"{role}:{text}")
                used += 1 if role else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:])]
        turns = {r[0] for r in mine if r[0] is not None}
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(told).encode()).hexdigest(),
        )
    return out


def repaired(df):
    rows = C.repair_conversations(df).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


SCHEMA = "conv_id long, turn long, role string, text string, place long, code string, fault string, block int, nth int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 9, "x", "y", 3, 4) for r in rows], SCHEMA)


def test_table_against_brute_force(spark):
    r = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", None, "ufo", "User"]
    texts = ["a.", "b?", "cut", "", None, " \t", "x.\x0b", "x\u00a0", "é!", "two\nlines.", "y. z", "." * 9000]
    rows = []
    for conv in [*range(60), None]:
        for _ in range(r.randrange(1, 9)):
            rows.append((conv, r.choice([None, *range(-1, 9)]), r.choice(roles), r.choice(texts)))
    rows += rows[::7]  # whole rows repeated
    got = repaired(table(spark, rows).repartition(5))
    assert got == brute(rows)
    assert {"blank", "duplicate"} and any(v[1] for v in got.values()) and any(v[4] for v in got.values())


def test_hot_conversation_crosses_blocks_and_partitions(spark):
    r = random.Random(8)
    rows = [(7, t, r.choice(["user", "assistant"]), r.choice([f"text {t}.", f"text {t}", "same."])) for t in range(1500)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in range(100, 130) for t in range(4)]
    assert repaired(table(spark, rows).repartition(4)) == brute(rows)


def test_conversation_that_damage_empties_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert repaired(table(spark, [(gone, 0, "user", "a.")])) == {gone: (0, 0, 0, 0, 0, 0, "", nothing)}
    assert repaired(table(spark, [])) == {}
