"""Licence scan: Aho-Corasick for tags and phrases, shunting-yard for expressions.

A text is lower-cased (A-Z), cut into words, and one Aho-Corasick automaton
finds every notice phrase and the identifier tag.  Where the tag occurs, the
expression after it is parsed by a shunting-yard parser (``with`` binds
before ``and``, ``and`` before ``or``) and evaluated against the permissive
licences.

Defined results: a null or empty text has no words, no places, null word
positions, empty labels and score 0; a malformed expression adds the label
``spdx:invalid``, and prose after an expression adds none; very long texts are
scanned whole, in time in proportion to their length; repeated rows each give
a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from clickscope.llm.common import binary_column, map_batches

# Fixed values of the contract: phrase (its words) and label.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: More notice phrases and the labels that they add.
NOTICE_PHRASES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license": "epl",
    "bsd 2 clause license": "bsd-2",
    "bsd 3 clause license": "bsd-3",
    "cc by sa": "cc-by-sa",
    "cc by 4 0": "cc-by",
    "cc0 1 0": "cc0",
    "all rights reserved": "reserved",
    "released into the public domain": "public-domain",
    "permission is hereby granted free of charge": "mit-text",
}
TAG_PHRASE = "spdx license identifier"
#: Identifiers that the evaluation takes as permissive.
PERMISSIVE = {"mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "cc0-1.0", "unlicense", "0bsd", "cc-by-4.0"}
#: Exceptions that make a copyleft licence usable beside other code.
LINKING_EXCEPTIONS = {"classpath-exception-2.0", "llvm-exception", "gcc-exception-3.1", "linux-syscall-note"}

# How sure one place of each kind makes us that the text carries a licence.
PHRASE_WEIGHT, TAG_WEIGHT, INVALID_WEIGHT = 0.8, 0.95, 0.5

_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_TAG = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)")
_PIECE = re.compile(r"[()]|[a-z0-9.+:-]+|\S")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: Identifiers without a digit or a dash, besides the permissive ones.
_PLAIN_NAMES = {
    "beerware", "curl", "eurosym", "fair", "glide", "imagemagick", "info-zip", "intel", "jasper", "json", "libpng",
    "mitnfa", "naumen", "ncsa", "netcdf", "ngpl", "openssl", "ospl", "postgresql", "python", "qhull", "rsa-md", "ruby",
    "sleepycat", "tcl", "vim", "wtfpl", "x11", "xfree86", "xinetd", "xnet", "zed",
}


def parse_expression(text: str) -> list[str] | None:
    """Reverse Polish form of the longest expression that ``text`` begins with.

    Ends quietly before whatever cannot continue an expression (a comment's
    end, prose).  ``None`` if no complete expression stands there.
    """
    output: list[str] = []
    operators: list[str] = []
    # the operators that close the longest complete expression, and how much of the output it has
    complete: tuple[int, list[str]] | None = None
    operand_next, depth = True, 0
    for piece in _PIECE.findall(text.lower()):
        if operand_next:
            if piece == "(":
                operators.append(piece)
                depth += 1
                continue
            if piece in _PRECEDENCE or not piece[0].isalnum():
                break
            if output and not _looks_like_a_name(piece):  # prose goes on after the expression
                break
            output.append(piece)
            operand_next = False
        elif piece in _PRECEDENCE:
            while operators and operators[-1] != "(" and _PRECEDENCE[operators[-1]] >= _PRECEDENCE[piece]:
                output.append(operators.pop())
            operators.append(piece)
            operand_next = True
        elif piece == ")" and depth:
            while operators[-1] != "(":
                output.append(operators.pop())
            operators.pop()
            depth -= 1
        else:
            break
        if not operand_next and not depth:
            complete = len(output), operators[::-1]  # outside parentheses at most one of each kind waits
    return output[: complete[0]] + complete[1] if complete else None


def _looks_like_a_name(piece: str) -> bool:
    """An identifier after an operator: known, or with a digit, a dash or a colon, as prose has not."""
    return piece in PERMISSIVE or piece in _PLAIN_NAMES or any(c.isdigit() or c in "-:+" for c in piece)


def evaluate(postfix: list[str]) -> tuple[bool, set[str]]:
    """Whether the terms allow permissive use, and the licences named."""
    stack: list[tuple[bool, str]] = []
    named = set()
    for piece in postfix:
        if piece not in _PRECEDENCE:
            stack.append((piece in PERMISSIVE, piece))
            continue
        (right, exception), (left, name) = stack.pop(), stack.pop()
        if piece == "or":
            stack.append((left or right, name))
        elif piece == "and":
            stack.append((left and right, name))
        else:
            named.discard(exception)
            stack.append((left or exception in LINKING_EXCEPTIONS, name))
    exceptions = {postfix[i - 1] for i, piece in enumerate(postfix) if piece == "with"}
    return stack[0][0], {p for p in postfix if p not in _PRECEDENCE} - exceptions


class LicenceScanner:
    """One automaton for all phrases and the tag; made once in each worker."""

    def __init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for kind, phrases in ((0, BASE_PHRASES), (1, NOTICE_PHRASES), (2, {TAG_PHRASE: ""})):
            for phrase, label in phrases.items():
                self.automaton.add_word(f" {phrase} ", (kind, len(phrase) + 2, label))
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple:
        """n_words, n_base, first, last, base labels, all labels, score, permissive."""
        words = text.translate(_WORDS).split()
        spaced = (b" " + b" ".join(words) + b" ") if words else b""
        first = last = permissive = None
        base: set[str] = set()
        labels: set[str] = set()
        doubt, n_base, tagged = 1.0, 0, False
        counted, at = 0, 0  # spaces before a position that only moves on
        # Latin-1 maps each byte to one character, so byte positions stay.
        for end, (kind, size, label) in self.automaton.iter(spaced.decode("latin-1")):
            if kind == 2:
                tagged = True
                continue
            if label not in labels:
                doubt *= 1 - PHRASE_WEIGHT
            labels.add(label)
            if kind == 0:
                begin = end + 1 - size
                # matches come by their ends, and a longer one may begin before the last: step back by as much
                at += spaced.count(b" ", counted, begin) if begin >= counted else -spaced.count(b" ", begin, counted)
                counted = begin
                first = at if first is None else min(first, at)
                last = at if last is None else max(last, at)
                n_base += 1
                base.add(label)
        if tagged:
            for found in _TAG.finditer(text.lower()):
                postfix = parse_expression(found[1].decode("utf-8", "replace"))
                if postfix is None:
                    labels.add("spdx:invalid")
                    doubt *= 1 - INVALID_WEIGHT
                    continue
                allowed, named = evaluate(postfix)
                permissive = allowed if permissive is None else permissive and allowed
                labels |= {f"spdx:{x}" for x in named}
                doubt *= 1 - TAG_WEIGHT
        return len(words), n_base, first, last, base, labels, 1.0 - doubt, permissive


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, permissive boolean"
)


def scan_licences(docs: DataFrame) -> DataFrame:
    """Licence places and labels of every whole text; a map over the rows."""
    scanners: list[LicenceScanner] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not scanners:
            scanners.append(LicenceScanner())
        found = [scanners[0].scan(t or b"") for t in binary_column(batch, "text")]
        count = pa.int64()
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(pa.array([f[i] for f in found], count) for i in range(4)),
                *(pa.array([",".join(sorted(f[i])) for f in found], pa.string()) for i in (4, 5)),
                pa.array([f[6] for f in found], pa.float64()),
                pa.array([f[7] for f in found], pa.bool_()),
            ],
            names=[c.split()[0] for c in SCHEMA.split(", ")],
        )

    from pyspark.sql import functions as F

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, SCHEMA)
