"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens and accepts exactly the token sequences that the
merges produce.  It begins as one state with an arc for every base symbol.
The gadget of a merge (u, v) changes it so: the state reached by u is copied
without its v-arc, the u-arcs lead to the copy, and wherever u and then v
could be read there is now an arc for the merged token, leading where v led.
All arcs of one label lead to one state, so a state is named by the token
that was read last.

Listed in full, the arcs of a 49k vocabulary would number about two thousand
million, nearly all alike.  So the construction keeps, for each gadget, the
arc it cuts and its step; an arc's presence follows from the copies on the
way to a state (its token's right parts, each as of the step it was merged)
and from the arcs on the way to a label (its left parts likewise).  Arcs that
texts ask for are entered in the transition table once, and encoding runs on
that table.

Defined results: null and empty texts have no tokens and decode to the empty
string; a word with a symbol outside the vocabulary drops that symbol, as
the library does without an unknown token; whole texts of any length are
encoded; repeated rows each give a row; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import binary_column, map_batches
from clickscope.llm.wordsplit import CACHE_ENTRIES, Remembered, WordSplitter

ALWAYS = 1 << 60


def byte_alphabet() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: printable bytes stand for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class MergeAutomaton:
    """Deterministic automaton of a list of merges; states are tokens, ``START`` the start."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]) -> None:
        self.label = {i: t for t, i in vocab.items()}
        self.start = self.width = max(vocab.values(), default=0) + 1
        #: u * width + v -> step of the gadget that cut the v-arc after u
        self.cut: dict[int, int] = {}
        #: token -> (its left part, its right part, its step)
        self.made: dict[int, tuple[int, int, int]] = {}
        for step, (u, v) in enumerate(merges):
            self._gadget(vocab[u], vocab[v], vocab[u + v], step)
        #: (state * width + label) -> whether the arc is there
        self.arcs = Remembered(self._arc, 4 * CACHE_ENTRIES)
        self._rights = Remembered(lambda token: self._parts(token, 1))
        self._lefts = Remembered(lambda token: self._parts(token, 0))

    def _gadget(self, u: int, v: int, merged: int, step: int) -> None:
        self.cut.setdefault(u * self.width + v, step)
        self.made.setdefault(merged, (u, v, step))

    def _parts(self, token: int, side: int) -> list[tuple[int, int]]:
        """The token and its outer parts, each with the step at which it was merged away."""
        out, until = [(token, ALWAYS)], ALWAYS
        while token in self.made:
            token, until = self.made[token][side], self.made[token][2]
            out.append((token, until))
        return out

    def _arc(self, pair: int) -> bool:
        """Whether the state of one token has an arc for another.

        A gadget counts if it came before the copy of the state was taken.
        It also has to come before the label's own arcs were added; the
        gadget that adds them itself cuts first.
        """
        state, label = divmod(pair, self.width)
        if state == self.start:
            return True
        cut, labels = self.cut, self._lefts[label]
        for x, copied in self._rights[state]:
            row = x * self.width
            for y, added in labels:
                step = cut.get(row + y)
                if step is not None and step < copied and step <= added:
                    return False
        return True

    def spellings(self, symbols: set[str]) -> dict[str, int]:
        """Every beginning of a label -> its token, or -1 where no label ends.

        Labels are base symbols and merged tokens; no other entry of a
        vocabulary is ever an arc.
        """
        table: dict[str, int] = {}
        for token, text in self.label.items():
            if token in self.made or text in symbols:
                table[text] = token
        for text in list(table):
            for end in range(1, len(text)):
                table.setdefault(text[:end], -1)
        return table

    def encode(self, whole: str, ends: int, table: dict[str, int]) -> list[int]:
        """The one accepted path over a word of single-letter symbols.

        Follows the longest arc first and steps back where no arc leads on.
        ``whole`` has a suffix after its last symbol, ``ends`` symbols in all;
        the paths to a position agree, so a position is left for good.
        """
        arcs, width, last = self.arcs, self.width, ends - 1
        path: list[int] = []
        begins = [0]
        dead = set()
        row = self.start * width
        while begins[-1] < ends:
            i = begins[-1]
            found = []
            for j in range(i, last):
                token = table.get(whole[i : j + 1])
                if token is None:
                    break
                if token >= 0:
                    found.append((token, j + 1))
            else:
                token = table.get(whole[i:], -1)
                if token >= 0:
                    found.append((token, ends))
            while found:
                token, j = found.pop()
                if j not in dead and arcs[row + token]:
                    path.append(token)
                    begins.append(j)
                    break
            else:
                if not path:
                    raise ValueError(f"no path reads {whole!r}")
                dead.add(begins.pop())
                path.pop()
            row = (path[-1] if path else self.start) * width
        return path


class WordBpe:
    """Encodes texts as the tokenizer file says and decodes ids back."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = {**model["vocab"]}
        self.automaton = MergeAutomaton(vocab, merges)
        self.label = {**self.automaton.label, **{t["id"]: t["content"] for t in spec["added_tokens"]}}
        self.letters = byte_alphabet()
        bases = {*self.letters.values(), *(x + self.suffix for x in self.letters.values())}
        self.known = bases & set(vocab)
        self.table = self.automaton.spellings(self.known)
        self.of_token = {i: (i.to_bytes(4, "little"), b" " + t.encode()) for i, t in self.label.items()}
        self.splitter = WordSplitter(path, self._word)

    def _word(self, word: str | int) -> tuple[bytes, bytes]:
        """Ids (little-endian, 32 bits) and labels (each with a space before it)."""
        if isinstance(word, int):
            return self.of_token[word]
        symbols = [self.letters[b] for b in word.encode()]
        kept = [x for x in symbols[:-1] if x in self.known]
        if symbols[-1] + self.suffix in self.known:
            kept.append(symbols[-1])
        if not kept:
            return b"", b""
        whole = "".join(kept) + (self.suffix if kept[-1] is symbols[-1] else "")
        path = [self.of_token[t] for t in self.automaton.encode(whole, len(kept), self.table)]
        return b"".join([t[0] for t in path]), b"".join([t[1] for t in path])

    def encode(self, text: bytes) -> bytes:
        return b"".join([v[0] for v in self.splitter.values(text)])

    def encode_decode(self, text: bytes) -> tuple[bytes, bytes]:
        """Ids of a text, and what those ids decode to (their labels, spaced)."""
        values = self.splitter.values(text)
        return b"".join([v[0] for v in values]), b"".join([v[1] for v in values])[1:]

    def decode(self, ids: list[int]) -> str:
        """Emit the label of every arc of the path; unknown ids emit nothing."""
        return " ".join(self.label[i] for i in ids if i in self.label)


def _coded(docs: DataFrame, path: str, columns: dict[str, str]) -> DataFrame:
    """``doc_id`` and the wanted columns of every whole text, encoded and decoded."""
    coders: list[WordBpe] = []
    make = {
        "n_tokens": lambda ids, decoded: len(ids) // 4,
        "ids_sha256": lambda ids, decoded: hashlib.sha256(ids).hexdigest(),
        "decoded_sha256": lambda ids, decoded: hashlib.sha256(decoded).hexdigest(),
        "decoded": lambda ids, decoded: decoded.decode(),
        "ids": lambda ids, decoded: ids,
    }

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not coders:
            coders.append(WordBpe(path))
        made: dict[str, list] = {name: [] for name in columns}
        for text in binary_column(batch, "text"):
            pair = coders[0].encode_decode(text or b"")
            for name, values in made.items():
                values.append(make[name](*pair))
        arrays = [batch.column("doc_id")]
        for name, values in made.items():
            if name == "ids":
                offsets = np.cumsum([0, *(len(v) // 4 for v in values)]).astype(np.int32)
                flat = np.frombuffer(b"".join(values), "<i4")
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
            else:
                arrays.append(pa.array(values, pa.int64() if name == "n_tokens" else pa.string()))
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *made])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = ", ".join(["doc_id long", *(f"{name} {kind}" for name, kind in columns.items())])
    return map_batches(rows, work, schema)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``decoded`` of every whole text."""
    return _coded(docs, path, {"n_tokens": "long", "ids": "array<int>", "decoded": "string"})


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """Number of tokens, and digests of the ids and of what they decode to."""
    return _coded(docs, path, {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"})


def training_rows(docs: DataFrame, path: str) -> DataFrame:
    """Token ids of every whole text, with the digest of what they decode to."""
    return _coded(docs, path, {"n_tokens": "long", "ids": "array<int>", "decoded_sha256": "string"})
