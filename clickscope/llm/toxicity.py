"""Toxicity scoring by a bidirectional gated recurrent network with attention.

Every word enters as a word embedding (hashed) and a character embedding (the
largest of its hashed character n-grams in each dimension, word ends marked).  Two gated recurrent
layers read a window of words forwards and backwards, attention pools their
states, and a logistic unit gives the window's score.  All overlapping windows
of ``WINDOW`` words are scored, one from every word on; the text's score is the
largest.  A shorter text is one window.

The network is trained here, in numpy.  A label belongs to a text, not to a
window, so training learns from the windows of a toxic text that look most
toxic (first by n-gram log-odds, then by the network) and from both the worst
and ordinary windows of clean texts.

Defined results: null and empty texts and texts without a word score 0; with
no labelled rows of both kinds every score is 0; a label other than 0 or 1 is
not learned from; very long texts are scored whole but not learned from (over
``SAMPLE_TEXT_BYTES``); repeated rows each give a row (a ``doc_id`` with several
label rows counts as toxic if any says so, one with several texts is learned
from once, by the largest of them); of windows with equal scores any gives the
text's; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.llm.common import binary_column, text_blocks

#: Bounds of the labelled sample that the network is trained on (about).
SAMPLE_TOXIC, SAMPLE_CLEAN = 900, 1800
#: Longest text that is learned from, and bytes of all sampled texts of a label.
SAMPLE_TEXT_BYTES, SAMPLE_BYTES = 1 << 16, {1: 8 << 20, 0: 16 << 20}
THRESHOLD = 0.7
WINDOW = 8
HIDDEN, ATTENTION = 8, 8
WORD_DIMS, CHAR_DIMS = 6, 10
WORD_BUCKETS, CHAR_BUCKETS = 1 << 12, 1 << 15
GRAM_SIZES = (3, 4, 5)
EPOCHS = (4, 2, 2, 2)
#: How far apart the chosen windows of a clean and of a toxic text begin.
NEAR = (WINDOW, 1)
#: Worst windows of a text and, for each text, other clean windows that an epoch reads.
WORST, OTHERS = 6, 2
#: Toxic texts that have to hold an n-gram for its log-odds to count.
SUPPORT = 4
BATCH = 512
LEARNING_RATE, DECAY = 0.015, 0.5
SEED = 17
#: Words that a worker remembers, and windows that it scores at once.
CACHE_WORDS, SCORE_WINDOWS = 250_000, 2048
_HASH_RANGE = 1_000_000

_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket of each word; buckets of all character n-grams; where each word's begin."""
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    data = np.frombuffer(b"".join([b"<" + w + b">" for w in words]), np.uint8).astype(np.uint32)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    end_of = np.repeat(ends, sizes)
    at = np.arange(len(data))
    found, owners = [], []
    for n in GRAM_SIZES:
        if len(data) < n:
            continue
        code = np.full(len(data) - n + 1, n, np.uint32)
        for k in range(n):
            code = code * np.uint32(0x01000193) ^ data[k : len(data) - n + 1 + k]
        inside = at[: len(code)] + n <= end_of[: len(code)]
        found.append((code[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15))
        owners.append(owner[: len(code)][inside])
    owners_all = np.concatenate(owners)
    order = np.argsort(owners_all, kind="stable")
    buckets = np.concatenate(found)[order].astype(np.int64) % CHAR_BUCKETS
    begins = np.searchsorted(owners_all[order], np.arange(len(words)))
    # The word bucket mixes all bytes of the word.
    mixed = (data + np.uint32(1)) * (np.uint32(0x85EBCA6B) + (at - (end_of - np.repeat(sizes, sizes))).astype(np.uint32) * np.uint32(0xC2B2AE35))
    mixed ^= mixed >> np.uint32(15)
    word = (np.add.reduceat(mixed, ends - sizes, dtype=np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - 12)
    return word.astype(np.int64) % WORD_BUCKETS, buckets, begins


def grams_in_parts(words: list[bytes], part: int = 10_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`word_grams` of many words, whose large arrays are made part by part."""
    made = [word_grams(words[i : i + part]) for i in range(0, len(words), part)]
    sizes = np.cumsum([0, *(len(m[1]) for m in made)])
    return (
        np.concatenate([m[0] for m in made]),
        np.concatenate([m[1].astype(np.int32) for m in made]),
        np.concatenate([m[2] + size for m, size in zip(made, sizes)]),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _one_over_one_plus_exp(x: np.ndarray) -> None:
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


class Network:
    """Parameters by name; gates in the order update, reset, candidate."""

    def __init__(self, seed: int = SEED) -> None:
        r = np.random.default_rng(seed)
        inputs = WORD_DIMS + CHAR_DIMS

        def normal(scale: float, *shape: int) -> np.ndarray:
            return (scale * r.standard_normal(shape)).astype(np.float32)

        self.p = {
            "word": normal(0.05, WORD_BUCKETS, WORD_DIMS),
            "char": normal(0.05, CHAR_BUCKETS, CHAR_DIMS),
            "in_f": normal(0.3, inputs, 3 * HIDDEN),
            "in_b": normal(0.3, inputs, 3 * HIDDEN),
            "bias_f": np.zeros(3 * HIDDEN, np.float32),
            "bias_b": np.zeros(3 * HIDDEN, np.float32),
            "rec_f": normal(0.3, HIDDEN, 3 * HIDDEN),
            "rec_b": normal(0.3, HIDDEN, 3 * HIDDEN),
            "att": normal(0.3, 2 * HIDDEN, ATTENTION),
            "att_v": normal(0.3, ATTENTION),
            "out": normal(0.3, 2 * HIDDEN),
            "out_b": np.zeros(1, np.float32),
        }

    def inputs_of(self, words: list[bytes]) -> np.ndarray:
        """Input vector of every word."""
        word, buckets, begins = word_grams(words)
        chars = np.maximum.reduceat(self.p["char"][buckets], begins, axis=0)
        return np.concatenate([self.p["word"][word], chars], axis=1)

    def projections(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.p
        return x @ p["in_f"] + p["bias_f"], x @ p["in_b"] + p["bias_b"]

    def _layer(self, gates: np.ndarray, mask: np.ndarray | None, rec: np.ndarray, keep: list | None) -> np.ndarray:
        """States of one direction; ``gates`` and the result are by step, window."""
        steps, m, _ = gates.shape
        h = np.zeros((m, HIDDEN), np.float32)
        out = np.empty((steps, m, HIDDEN), np.float32)
        rec_zr, rec_n = np.ascontiguousarray(rec[:, : 2 * HIDDEN]), np.ascontiguousarray(rec[:, 2 * HIDDEN :])
        for t in range(steps):
            zr = _sigmoid(gates[t, :, : 2 * HIDDEN] + h @ rec_zr)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            u = h @ rec_n
            n = np.tanh(gates[t, :, 2 * HIDDEN :] + r * u)
            new = n + z * (h - n)
            if mask is not None:
                new = np.where(mask[t][:, None], new, h)
            if keep is not None:
                keep.append((h, z, r, u, n))
            out[t] = h = new
        return out

    def forward(
        self, gates_f: np.ndarray, gates_b: np.ndarray, mask: np.ndarray | None, tape: dict | None = None
    ) -> np.ndarray:
        """Logit of every window; gates are by step, window, gate; the mask by step, window."""
        p = self.p
        kept_f: list | None = [] if tape is not None else None
        kept_b: list | None = [] if tape is not None else None
        back = None if mask is None else mask[::-1]
        states = np.concatenate(
            [
                self._layer(gates_f, mask, p["rec_f"], kept_f),
                self._layer(gates_b[::-1], back, p["rec_b"], kept_b)[::-1],
            ],
            axis=2,
        )
        hidden = np.tanh(states @ p["att"])
        energy = hidden @ p["att_v"]
        if mask is not None:
            energy = np.where(mask, energy, np.float32(-1e9))
        weight = np.exp(energy - energy.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tm,tmh->mh", weight, states)
        if tape is not None:
            tape.update(f=kept_f, b=kept_b, states=states, hidden=hidden, weight=weight, pooled=pooled, mask=mask)
        return pooled @ p["out"] + p["out_b"][0]

    def _layer_gradient(self, kept: list, mask: np.ndarray | None, rec: np.ndarray, d_out: np.ndarray):
        steps, m, _ = d_out.shape
        d_gates = np.empty((steps, m, 3 * HIDDEN), np.float32)
        d_rec = np.zeros_like(rec)
        dh = np.zeros((m, HIDDEN), np.float32)
        rec_zr, rec_n = rec[:, : 2 * HIDDEN], rec[:, 2 * HIDDEN :]
        for t in range(steps - 1, -1, -1):
            h, z, r, u, n = kept[t]
            d = dh + d_out[t]
            through = d if mask is None else np.where(mask[t][:, None], d, 0)
            dn = through * (1 - z) * (1 - n * n)
            dz = through * (h - n) * z * (1 - z)
            dr = dn * u * r * (1 - r)
            du = dn * r
            dzr = np.concatenate([dz, dr], axis=1)
            d_gates[t, :, : 2 * HIDDEN], d_gates[t, :, 2 * HIDDEN :] = dzr, dn
            d_rec[:, : 2 * HIDDEN] += h.T @ dzr
            d_rec[:, 2 * HIDDEN :] += h.T @ du
            dh = through * z + dzr @ rec_zr.T + du @ rec_n.T
            if mask is not None:
                dh += np.where(mask[t][:, None], 0, d)
        return d_gates, d_rec

    def gradients(self, d_logit: np.ndarray, tape: dict) -> tuple[dict, np.ndarray, np.ndarray]:
        """Gradients of the parameters above the inputs, and of both directions' gates."""
        p, g = self.p, {}
        states, weight, hidden, mask = tape["states"], tape["weight"], tape["hidden"], tape["mask"]
        g["out"], g["out_b"] = tape["pooled"].T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * p["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("tmh,mh->tm", states, d_pooled)
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["att_v"] = np.einsum("tma,tm->a", hidden, d_energy)
        d_hidden = d_energy[:, :, None] * p["att_v"] * (1 - hidden * hidden)
        g["att"] = np.einsum("tmh,tma->ha", states, d_hidden)
        d_states += d_hidden @ p["att"].T
        back = None if mask is None else mask[::-1]
        d_f, g["rec_f"] = self._layer_gradient(tape["f"], mask, p["rec_f"], d_states[:, :, :HIDDEN])
        d_b, g["rec_b"] = self._layer_gradient(tape["b"], back, p["rec_b"], d_states[::-1, :, HIDDEN:])
        return g, d_f, d_b[::-1]


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float = LEARNING_RATE) -> None:
        self.rate, self.step = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, params: dict[str, np.ndarray], gradients: dict[str, tuple | np.ndarray]) -> None:
        """A gradient is an array, or places in the flat parameter and the gradient there."""
        self.step += 1
        rate = self.rate * np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
        for k, g in gradients.items():
            at, g = g if isinstance(g, tuple) else (slice(None), g.ravel())
            first, second, value = (x[k].reshape(-1) for x in (self.m, self.v, params))  # views
            m = 0.9 * first[at] + 0.1 * g
            v = 0.99 * second[at] + 0.01 * g * g
            first[at], second[at] = m, v
            value[at] -= (rate * m / (np.sqrt(v) + 1e-7)).astype(np.float32)


def summed(places: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and the sum of the values at each."""
    distinct, at = np.unique(places, return_inverse=True)
    return distinct, np.bincount(at, values, len(distinct)).astype(np.float32)


def windows_of(counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid end to end: each window's first word, its length, its text."""
    count = np.array(counts, np.int64)
    ends = np.cumsum(count)
    owner = np.repeat(np.arange(len(count), dtype=np.int32), count)
    first = np.arange(len(owner)) + WINDOW <= ends[owner]
    short = (count > 0) & (count < WINDOW)
    first[(ends - count)[short]] = True
    starts = np.flatnonzero(first)
    owners = owner[starts]
    return starts, np.minimum(count, WINDOW).astype(np.int32)[owners], owners


class Scorer:
    """Scores whole texts; remembers the gates of words it has seen."""

    def __init__(self, network: Network) -> None:
        self.network = network
        p = network.p
        # Sigmoids and tanhs are both had from one exponential, so the inputs of
        # the first are kept negated, those of the second doubled.
        self.scale = np.repeat(np.array([-1, -1, 2], np.float32), HIDDEN)
        self.rec = [np.ascontiguousarray((p[f"rec_{d}"] * self.scale).T) for d in "fb"]
        self.att = [np.ascontiguousarray(2 * p["att"][i * HIDDEN : (i + 1) * HIDDEN].T) for i in (0, 1)]
        self._reset()

    def _reset(self) -> None:
        self.row: dict[bytes, int] = {}
        self.gates = np.zeros((1, 2, 3 * HIDDEN), np.float32)  # row 0 stands after a text

    def _rows(self, words: list[bytes]) -> np.ndarray:
        row = self.row
        fresh = list({w for w in words if w not in row})
        if len(self.gates) + len(fresh) > CACHE_WORDS and row:
            self._reset()
            row, fresh = self.row, list(set(words))
        if fresh:
            base = len(self.gates)
            made = [self.gates]
            for i in range(0, len(fresh), 20_000):
                made.append(np.stack(self.network.projections(self.network.inputs_of(fresh[i : i + 20_000])), axis=1))
            self.gates = np.concatenate(made)
            row.update(zip(fresh, range(base, base + len(fresh))))
        return np.fromiter(map(row.__getitem__, words), np.int64, len(words))

    def _states(self, gates: np.ndarray, rec: np.ndarray, steps: range) -> np.ndarray:
        """States by step, dimension, window; window ``i`` reads the words from ``i`` on."""
        m = gates.shape[1] - WINDOW + 1
        out = np.empty((WINDOW, HIDDEN, m), np.float32)
        h = None
        for t in steps:
            x = gates[:, t : t + m]
            if h is None:  # the state before the first word is zero
                zr, n = x[: 2 * HIDDEN].copy(), x[2 * HIDDEN :].copy()
                _one_over_one_plus_exp(zr)
            else:
                u = rec @ h
                zr, n = u[: 2 * HIDDEN], u[2 * HIDDEN :]
                zr += x[: 2 * HIDDEN]
                _one_over_one_plus_exp(zr)
                n *= zr[HIDDEN:]
                n += x[2 * HIDDEN :]
            _one_over_one_plus_exp(n)
            n *= -2
            n += 1
            np.subtract(0 if h is None else h, n, out=out[t])
            out[t] *= zr[:HIDDEN]
            out[t] += n
            h = out[t]
        return out

    def _every_start(self, gates: np.ndarray) -> np.ndarray:
        """Logits of the windows that begin at each word; gates by direction, gate, word."""
        p = self.network.p
        with np.errstate(over="ignore"):  # one over infinity is the zero wanted
            f = self._states(gates[0], self.rec[0], range(WINDOW))
            b = self._states(gates[1], self.rec[1], range(WINDOW - 1, -1, -1))
            hidden = self.att[0] @ f
            hidden += self.att[1] @ b
            _one_over_one_plus_exp(hidden)
        weight = np.matmul(-2 * p["att_v"], hidden)  # up to a constant
        weight -= weight.max(axis=0)
        np.exp(weight, out=weight)
        value = np.matmul(p["out"][:HIDDEN], f) + np.matmul(p["out"][HIDDEN:], b)
        return (weight * value).sum(axis=0) / weight.sum(axis=0) + p["out_b"][0]

    def window_logits(self, rows: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Logit of each window of texts laid end to end, as :func:`windows_of` lists them."""
        padded = np.concatenate([rows, np.zeros(WINDOW - 1, np.int64)])
        every = np.empty(len(rows), np.float32)
        for i in range(0, len(rows), SCORE_WINDOWS):
            part = self.gates[padded[i : i + SCORE_WINDOWS + WINDOW - 1]] * self.scale
            every[i : i + SCORE_WINDOWS] = self._every_start(np.ascontiguousarray(part.transpose(1, 2, 0)))
        short = np.flatnonzero(sizes < WINDOW)
        for i in range(0, len(short), SCORE_WINDOWS):
            own = short[i : i + SCORE_WINDOWS]
            mask = np.arange(WINDOW)[:, None] < sizes[own]
            both = self.gates[np.where(mask, padded[starts[own] + np.arange(WINDOW)[:, None]], 0)]
            every[starts[own]] = self.network.forward(both[:, :, 0], both[:, :, 1], mask)
        return every[starts]

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        """Largest window score of each text."""
        split = [words_of(t) for t in texts]
        rows = self._rows([w for words in split for w in words])
        starts, sizes, owners = windows_of([len(w) for w in split])
        scores = np.zeros(len(texts))
        if len(starts):
            own, first = np.unique(owners, return_index=True)
            worst = np.maximum.reduceat(self.window_logits(rows, starts, sizes), first)
            scores[own] = _sigmoid(worst.astype(np.float64))
        return scores


def _log_odds(buckets: np.ndarray, begins: np.ndarray, holders: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Of each n-gram bucket: how much oftener toxic texts hold it than clean ones.

    Zero for buckets that fewer than ``SUPPORT`` toxic texts hold.
    """
    counts = np.diff(np.append(begins, len(buckets)))
    seen = np.zeros((2, CHAR_BUCKETS))
    for own, label in zip(holders, toxic):
        spans = counts[own]
        at = np.repeat(begins[own] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
        seen[int(label), np.unique(buckets[at])] += 1
    total = np.bincount(toxic.astype(int), minlength=2)
    odds = np.log((seen[1] + 0.3) / (total[1] + 1)) - np.log((seen[0] + 0.3) / (total[0] + 1))
    return np.where(seen[1] >= min(SUPPORT, 1 + total[1] // 10), np.maximum(odds, 0), 0)


def train(texts: list[bytes], labels: list[int], seed: int = SEED) -> Network | None:
    """Fit the network; ``None`` unless both labels are there."""
    split = [words_of(t) for t in texts]
    kept = [i for i, words in enumerate(split) if words]
    toxic = np.array([labels[i] for i in kept], bool)
    if not kept or toxic.all() or not toxic.any():
        return None
    split = [split[i] for i in kept]
    table: dict[bytes, int] = {}
    flat = np.fromiter((table.setdefault(w, len(table)) for words in split for w in words), np.int64)
    words = list(table)
    counts = [len(w) for w in split]
    starts, sizes, owners = windows_of(counts)
    ends = np.cumsum(counts)
    holders = [np.unique(flat[e - n : e]) for e, n in zip(ends, counts)]
    del split  # the texts' words are in ``flat`` by number from here on
    word_bucket, gram_bucket, gram_begin = grams_in_parts(words)
    gram_count = np.diff(np.append(gram_begin, len(gram_bucket)))
    odds = _log_odds(gram_bucket, gram_begin, holders, toxic)
    word_odds = np.maximum.reduceat(odds[gram_bucket], gram_begin)
    padded = np.concatenate([flat, np.zeros(WINDOW, np.int64)])
    rating = np.full(len(starts), -np.inf)
    for k in range(WINDOW):
        np.maximum(rating, word_odds[padded[starts + k]], out=rating, where=k < sizes)
    own_first = np.append(np.unique(owners, return_index=True)[1], len(owners))

    r = np.random.default_rng(seed)
    network = Network(seed)
    network.p["char"][:, 0] = odds / 3  # a first guess, learned on from there
    adam = Adam(network.p)

    def pick(rating: np.ndarray, surely: float, worst: int, others: int) -> np.ndarray:
        """The worst windows of every text, and some others of clean texts.

        Of a toxic text the worst one, and the next ones if they are surely toxic.
        """
        chosen = []
        for text, (begin, stop) in enumerate(zip(own_first, own_first[1:])):
            # Windows that share the worst word are rated alike; any of them may be taken.
            own = rating[begin:stop] + 1e-3 * r.random(stop - begin)
            for k in range(worst):
                at = int(own.argmax())
                if k and (own[at] == -np.inf or toxic[text] and own[at] <= surely):
                    break
                chosen.append(begin + at)
                near = NEAR[int(toxic[text])]  # a marked word is learned in several places of a window
                own[max(0, at - near + 1) : at + near] = -np.inf
        clean = np.flatnonzero(~toxic[owners])
        return np.concatenate([chosen, r.choice(clean, min(others, len(clean)), replace=False)])

    def learn(chosen: np.ndarray) -> None:
        y = toxic[owners[chosen]].astype(np.float32)
        for batch in np.array_split(r.permutation(len(chosen)), max(1, len(chosen) // BATCH)):
            own = chosen[batch]
            steps = np.arange(WINDOW)[:, None]
            use, position = np.unique(padded[starts[own] + steps], return_inverse=True)
            position = position.reshape(WINDOW, len(own))
            mask = steps < sizes[own]
            spans = gram_count[use]
            first = np.cumsum(spans) - spans
            grams = gram_bucket[np.repeat(gram_begin[use] - first, spans) + np.arange(spans.sum())]
            each = network.p["char"][grams]
            chars = np.maximum.reduceat(each, first, axis=0)
            x = np.concatenate([network.p["word"][word_bucket[use]], chars], axis=1)
            gates_f, gates_b = network.projections(x)
            tape: dict = {}
            logit = network.forward(gates_f[position], gates_b[position], mask, tape)
            d_logit = ((_sigmoid(logit) - y[batch]) / len(own)).astype(np.float32)
            g, d_f, d_b = network.gradients(d_logit, tape)
            dx = np.zeros_like(x)
            for d, name in ((d_f, "f"), (d_b, "b")):
                of_word = np.zeros((len(use), 3 * HIDDEN), np.float32)
                np.add.at(of_word, position.ravel(), d.reshape(-1, 3 * HIDDEN))
                g[f"in_{name}"], g[f"bias_{name}"] = x.T @ of_word, of_word.sum(axis=0)
                dx += of_word @ network.p[f"in_{name}"].T
            gram, dim = np.nonzero(np.repeat(chars, spans, axis=0) == each)  # those that were largest
            of_gram = np.repeat(np.arange(len(use)), spans)[gram]
            g["char"] = summed(grams[gram] * CHAR_DIMS + dim, dx[of_gram, WORD_DIMS + dim])
            places = word_bucket[use][:, None] * WORD_DIMS + np.arange(WORD_DIMS)
            g["word"] = summed(places.ravel(), dx[:, :WORD_DIMS].ravel())
            adam.update(network.p, g)

    surely = 0.6 * float(word_odds.max(initial=0.0))
    for round_, epochs in enumerate(EPOCHS):
        if round_:
            surely = 0.0
            adam.rate *= DECAY
            scorer = Scorer(network)
            rating = scorer.window_logits(scorer._rows(words)[flat], starts, sizes)
        rounds = epochs * max(1, 1500 // len(kept))  # small samples are read oftener
        for _ in range(rounds):
            learn(pick(rating, surely, WORST, OTHERS * len(kept)))
    return network


def in_fold(fold: int, folds: int = 3):
    """Whether crc32 of the id as text leaves ``fold`` modulo ``folds`` (a null id: no)."""
    rest = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % folds
    return F.coalesce(rest == fold, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Train on a bounded sample of the labelled rows outside the held-out fold.

    Rows of each label are kept by a hash of their id below a threshold that
    leaves about ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` of them, one text an id,
    and of these, in the order of another hash, as many as ``SAMPLE_BYTES`` lets
    in.  Only the sample's ids and texts are joined and collected.
    """
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~in_fold(1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bound = {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN}
    limit = {k: max(1, int(_HASH_RANGE * min(1.0, bound[k] / n))) for k, n in totals.items()}
    if len(limit) < 2:
        return None
    below = F.pmod(F.xxhash64("doc_id"), F.lit(_HASH_RANGE)) < F.when(F.col("toxic") == 1, limit[1]).otherwise(limit[0])
    chosen = known.where(below)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        F.octet_length("text") <= SAMPLE_TEXT_BYTES
    )
    # The sample's size is bounded above, so it can go to every task.
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    size = F.sum(F.octet_length("text")).over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id"))
    room = F.when(F.col("toxic") == 1, SAMPLE_BYTES[1]).otherwise(SAMPLE_BYTES[0])
    rows = sample.withColumn("size", size).where(F.col("size") <= room).select("doc_id", "text", "toxic").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"].encode() for r in rows], [r["toxic"] for r in rows])


def score_column(docs: DataFrame, network: Network | None, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of its ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(network)  # a fixed number of parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            texts = binary_column(batch, "text")
            scores = np.zeros(len(texts))
            if shared.value is not None:
                scorer = scorer or Scorer(shared.value)
                for begin, stop in text_blocks(texts, 1 << 20):
                    scores[begin:stop] = scorer.score(texts[begin:stop])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores)], names=[*batch.schema.names, name]
            )

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    network = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), in_fold(1).alias("held_out"), "text")
    return score_column(rows, network).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
