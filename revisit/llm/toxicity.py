"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A token is a lower-case word; its input joins a word part (a hashed embedding) and a character part (the mean of
hashed embeddings of its trigrams and its first and last five characters, and the highest log-odds of one of them). Two gated recurrent passes, one in each direction, read a
window of words; attention pools their states into a logit. All overlapping windows of a text are scored, and
the text's logit is the highest, scaled to a probability. A passage of up to window - step + 1 words lies whole in some window.

Training: on the driver, on a bounded sample, at most `max_docs` labelled texts of each class (those with the
smallest hash of doc_id) of at most `max_chars` characters. The first word dimension starts as the word's smoothed
log-odds in the sample; those of character runs stay as they are. In each step all windows of some texts are read, and the highest few of each text are learned.

Scoring covers whole texts of any length. Null texts are empty; an empty text is one empty window. Several
labels of one document count by their mean, null ones don't count; without labels of both kinds the score is
constant. Repeated rows are scored each on their own. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisit.llm.common import col, least_hashed


@dataclass(frozen=True)
class Shape:
    """The network's sizes, the window and its step (in words), and the training."""

    words: int = 1 << 14
    grams: int = 1 << 15
    word_size: int = 8
    gram_size: int = 8
    hidden: int = 12
    attention: int = 8
    window: int = 32
    step: int = 16
    max_docs: int = 1200
    max_chars: int = 20_000
    epochs: int = 6
    texts_a_step: int = 16
    learned_windows: int = 3
    rate: float = 0.01
    seed: int = 11


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


_buckets: dict[int, dict[str, int]] = {}


def codes(word: str, s: Shape) -> tuple[int, list[int]]:
    """The bucket of a token's word and those of its character trigrams and of its first and last five characters, ends marked."""
    word = word.strip(_EDGES)
    data = f"<{word}>"
    runs = [data[i : i + 3] for i in range(max(1, len(data) - 2))] + [data[:5], data[-5:]]
    known = _buckets.setdefault(s.grams, {})
    found = list(map(known.get, runs))
    if None in found:
        if len(known) > 200_000:
            known.clear()
        found = [known.setdefault(x, zlib.crc32(x.encode()) % s.grams) for x in runs]
    return zlib.crc32(word.encode()) % s.words, found


class Network:
    def __init__(self, s: Shape):
        rng = np.random.default_rng(s.seed)
        d, h = s.word_size + s.gram_size, s.hidden
        init = lambda *n: (rng.standard_normal(n) / np.sqrt(n[0])).astype(np.float32)
        self.shape, self.scale = s, (1.0, 0.0)
        self.p = {"word": (0.1 * rng.standard_normal((s.words, s.word_size))).astype(np.float32), "gram": (0.1 * rng.standard_normal((s.grams, s.gram_size - 1))).astype(np.float32)}
        self.odds = np.zeros(s.grams, np.float32)
        for way in ("f", "b"):
            self.p |= {f"x{way}": init(d, 3 * h), f"h{way}": init(h, 3 * h), f"c{way}": np.zeros(3 * h, np.float32)}
        self.p |= {"u": init(2 * h, s.attention), "v": init(s.attention), "o": init(2 * h), "k": np.zeros(1, np.float32)}

    # ---------------------------------------------------------- inputs

    def inputs(self, word: np.ndarray, grams: list[list[int]]) -> np.ndarray:
        counts = np.fromiter(map(len, grams), np.int64, len(grams))
        flat = np.fromiter(chain.from_iterable(grams), np.int64, counts.sum())
        first = np.cumsum(counts) - counts
        sums = np.add.reduceat(self.p["gram"][flat], first, axis=0)
        odds = np.maximum.reduceat(self.odds[flat], first)[:, None]
        return np.concatenate([self.p["word"][word], odds, sums / counts[:, None].astype(np.float32)], axis=1)

    # ---------------------------------------------------------- passes

    def _pass(self, gx: np.ndarray, mask: np.ndarray, way: str, keep: list | None) -> np.ndarray:
        """States (window, place, hidden) from input gates (window, place, 3 hidden)."""
        n, t, k = gx.shape
        h = k // 3
        weight, state = self.p[f"h{way}"], np.zeros((n, h), np.float32)
        out = np.empty((n, t, h), np.float32)
        for i in range(t) if way == "f" else reversed(range(t)):
            gh, g, m = state @ weight, gx[:, i], mask[:, i, None]
            zr = _sigmoid(g[:, : 2 * h] + gh[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(g[:, 2 * h :] + r * gh[:, 2 * h :])
            if keep is not None:
                keep.append((i, state, z, r, new, gh[:, 2 * h :], m))
            state = state + m * ((1 - z) * (new - state))
            out[:, i] = state
        return out

    def _pool(self, states: np.ndarray, mask: np.ndarray) -> tuple:
        a = np.tanh(states @ self.p["u"])
        e = np.where(mask > 0, a @ self.p["v"], -1e9)
        e = np.exp(e - e.max(1, keepdims=True)) * mask
        alpha = e / np.maximum(e.sum(1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nth->nh", alpha, states)
        return a, alpha, pooled, pooled @ self.p["o"] + self.p["k"][0]

    def logits(self, gates_f: np.ndarray, gates_b: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._pass(gates_f, mask, "f", None), self._pass(gates_b, mask, "b", None)], axis=2)
        return self._pool(states, mask)[-1]

    def gates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x @ self.p["xf"] + self.p["cf"], x @ self.p["xb"] + self.p["cb"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict, np.ndarray]:
        """Of the mean logistic loss over windows; and by input."""
        p, h, grads = self.p, self.shape.hidden, {}
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._pass(g, mask, w, kept[w]) for w, g in zip("fb", self.gates(x))], axis=2)
        a, alpha, pooled, logit = self._pool(states, mask)
        d = ((_sigmoid(logit) - y) / len(y)).astype(np.float32)
        grads["o"], grads["k"] = pooled.T @ d, np.array([d.sum()], np.float32)
        d_pooled = d[:, None] * p["o"]
        d_states = alpha[:, :, None] * d_pooled[:, None, :]
        d_alpha = np.einsum("nth,nh->nt", states, d_pooled)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(1, keepdims=True))
        grads["v"] = np.einsum("nta,nt->a", a, d_e)
        d_a = d_e[:, :, None] * p["v"] * (1 - a * a)
        grads["u"] = np.einsum("nth,nta->ha", states, d_a)
        d_states = d_states + d_a @ p["u"].T
        d_x = np.zeros_like(x)
        for j, way in enumerate("fb"):
            weight, d_weight = p[f"h{way}"], np.zeros_like(p[f"h{way}"])
            d_gx, carry = np.zeros((*x.shape[:2], 3 * h), np.float32), np.zeros((len(x), h), np.float32)
            for i, before, z, r, new, gh_n, m in reversed(kept[way]):
                d_h = d_states[:, i, j * h : (j + 1) * h] + carry
                d_step = m * d_h
                d_new, d_z = d_step * (1 - z), d_step * (before - new)
                d_n = d_new * (1 - new * new)
                d_r = d_n * gh_n
                d_zr = np.concatenate([d_z * z * (1 - z), d_r * r * (1 - r)], axis=1)
                d_gx[:, i, : 2 * h], d_gx[:, i, 2 * h :] = d_zr, d_n
                d_gh = np.concatenate([d_zr, d_n * r], axis=1)
                d_weight += before.T @ d_gh
                carry = d_gh @ weight.T + d_step * z + (1 - m) * d_h
            grads[f"h{way}"], grads[f"c{way}"] = d_weight, d_gx.sum((0, 1))
            flat = d_gx.reshape(-1, 3 * h)
            grads[f"x{way}"] = x.reshape(len(flat), -1).T @ flat
            d_x += d_gx @ p[f"x{way}"].T
        return grads, d_x


def windows(n: int, s: Shape) -> np.ndarray:
    """Where the overlapping windows of a text of n tokens begin; they cover it, and there is one at least."""
    return np.arange(0, max(1, n - s.window + s.step), s.step)


def _layout(lengths: np.ndarray, s: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token places (window, place), mask and text of the windows of texts laid end to end."""
    starts = [windows(n, s) for n in lengths.tolist()]
    owner = np.repeat(np.arange(len(lengths)), [len(x) for x in starts])
    first = np.concatenate(starts) if starts else np.empty(0, np.int64)
    at = first[:, None] + np.arange(s.window)
    mask = at < lengths[owner][:, None]
    return np.where(mask, at + (np.cumsum(lengths) - lengths)[owner][:, None], -1), mask.astype(np.float32), owner


def train(texts: list[str], labels: np.ndarray, s: Shape = Shape()) -> Network:
    net, rng = Network(s), np.random.default_rng(s.seed)
    if not len(labels) or labels.min() == labels.max():
        net.scale = (0.0, 0.0 if not len(labels) else (4.0 if labels[0] else -4.0))
        return net
    table: dict[str, int] = {}
    ids = [np.array([table.setdefault(w, len(table)) for w in tokens(t)], np.int64) for t in texts]
    word, grams = zip(*(codes(w, s) for w in table)) if table else ((0,), ([0],))
    word, grams = np.array(word), list(grams)
    gram_of = np.concatenate([np.asarray(g) for g in grams])
    gram_n = np.array([len(g) for g in grams])
    gram_at = np.cumsum(gram_n) - gram_n

    def spots(used: np.ndarray) -> np.ndarray:
        """Where the grams of some words lie in gram_of."""
        n = gram_n[used]
        return np.repeat(gram_at[used] - (np.cumsum(n) - n), n) + np.arange(n.sum())

    seen, seen_grams = np.zeros((2, s.words)), np.zeros((2, s.grams))
    for some, y in zip(ids, labels):
        some = np.unique(some)
        np.add.at(seen[int(y)], np.unique(word[some]), 1)
        np.add.at(seen_grams[int(y)], np.unique(gram_of[spots(some)]), 1)
    totals = np.maximum(np.bincount(labels.astype(int), minlength=2), 1)

    def log_odds(counts: np.ndarray) -> np.ndarray:
        odds = np.log((counts[1] + 1) / (totals[1] + 2)) - np.log((counts[0] + 1) / (totals[0] + 2))
        # A bucket seen in few texts says little.
        return (np.clip(odds, -4, 4) * np.minimum(1, counts.sum(0) / 5)).astype(np.float32)

    net.p["word"][:, 0], net.odds = log_odds(seen), log_odds(seen_grams)
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    t = 0
    for epoch in range(s.epochs):
        for lo in range(0, len(ids), s.texts_a_step):
            if lo == 0:
                order = rng.permutation(len(ids))
            pick = order[lo : lo + s.texts_a_step]
            lengths = np.array([len(ids[i]) for i in pick])
            flat = np.concatenate([ids[i] for i in pick])
            at, mask, owner = _layout(lengths, s)
            used, back = np.unique(flat, return_inverse=True)
            x = np.zeros((len(used) + 1, s.word_size + s.gram_size), np.float32)
            if len(used):
                x[:-1] = net.inputs(word[used], [grams[i] for i in used])
            token = np.where(at >= 0, back[at] if len(back) else 0, len(used))
            logit = net.logits(*(g[token] for g in net.gates(x)), mask)
            ranked = np.lexsort((-logit, owner))
            place = np.arange(len(ranked)) - np.searchsorted(owner[ranked], owner[ranked])
            top = ranked[place < s.learned_windows]
            y = labels[pick][owner[top]]
            # Of a text that is marked only the highest window must be; of another, none may be.
            top, y = top[(y == 0) | (place[place < s.learned_windows] == 0)], y[(y == 0) | (place[place < s.learned_windows] == 0)]
            grads, d_x = net.gradients(x[token[top]], mask[top], y.astype(np.float32))
            by_word = np.zeros_like(x)
            np.add.at(by_word, token[top].reshape(-1), d_x.reshape(-1, x.shape[1]))
            grads["word"], grads["gram"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["gram"])
            if len(used):
                np.add.at(grads["word"], word[used], by_word[:-1, : s.word_size])
                per = by_word[:-1, s.word_size + 1 :] / gram_n[used][:, None].astype(np.float32)
                np.add.at(grads["gram"], gram_of[spots(used)], np.repeat(per, gram_n[used], axis=0))
            t += 1
            for k, g in grads.items():
                m, v = state[k]
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                net.p[k] -= (s.rate * (1 - epoch / s.epochs) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    scorer = Scorer(net)
    raw = scorer.raw(texts)
    # Probabilities by a logistic fit of the highest logits, which leans to the middle on small samples.
    a, b = 1.0, 0.0
    target = np.where(labels > 0, (totals[1] + 1) / (totals[1] + 2), 1 / (totals[0] + 2))
    for _ in range(50):
        q = _sigmoid(a * raw + b)
        w, e = np.maximum(q * (1 - q), 1e-6), q - target
        hess = np.array([[(w * raw * raw).sum(), (w * raw).sum()], [(w * raw).sum(), w.sum()]]) + 1e-3 * np.eye(2)
        da, db = np.linalg.solve(hess, [(e * raw).sum(), e.sum()])
        a, b = a - float(np.clip(da, -1, 1)), b - float(np.clip(db, -2, 2))
    net.scale = (max(a, 0.05), b)
    return net


class Scorer:
    """Scores texts; keeps the input gates of words it has met, up to a bound."""

    def __init__(self, net: Network, most: int = 300_000):
        self.net, self.most = net, most
        self.known: dict[str, int] = {}
        # Input gates of the forward and the backward pass.
        self.tables = [np.zeros((1024, 3 * net.shape.hidden), np.float32) for _ in "fb"]
        self._forget()

    def _forget(self) -> None:
        self.known.clear()
        empty = np.zeros((1, self.net.shape.word_size + self.net.shape.gram_size), np.float32)
        for table, gates in zip(self.tables, self.net.gates(empty)):
            table[0] = gates[0]

    def _rows(self, some: list[list[str]]) -> list[np.ndarray]:
        new: dict[str, None] = {}
        for words in some:
            if None in (found := list(map(self.known.get, words))):
                new.update((w, None) for w, f in zip(words, found) if f is None)
        if len(self.known) + len(new) + 1 > self.most:
            self._forget()
            new = dict.fromkeys(w for words in some for w in words)
        if new:
            first = len(self.known) + 1
            if first + len(new) > len(self.tables[0]):
                size = max(2 * len(self.tables[0]), first + len(new))
                self.tables = [np.concatenate([t, np.zeros((size - len(t), t.shape[1]), np.float32)]) for t in self.tables]
            names = list(new)
            for lo in range(0, len(names), 8192):
                word, grams = zip(*(codes(w, self.net.shape) for w in names[lo : lo + 8192]))
                x = self.net.inputs(np.array(word), list(grams))
                for table, gates in zip(self.tables, self.net.gates(x)):
                    table[first + lo : first + lo + len(word)] = gates
            self.known.update(zip(names, range(first, first + len(names))))
        return [np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)) for words in some]

    def _logits(self, token: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """What Network.logits gives, place by place, so that each step reads one stretch of memory."""
        h, p, (n, t) = self.net.shape.hidden, self.net.p, token.shape
        token, mask = np.ascontiguousarray(token.T), np.ascontiguousarray(mask.T)
        states = np.empty((t, n, 2 * h), np.float32)
        with np.errstate(over="ignore"):
            for way, table in enumerate(self.tables):
                weight, state = p["hfhb"[2 * way : 2 * way + 2]], np.zeros((n, h), np.float32)
                for i in range(t) if way == 0 else reversed(range(t)):
                    g, gh = table[token[i]], state @ weight
                    zr = g[:, : 2 * h] + gh[:, : 2 * h]
                    np.exp(np.negative(zr, out=zr), out=zr)
                    zr += 1
                    np.reciprocal(zr, out=zr)
                    new = gh[:, 2 * h :] * zr[:, h:]
                    new += g[:, 2 * h :]
                    np.tanh(new, out=new)
                    new -= state
                    new *= 1 - zr[:, :h]
                    new *= mask[i][:, None]
                    state = state + new
                    states[i, :, way * h : (way + 1) * h] = state
        e = np.where(mask > 0, np.tanh(states @ p["u"]) @ p["v"], -1e9)
        e = np.exp(e - e.max(0)) * mask
        alpha = e / np.maximum(e.sum(0), 1e-9)
        # The pooled state meets only the output weights.
        return (alpha * (states @ p["o"])).sum(0) + p["k"][0]

    def raw(self, texts: list[str | None]) -> np.ndarray:
        """The highest window's logit of each text."""
        s, out = self.net.shape, np.full(len(texts), -np.inf, np.float32)
        lo = 0
        while lo < len(texts):
            some, n = [], 0
            while lo + len(some) < len(texts) and n < 30_000:
                some.append(tokens(texts[lo + len(some)]))
                n += len(some[-1])
            rows = self._rows(some)
            flat = np.concatenate(rows)
            at, mask, owner = _layout(np.array([len(r) for r in rows]), s)
            token = np.where(at >= 0, flat[at], 0) if len(flat) else np.zeros(at.shape, np.int64)
            for a in range(0, len(token), 1024):
                np.maximum.at(out, lo + owner[a : a + 1024], self._logits(token[a : a + 1024], mask[a : a + 1024]))
            lo += len(some)
        return out

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        a, b = self.net.scale
        return _sigmoid(a * self.raw(texts).astype(np.float64) + b)


def training_texts(docs: DataFrame, labels: DataFrame, s: Shape) -> tuple[list[str], np.ndarray]:
    """The bounded sample. docs: doc_id, text; labels: doc_id, label (0 to 1).

    Ids are chosen from the labels alone, max_docs a class; then their texts are read, one of an id that is
    repeated, and come to the driver unless they have more than max_chars. No other text moves.
    """
    one = labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.avg("label").alias("label"))
    chosen = {i: (y, h) for y in (0, 1) for h, i in least_hashed(one.filter((F.col("label") >= 0.5) == F.lit(bool(y))), "doc_id", s.max_docs)}
    ids = docs.sparkSession.createDataFrame([(i,) for i in chosen], T.StructType([labels.schema["doc_id"]]))
    some = docs.filter(F.length("text") <= s.max_chars).join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    found = sorted((*chosen[r["doc_id"]], r["doc_id"], r["text"]) for r in some.collect())
    return [text for *_, text in found], np.array([y for y, *_ in found], float)


_scorers: dict[int, Scorer] = {}


def scored(docs: DataFrame, net: Network, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if id(shared.value) not in _scorers:
            _scorers.clear()
            _scorers[id(shared.value)] = Scorer(shared.value)
        scorer = _scorers[id(shared.value)]
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scorer(part.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    return docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text")).mapInArrow(run, "doc_id long, score double")
