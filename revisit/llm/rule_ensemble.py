"""A sparse ensemble of rules over text statistics, compiled into a Spark column.

Statistics are Spark columns. On a bounded sample of labelled rows, the driver boosts shallow trees with
numpy; each path from a root to a node is a rule, a conjunction of comparisons. A lasso logistic regression
picks few rules and their weights, and the score is a column expression of them: one pass, no Python.

The sample is the `max_rows` labelled rows with the smallest hash of doc_id, which is independent of size and
order. Null texts are empty; all statistics of an empty text are 0, and it is scored by them. Several labels
of one document count by their mean; null ones don't count. Without labels of both kinds, scores are constant.
Repeated rows are scored each on their own. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisit.llm.common import SPACES, WORD_GAP, character_counts, col, fresh, least_hashed, let

Rule = tuple[tuple[int, bool, float], ...]  # (feature, whether at most, threshold), sorted
FEATURES = (
    "n_words", "n_chars", "word_length", "lower", "accented", "upper", "digits", "symbols", "marks", "spaces", "dup_lines", "line_words", "distinct_words",
)


@dataclass(frozen=True)
class Training:
    max_rows: int = 20_000
    trees: int = 60
    depth: int = 3
    bins: int = 32
    sample: float = 0.5
    rate: float = 0.15
    min_leaf: float = 0.005
    lasso: float = 0.0008
    steps: int = 600
    seed: int = 7


def statistics(docs: DataFrame, text: str = "text", into: str = "features") -> DataFrame:
    """The documents with an array column of FEATURES."""
    whole, trimmed, words = fresh(docs, "_text", "_trimmed", "_words")
    out = docs.withColumn(whole, F.coalesce(col(text), F.lit("")))
    out, counts, without = character_counts(out, whole)
    out = out.withColumn(trimmed, F.btrim(col(whole), F.lit(SPACES)))
    out = out.withColumn(words, F.when(col(trimmed) == "", F.array().cast("array<string>")).otherwise(F.split(col(trimmed), WORD_GAP, -1)))
    n, chars = F.size(col(words)), F.length(col(whole))
    lines = F.filter(F.split(col(whole), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    per_line = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0)).cast("double")
    values = {
        "n_words": n.cast("double"),
        "n_chars": chars.cast("double"),
        "word_length": share(chars - counts["space"], n),
        "lower": share(counts["plain_lower"], chars),
        "accented": share(counts["other_lower"], chars),
        "upper": share(counts["upper"], chars),
        "digits": share(counts["digit"], chars),
        "symbols": share(counts["symbol"], chars),
        "marks": share(counts["other"], chars),
        "spaces": share(counts["space"], chars),
        "dup_lines": let(per_line, lambda x: share(x["n"] - x["distinct"], x["n"])),
        "line_words": let(per_line, lambda x: share(n, x["n"])),
        "distinct_words": share(F.size(F.array_distinct(col(words))), n),
    }
    return out.withColumn(into, F.array(*(values[f] for f in FEATURES))).drop(whole, trimmed, words, *without)


def _tree(codes: np.ndarray, gradient: np.ndarray, weight: np.ndarray, edges: list[np.ndarray], t: Training) -> tuple[list[Rule], np.ndarray]:
    """The rules of one tree's nodes, and the step for each row."""
    n, step, rules = len(gradient), np.zeros(len(gradient)), []
    todo: list[tuple[np.ndarray, dict, int]] = [(np.arange(n), {}, 0)]
    least = max(2, int(t.min_leaf * n))
    while todo:
        rows, where, depth = todo.pop()
        g, h = gradient[rows], weight[rows]
        if where:
            rules.append(tuple(sorted((f, at_most, c) for (f, at_most), c in where.items())))
        best = (1e-9, -1, -1)
        if depth < t.depth and len(rows) >= 2 * least:
            base = g.sum() ** 2 / (h.sum() + 1e-9)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                size = np.bincount(codes[rows, f], minlength=len(e) + 1).cumsum()[:-1]
                gl = np.bincount(codes[rows, f], g, len(e) + 1).cumsum()[:-1]
                hl = np.bincount(codes[rows, f], h, len(e) + 1).cumsum()[:-1]
                gain = gl**2 / (hl + 1e-9) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1e-9) - base
                gain[(size < least) | (len(rows) - size < least)] = -np.inf
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k)
        if best[1] < 0:
            step[rows] = g.sum() / (h.sum() + 1e-9)
            continue
        _, f, k = best
        c, left = float(edges[f][k]), codes[rows, f] <= k
        todo.append((rows[left], where | {(f, True): min(c, where.get((f, True), c))}, depth + 1))
        todo.append((rows[~left], where | {(f, False): max(c, where.get((f, False), c))}, depth + 1))
    return rules, step


def find_rules(x: np.ndarray, y: np.ndarray, t: Training) -> list[Rule]:
    """Rules from boosted trees, each once, in order of discovery."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, t.bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    rng, logit, rules = np.random.default_rng(t.seed), np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), {}
    for _ in range(t.trees):
        p = 1 / (1 + np.exp(-logit))
        rows = np.flatnonzero(rng.random(len(y)) < t.sample)
        found, _ = _tree(codes[rows], (y - p)[rows], (p * (1 - p))[rows], edges, t)
        # The whole sample takes the tree's step.
        leaves, step = [r for r in found if not any(set(r) < set(o) for o in found)], np.zeros(len(y))
        for r in leaves:
            at = holds(r, x)
            g, h = (y - p)[at].sum(), (p * (1 - p))[at].sum()
            step[at] = np.clip(g / (h + 1.0), -4, 4)
        logit += t.rate * step
        rules.update(dict.fromkeys(found))
    return list(rules)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, at_most, c in rule:
        out &= (x[:, f] <= c) == at_most
    return out


def lasso_logistic(r: np.ndarray, y: np.ndarray, t: Training) -> tuple[np.ndarray, float]:
    """Weights and intercept that make mean logistic loss + lasso * |weights| least, by accelerated proximal steps."""
    n, k = r.shape
    mean = r.mean(0) if k else np.zeros(0)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-4))
    z = np.hstack([(r - mean) / spread, np.ones((n, 1))])
    size = 0.25 * np.linalg.norm(z.T @ z / n, 2)
    w = np.zeros(k + 1)
    v, m = w.copy(), 1.0
    for _ in range(t.steps):
        p = 1 / (1 + np.exp(-np.clip(z @ v, -40, 40)))
        new = v - z.T @ (p - y) / n / size
        new[:k] = np.sign(new[:k]) * np.maximum(np.abs(new[:k]) - t.lasso / size, 0)
        m2 = (1 + np.sqrt(1 + 4 * m * m)) / 2
        v, w, m = new + (m - 1) / m2 * (new - w), new, m2
    weights = w[:k] / spread
    return weights, float(w[k] - weights @ mean)


@dataclass(frozen=True)
class Ensemble:
    """Rules with their weights."""

    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def column(self, features: Column) -> Column:
        """The score, from 0 to 1, as an expression of the array of features."""
        terms = [F.lit(self.intercept)]
        for rule, weight in zip(self.rules, self.weights):
            test = F.lit(True)
            for f, at_most, c in rule:
                test = test & (features[f] <= c if at_most else features[f] > c)
            terms.append(F.when(test, F.lit(weight)).otherwise(F.lit(0.0)))
        while len(terms) > 1:  # a balanced sum: shallow expressions
            terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-terms[0]))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            logit += weight * holds(rule, x)
        return 1 / (1 + np.exp(-logit))


def fit(x: np.ndarray, y: np.ndarray, t: Training = Training()) -> Ensemble:
    if not len(y) or y.min() == y.max():
        return Ensemble((), (), 0.0 if not len(y) else (4.0 if y[0] else -4.0))
    rules = find_rules(x, y, t)
    weights, intercept = lasso_logistic(np.stack([holds(r, x) for r in rules], axis=1).astype(float), y, t) if rules else (np.zeros(0), float(np.log(y.mean() / (1 - y.mean()))))
    kept = [i for i, w in enumerate(weights) if abs(w) > 1e-6]
    return Ensemble(tuple(rules[i] for i in kept), tuple(float(weights[i]) for i in kept), intercept)


def training_rows(counted: DataFrame, labels: DataFrame, t: Training) -> tuple[np.ndarray, np.ndarray]:
    """The bounded sample. counted: doc_id, features; labels: doc_id, label (0 to 1).

    At most max_rows ids are chosen from the labels alone; only their features come to the driver, once for an
    id that is repeated.
    """
    one = labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg((F.avg("label") >= 0.5).alias("label"))
    chosen = [i for _, i in least_hashed(one, "doc_id", t.max_rows)]
    ids = counted.sparkSession.createDataFrame([(i,) for i in chosen], T.StructType([labels.schema["doc_id"]]))
    some = counted.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("features").alias("features"))
    rows = some.join(one, "doc_id").select("features", F.xxhash64("doc_id").alias("h"), "doc_id", "label").collect()
    rows.sort(key=lambda r: (r["h"], r["doc_id"]))
    return np.array([r["features"] for r in rows], float).reshape(len(rows), -1), np.array([float(r["label"]) for r in rows])
