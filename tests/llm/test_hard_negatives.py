"""Hard negatives against scoring all pairs in whole numbers."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from revisit.llm import hard_negatives
from revisit.llm.hard_negatives import Block, Mining, bounds, coarser, first, kth_largest, refined, scores, summaries

ROWS = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def by_hand(rows, m: Mining, anchor) -> list[tuple]:
    whole = lambda x: max(-(10**17), min(10**17, math.floor(m.scale * float(x))))
    taking = [(i, [whole(x) for x in v], label) for i, v, label in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda c: (-c[0], c[1] is None, c[1] or 0)
    out = []
    for n, (i, v, label) in enumerate(taking):
        if i is None or not anchor(i):
            continue
        found = [(sum(x * y for x, y in zip(v, w)), j, other) for k, (j, w, other) in enumerate(taking) if k != n]
        for p, pid, _ in sorted((c for c in found if c[2] == label), key=key)[: m.positives]:
            fits = (c for c in found if c[2] != label and m.low * p <= 100 * c[0] <= m.high * p)
            out += [(i, pid, rank, nid, p, s) for rank, (s, nid, _) in enumerate(sorted(fits, key=key)[: m.negatives], 1)]
    return sorted(out, key=repr)


def found(spark, rows, m: Mining, anchor=5):
    df = spark.createDataFrame(rows, ROWS).repartition(3) if isinstance(rows, list) else rows
    out = hard_negatives.hard_negatives(df, lambda i: i % anchor == 0, m)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=repr)


def cluster_rows(seed: int, n: int, width: int = 64, spread: float = 0.05) -> list[tuple]:
    """Vectors near centres that are even within segments, with copies and a hot label."""
    rng = np.random.default_rng(seed)
    centres = np.repeat(rng.normal(size=(6, 4)), width // 4, axis=1)
    rows = []
    for i in range(n):
        c = int(rng.integers(6))
        v = centres[c] + rng.normal(scale=spread, size=width)
        if rows and rng.random() < 0.3:
            v = np.array(rows[int(rng.integers(len(rows)))][1])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.choice([0, 0, 0, 1, 2, 3]))))
    return rows


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_against_all_pairs(spark, spread):
    rows = cluster_rows(1, 240, spread=spread)
    m = Mining(rows_least=50, anchors=20)
    want = by_hand(rows, m, lambda i: i % 5 == 0)
    assert want and found(spark, rows, m) == want


def test_other_shapes(spark):
    rows = cluster_rows(2, 120, width=12, spread=0.4)
    m = Mining(positives=2, negatives=7, low=10, high=130, levels=(2, 3, 6)[::2], rows_least=31, pairs_together=64)
    want = by_hand(rows, m, lambda i: i % 5 == 0)
    assert want and found(spark, rows, m) == want


def edge_rows() -> list[tuple]:
    rng = random.Random(3)
    line = lambda n=8: [float(np.float32(rng.gauss(0, 1))) for _ in range(n)]
    rows = [(i, line(), i % 3) for i in range(40)]
    rows += [rows[5], rows[5], rows[6], (None, line(), 1), (None, rows[6][1], 0), (None, None, None)]
    rows += [(60, None, 1), (61, line(), None), (65, [1.0, None], 0), (70, [float("nan")] * 8, 1), (75, [float("inf")] + line(7), 2), (80, [], 0), (85, line(3), 1), (90, line(20), 2), (95, [0.0] * 8, 1)]
    return rows


def test_nulls_lengths_copies_and_ties(spark):
    rows = edge_rows()
    want = by_hand(rows, Mining(), lambda i: i % 5 == 0)
    assert want and found(spark, rows, Mining(rows_least=7, anchors=3)) == want


def test_clashing_columns(spark):
    rows = edge_rows()
    extra = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 AS row", "2 AS id", "3 AS side", "4 AS part", "5 AS `a.b`", "6 AS anchor", "7 AS most")
    assert found(spark, extra, Mining(rows_least=9)) == by_hand(rows, Mining(), lambda i: i % 5 == 0)


def test_empty_and_lone(spark):
    assert found(spark, [], Mining()) == []
    assert found(spark, [(0, [1.0, 2.0], 1)], Mining()) == []
    assert found(spark, [(0, [1.0], 1), (1, [1.0], 1)], Mining()) == []


@pytest.mark.parametrize("size", [3e5, 3e8, 2e30])
def test_large_components_stay_exact(spark, size):
    """Doubles, longs and whole numbers of any size; only the last are cut to a long, after they are ordered."""
    rows = [(i, [float(np.float32(x * size)) for x in v], label) for i, v, label in cluster_rows(4, 60, width=8, spread=0.6)]
    want = by_hand(rows, Mining(), lambda i: i % 5 == 0)
    held = lambda s: max(-(2**63), min(2**63 - 1, s))
    assert want and found(spark, rows, Mining(rows_least=17)) == sorted(((*r[:4], held(r[4]), held(r[5])) for r in want), key=repr)


def block(vectors: np.ndarray, m: Mining) -> Block:
    n, fine = len(vectors), m.levels[-1]
    binary = lambda x: pa.array([line.tobytes() for line in x], pa.binary())
    return Block(pa.table({"row": np.arange(n), "id": pa.array(np.arange(n)), "label": np.zeros(n, np.int64), "vector": binary(vectors), "segments": binary(np.hstack(summaries(vectors, fine)))}), m)


def test_bounds_hold_and_tighten():
    m, rng = Mining(levels=(1, 4, 16)), np.random.default_rng(5)
    vectors = np.floor(rng.normal(scale=40, size=(200, 64)) + np.repeat(rng.normal(scale=60, size=(200, 8)), 8, axis=1))
    b, exact, every = block(vectors, m), vectors @ vectors.T, slice(0, 200)
    widths = []
    for level in range(3):
        low, high = bounds(b, every, b, level)
        assert (low <= exact).all() and (exact <= high).all()
        widths.append((high - low).mean())
        pairs = (np.arange(50), np.arange(50, 100))
        assert np.allclose(np.array(bounds(b, every, b, level, pairs)), np.array((low[pairs], high[pairs])))
    assert widths[0] > widths[1] > widths[2]
    for m_ in (1, 4):
        assert np.allclose(np.array(coarser(*summaries(vectors, 16), m_)), np.array(summaries(vectors, m_)))


def test_structured_vectors_are_ruled_out():
    """Where segments say something, few pairs are scored."""
    m = Mining()
    vectors = np.floor(256 * np.array([v for _, v, _ in cluster_rows(6, 600, spread=0.02)]))
    b, every = block(vectors, m), slice(0, 600)
    keep = lambda least, largest, open_: open_ & (largest >= kth_largest(np.where(open_, least, -np.inf), 5))
    open_ = refined(b, every, b, np.ones((600, 600), bool), keep, m)
    assert open_.mean() < 0.3
    i, j = first(scores(b, every, b, open_, "double"), open_, 5)
    want = np.argsort(-(vectors @ vectors.T), axis=1, kind="stable")[:, :5]
    assert (j.reshape(600, 5) == want).all()


def test_first_breaks_ties_by_column():
    values = np.array([[3.0, 5, 5, 5, 1], [0, 0, 0, 0, 9]])
    i, j = first(values, np.array([[1, 1, 1, 1, 1], [0, 1, 1, 0, 0]], bool), 2)
    assert list(zip(i, j)) == [(0, 1), (0, 2), (1, 1), (1, 2)]
