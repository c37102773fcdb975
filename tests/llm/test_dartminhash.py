from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.conftest import prose

from revisit.llm import dartminhash as dm


def test_agreement_is_weighted_jaccard():
    rng = np.random.default_rng(0)
    n, k = 300, 2000
    for _ in range(4):
        h = rng.integers(1, 2**63, n).astype(np.uint64)
        w = rng.integers(0, 4, (2, n)) + rng.random((2, n)) * (rng.random() < 0.5)
        w *= rng.random((2, n)) < 0.8
        owner, which = np.nonzero(w > 0)
        signed = dm.signatures(h[which], owner, w[owner, which], 2, k)
        want = np.minimum(w[0], w[1]).sum() / np.maximum(w[0], w[1]).sum()
        assert abs((signed[0] == signed[1]).mean() - want) < 4 * np.sqrt(0.25 / k)
        assert (signed > 0).all()


def test_a_text_alone_or_among_others_signs_alike():
    texts = [prose(1, 100), "x", prose(2, 3000), "", "x y"]
    hashes, owner, weights = dm.elements(pa.array(texts), dm.Near())
    all_ = dm.signatures(hashes, owner, weights, 5, 50)
    for i, t in enumerate(texts):
        e = dm.elements(pa.array([t]), dm.Near())
        assert (dm.signatures(*e, 1, 50)[0] == all_[i]).all()
    assert (all_[3] == 0).all()


def brute(rows, bound=0.8):
    """Groups of row positions: equal texts, and links by plain Jaccard of five-word runs."""
    sets = []
    for _, text in rows:
        w = (text or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in where[x]:
                shared[j] += 1
        near = [j for j, n in shared.items() if n / (len(s) + len(sets[j]) - n) >= bound]
        near += [j for j in range(i) if (rows[j][1] or "") == (rows[i][1] or "")]
        for j in near:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return [find(i) for i in range(len(rows))]


def family(seed, base, n):
    rng, words, out = random.Random(seed), base.split(" "), []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def corpus():
    texts = [t for s in range(12) for t in family(s, prose(100 + s, 60 + 20 * s), 12)] + [prose(500 + i, 80) for i in range(40)]
    random.Random(1).shuffle(texts)
    return list(enumerate(texts)) + [(900, None), (901, ""), (902, "  "), (903, "a b"), (904, "a b"), (904, "a b"), (None, "null id")]


def test_groups_are_those_of_brute_force(spark, corpus):
    frame = spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
    got = dm.near_report(frame).collect()
    want = brute(corpus)
    least = {}
    for (d, _), g in zip(corpus, want):
        least[g] = d if g not in least or least[g] is None or (d is not None and d < least[g]) else least[g]
    assert sorted((str(r["doc_id"]), str(r["group_id"])) for r in got) == sorted((str(d), str(least[g])) for (d, _), g in zip(corpus, want))
    assert sum(r["kept"] for r in got) == len(set(want))


def test_one_of_each_group_stays(docs, clashing, none):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    groups = len(set(brute(rows)))
    for some in (docs, clashing):
        kept = dm.near_dedup(some)
        assert kept.columns == some.columns and kept.count() == groups
    assert dm.near_dedup(none).collect() == [] and dm.near_report(none).collect() == []


def test_counts_as_weights(spark):
    rows = [(1, "a b c d e f " * 10), (2, "a b c d e f " * 30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert len({r["group_id"] for r in dm.near_report(frame).collect()}) == 1
    assert len({r["group_id"] for r in dm.near_report(frame, dm.Near(weights="count")).collect()}) == 2


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7), (10, 9), (9, 8), (20, 21)]
    got = {r["node"]: r["component"] for r in dm.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 8)}, 8: 8, 9: 8, 10: 8, 20: 20, 21: 20}
    assert dm.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_merged_components(spark):
    first = [(1, 2), (3, 4), (5, 6)]
    more = [(4, 6), (7, 8), (8, 2), (2, 1)]
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in dm.merged(dm.components(frame(first)), frame(more)).collect()}
    assert got == {r["node"]: r["component"] for r in dm.components(frame(first + more)).collect()}


def test_the_filter_with_counts_keeps_texts_with_and_without_repeats(spark):
    rows = []
    for s in range(4):
        base = prose(700 + s, 80)
        rows += [base, base + " " + " ".join(base.split()[:8]), base + " one more", base + " " + " ".join(base.split()[:6] * 2), prose(800 + s, 40)]
    runs = []
    for t in rows:
        w = t.split()
        runs.append(Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)))
    assert {max(c.values()) > 1 for c in runs} == {True, False}
    want = {(i, j) for j in range(len(rows)) for i in range(j) if sum((runs[i] & runs[j]).values()) >= 0.8 * sum((runs[i] | runs[j]).values())}
    near = dm.Near(weights="count")
    sets = dm.element_sets(spark.createDataFrame(list(enumerate(rows)), "row long, text string"), near).cache()
    pairs = dm.prefix_pairs(sets.selectExpr("row as class_row", "row as component"), sets, near)
    got = {(r["a"], r["b"]) for r in dm.verified(pairs, sets, near).collect()}
    assert len(want) >= 12 and got == want


def test_a_large_group_of_near_copies_is_compared_less_than_twice_a_class(spark, monkeypatch):
    texts = [t for s in range(2) for t in family(5 + s, prose(950 + s, 300), 60)]
    compared, verified = [], dm.verified

    def counted(pairs, sets, near):
        compared.append(pairs.count())
        return verified(pairs, sets, near)

    monkeypatch.setattr(dm, "verified", counted)
    rows = list(enumerate(texts))
    got = dm.near_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["group_id"] for r in got} == dict(enumerate(brute(rows)))
    assert 0 < sum(compared) < 2 * len(rows)


def test_a_large_group_whose_first_rows_are_far_from_the_others_is_compared_less_than_twice_a_class(spark, monkeypatch):
    base, rng, texts = prose(970, 300), random.Random(9), []
    for edits in [6] * 40 + [0] + [1, 2, 3] * 27:
        w = base.split(" ")
        for at in rng.sample(range(len(w)), edits):
            w[at] = f"w{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    compared, listed, verified, prefix_pairs = [], [], dm.verified, dm.prefix_pairs

    def counted(pairs, sets, near):
        compared.append(pairs.count())
        return verified(pairs, sets, near)

    def counted_list(open_, sets, near):
        pairs = prefix_pairs(open_, sets, near)
        listed.append(pairs.count())
        return pairs

    monkeypatch.setattr(dm, "verified", counted)
    monkeypatch.setattr(dm, "prefix_pairs", counted_list)
    rows = list(enumerate(texts))
    got = dm.near_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["group_id"] for r in got} == dict(enumerate(brute(rows)))
    assert 0 < sum(compared) < 2 * len(rows) and sum(listed) < len(rows), (compared, listed)


def test_verifying_makes_few_python_objects_at_a_time(spark):
    import tracemalloc

    class Frame:
        """Takes any step, and keeps the function that tasks run."""

        def __getattr__(self, name):
            return lambda *a: self

        def mapInArrow(self, run, kind):
            self.run = run
            return self

    n, m = 4000, 500
    sets = np.arange(n * m, dtype="<u8").reshape(n, m)
    a = pa.array([x.tobytes() for x in sets], pa.binary())
    ids, empty = pa.array(range(n), pa.int64()), pa.array([b""] * n, pa.binary())
    batch = pa.RecordBatch.from_arrays([ids, ids, a, a, empty, empty], ["a", "b", "ha", "hb", "wa", "wb"])
    run = dm.verified(Frame(), Frame(), dm.Near()).run
    tracemalloc.start()
    try:
        found = sum(x.num_rows for x in run(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == n and most < batch.nbytes / 4
