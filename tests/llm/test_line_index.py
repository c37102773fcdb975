"""The line index against counting lines, and its filters against a multiset."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from revisit.llm import line_index
from revisit.llm.line_index import Cuckoo, LineIndex, Rules, line_keys, line_report

DOCS = "doc_id long, text string"
SPACES = " \t\n\x0b\x0c\r"


def key_of(line: str, rules: Rules):
    line = line.strip(SPACES)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line) if len(line) >= rules.least else None


def by_hand(rows, rules: Rules = Rules()) -> list[tuple]:
    """doc_id, lines, dropped, kept text. rows: (doc_id, text)."""
    holders = defaultdict(list)
    for i, text in rows:
        for key in {key_of(line, rules) for line in (text or "").split("\n")} - {None}:
            holders[key].append(i)
    largest = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= rules.documents}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [line for line in lines if key_of(line, rules) not in largest or largest[key_of(line, rules)] == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def kept(index: LineIndex, df) -> list[tuple]:
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in index.kept(df).collect()), key=repr)


def lines_text(seed: int, n: int, first: int = 0) -> list[tuple]:
    rng = random.Random(seed)
    common = [f"A common line number {i} of them é😀" for i in range(12)] + ["short", "", "exactly twenty chars", "nineteen characters"]
    rows = []
    for i in range(first, first + n):
        some = [rng.choice(common) if rng.random() < 0.5 else f"only in document {i}: {rng.random()}" for _ in range(rng.randint(0, 9))]
        rows.append((i, "\n".join(rng.choice(["", " ", "\t\x0b", "\r"]) + (s.upper() if rng.random() < 0.3 else s) + rng.choice(["", "\r", "  "]) for s in some)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_report_against_counting(spark):
    rows = lines_text(1, 300)
    got = sorted((tuple(r) for r in line_report(frame(spark, rows)).collect()), key=repr)
    assert got == sorted(((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in by_hand(rows)), key=repr)
    assert sum(r[2] for r in got) > 300


def test_edge_documents_and_clashing_columns(spark, docs, clashing):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rules = Rules(least=3, documents=2)
    index = LineIndex.empty(spark, rules=rules).insert(docs)
    want = by_hand(rows, rules)
    assert kept(index, docs) == want and any(r[2] for r in want)
    extra = clashing.selectExpr("*", "1 AS _hits", "2 AS _gone", "3 AS _new", "4 AS hi", "5 AS n", "6 AS id")
    out = index.kept(extra)
    assert out.columns == [*extra.columns, "n_lines", "n_dropped"] and kept(index, extra) == want
    assert out.filter("doc_id = 1").first()["text"] is None


def test_rows_without_ids_and_repeated_rows(spark):
    line = "a line of more than twenty characters"
    for ids in ([None] * 4, [None, None, 3, 3, 3], [5, 5, 5], [1, 2, None], [1, 1]):
        rows = [(i, f"{line}\n{k}") for k, i in enumerate(ids)]
        df = frame(spark, rows)
        assert kept(LineIndex.empty(spark).insert(df), df) == by_hand(rows)


def test_empty(spark):
    df = spark.createDataFrame([], DOCS)
    out = line_report(df)
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"] and out.count() == 0
    index = LineIndex.empty(spark).insert(df)
    assert index.counts.count() == 0 and index.filters.count() == 0
    some = frame(spark, lines_text(2, 5))
    assert kept(index, some) == by_hand([tuple(r) for r in some.collect()], Rules(documents=99))


def state(index: LineIndex) -> tuple[list, dict]:
    """The counts, and for each shard what the filter holds: it answers for its keys and has as many fingerprints."""
    counts = sorted(tuple(r) for r in index.counts.select("hi", "lo", "n", "largest").collect())
    repeated = defaultdict(list)
    for hi, lo, n, _ in counts:
        if n >= index.rules.documents:
            repeated[lo & (index.shards - 1)].append(hi)
    filters = {r["shard"]: Cuckoo.from_bytes(bytes(r["bits"])) for r in index.filters.collect()}
    for shard, keys in repeated.items():
        assert filters[shard].test(np.array(keys)).all()
    return counts, {s: len(f) for s, f in filters.items() if len(f)} | {s: len(k) for s, k in repeated.items() if len(k) != len(filters[s])}


def test_insert_and_remove_are_reversible(spark):
    a, b, c = lines_text(3, 120), lines_text(4, 80, 120), lines_text(5, 60, 60)
    fa, fb, fc = (frame(spark, x) for x in (a, b, c))
    one = LineIndex.empty(spark).insert(fa)
    both = one.insert(fb)
    at_once = LineIndex.empty(spark).insert(frame(spark, a + b))
    assert state(both) == state(at_once)
    assert kept(both, fa.unionByName(fb)) == by_hand(a + b)
    assert kept(one, fa) == by_hand(a)  # an earlier version stays as it was
    back = both.remove(fb, fa)
    assert state(back) == state(one) and kept(back, fa) == by_hand(a)
    # Out of the middle: c has the ids of some of a's documents.
    three = both.insert(fc)
    assert kept(three, fc) != kept(one, fc)
    rest = three.remove(fa, fb.unionByName(fc))
    assert kept(rest, fb.unionByName(fc)) == by_hand(b + c) and state(rest) == state(LineIndex.empty(spark).insert(frame(spark, b + c)))
    nothing = rest.remove(fb.unionByName(fc), spark.createDataFrame([], DOCS))
    assert state(nothing) == ([], {})


def test_the_next_largest_holder(spark):
    line = "a line of more than twenty characters"
    rows = [(i, line) for i in range(6)]
    index = LineIndex.empty(spark).insert(frame(spark, rows))
    left = index.remove(frame(spark, rows[4:]), frame(spark, rows[:4]))
    assert [r["largest"] for r in left.counts.collect()] == [3] and kept(left, frame(spark, rows[:4])) == by_hand(rows[:4])


def test_full_shards_are_built_anew(spark):
    """Each insert brings more repeated lines than the filters had room for."""
    index, rows = LineIndex.empty(spark, rules=Rules(documents=2)), []
    index = line_index.replace(index, shards=2)
    for step in range(3):
        new = [(100 * step + i, "\n".join(f"line {k} of the step number {step}" for k in range(20 * 12**step))) for i in range(2)]
        rows += new
        index = index.insert(frame(spark, new))
        rooms = {r["shard"]: r["room"] for r in index.filters.collect()}
        assert len(rooms) == 2 and state(index)[0]
    assert min(rooms.values()) >= 1500
    assert kept(index, frame(spark, rows)) == by_hand(rows, index.rules)


def test_too_large_to_broadcast(spark):
    rows = lines_text(6, 100)
    df = frame(spark, rows)
    index = LineIndex.empty(spark, rules=Rules(most_bytes=0)).insert(df)
    assert index._filter(spark) is None and kept(index, df) == by_hand(rows)


def test_filters_let_little_through(spark):
    """Lines that are not repeated hardly leave their row."""
    rows = lines_text(7, 400)
    df = frame(spark, rows)
    index = LineIndex.empty(spark).insert(df)
    let = {(k["hi"], k["lo"]) for r in index.marked(df, "hits").collect() for k in r["hits"]}
    repeated = {(r["hi"], r["lo"]) for r in index.repeated().collect()}
    assert repeated <= let and len(let - repeated) < 0.02 * index.counts.count() and index.counts.count() > 10 * len(repeated)


@pytest.mark.parametrize(("buckets", "share"), [(16, 0.9), (1024, 0.95), (1, 0.5)])
def test_cuckoo_against_a_multiset(buckets, share):
    rng = np.random.default_rng(buckets)
    cuckoo, held = Cuckoo(buckets), Counter()
    for _ in range(6):
        new = rng.integers(-(2**63), 2**63 - 1, max(1, int(cuckoo.room * share / 3)))
        new = np.concatenate([new, new[:3]])  # the same key twice
        cuckoo.insert(new)
        held.update(new.tolist())
        assert cuckoo.test(np.array(list(held))).all() and len(cuckoo) == held.total()
        out = rng.permutation(np.array(list(held.elements())))[: held.total() // 2]
        cuckoo = Cuckoo.from_bytes(cuckoo.to_bytes())
        cuckoo.delete(out)
        held -= Counter(out.tolist())
        assert cuckoo.test(np.array(list(held))).all() and len(cuckoo) == held.total()
    others = rng.integers(-(2**63), 2**63 - 1, 20_000)
    assert cuckoo.test(others).mean() < 0.01


def test_line_keys():
    rules = Rules()
    for text in ("x" * 19, "x" * 20, "é" * 19, "é" * 20, "😀" * 19 + " ", " \t" + "😀" * 20 + "\x0b\r", "A" * 30 + "\n" + "a" * 30, "İ" * 20, "\x85" + "b" * 19):
        got = line_keys(text.encode(), rules.least)
        want = [key_of(line, rules) for line in text.split("\n")]
        assert [k is None for k in got] == [k is None for k in want]
        assert all((g == h) == (v == w) for g, v in zip(got, want) for h, w in zip(got, want))
