from __future__ import annotations

import random
from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from revisit.llm import suffix_dedup as sd
from revisit.llm import suffix_sort as ss
from tests.llm.conftest import prose


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(min_size=1, max_size=300), st.text("ab", min_size=1, max_size=300).map(str.encode)), st.sampled_from([8, 16, 96]))
def test_suffixes_are_sorted_and_prefixes_counted(data, depth):
    a = np.frombuffer(data, np.uint8)
    words = ss.words_at(a, depth + 16)
    order = ss.suffix_array(a, depth, words)
    keys = [(data[i : i + depth] + b"\0" * depth)[:depth] for i in order]
    assert sorted(order.tolist()) == list(range(len(data)))
    assert all(x <= y for x, y in zip(keys, keys[1:]))
    for i, n in enumerate(ss.common_prefixes(order, words, depth)):
        want = next((j for j in range(depth) if keys[i][j] != keys[i - 1][j]), depth) if i else 0
        assert n == want


def brute(rows, length):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] is not None, rows[i][1] or ""))
    for i in order:
        b = (rows[i][1] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        runs = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((str(rows[i][0]), len(b), sum(gone), runs, sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


def report(frame, r):
    return sorted((str(x["doc_id"]), x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in sd.dedup_report(frame, r).collect())


def test_edge_cases_match_brute_force(docs, clashing, none):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for some in (docs, clashing):
        assert report(some, sd.Repeats()) == brute(rows, 100)
    assert sd.dedup_report(none).collect() == [] and sd.remove_repeats(none).collect() == []


def corpus(seed):
    """Passages shared whole, in part, across one another, with periods, at both ends of texts, and near copies."""
    rng = random.Random(seed)
    shared = [prose(seed * 100 + i, rng.randint(12, 60)) for i in range(6)] + ["ab" * 90, "x" * 150, "ünï " * 40]
    rows = []
    for i in range(60):
        parts = [prose(seed * 1000 + i, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(shared)
            a = rng.randint(0, len(p) // 2)
            parts.insert(rng.randint(0, len(parts)), p[a : a + rng.randint(len(p) // 2, len(p))])
        rows.append((rng.randint(0, 10**6), rng.choice(["", " ", "\n"]).join(parts)))
    base = prose(seed, 150).split(" ")
    for i in range(30):
        words = list(base)
        words[rng.randrange(len(words))] = f"q{rng.randrange(9)}"
        rows.append((2 * 10**6 + i, " ".join(words)))
    return rows


def test_random_corpora_match_brute_force(spark):
    for seed, r in ((1, sd.Repeats()), (2, sd.Repeats(length=40, gram=16, block=2000, together=50)), (3, sd.Repeats(block=500))):
        rows = corpus(seed)
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        assert report(frame, r) == brute(rows, r.length)


def test_texts_without_their_repeats(docs, clashing):
    want = {r["doc_id"]: r for r in docs.collect()}
    for some in (docs, clashing):
        out = sd.remove_repeats(some)
        assert out.columns == some.columns
        rows = out.select("doc_id", "text", "n_chars").collect()
        assert len(rows) == docs.count()
        for r in rows:
            old = want[r["doc_id"]]
            if r["text"] != old["text"]:
                assert len(r["text"]) < len(old["text"]) and r["n_chars"] == len(r["text"])
    assert [r["text"] for r in rows if r["doc_id"] == 4] == ["", "", ""]


def test_a_short_passage_in_many_texts_is_not_one_block(spark, monkeypatch):
    """One passage in a third of the documents, each time amid other text: no task holds its segments as one group."""
    r = sd.Repeats(block=3000)
    whole = sd._later_strings

    def bounded(rows, r):
        assert sum(len(x[3]) for x in rows) <= 2 * r.block
        return whole(rows, r)

    monkeypatch.setattr(sd, "_later_strings", bounded)
    for n in (70, 99, 120, 170):
        footer = prose(5, 60)[:n]
        rows = [(i, prose(100 + i, 30) + (footer + prose(900 + i, 30) if i % 3 == 0 else "")) for i in range(300)]
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        assert report(frame, r) == brute(rows, r.length)
