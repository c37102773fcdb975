from __future__ import annotations

import random
from hashlib import sha256
from itertools import combinations

from pyspark.sql import functions as F

from revisit.llm import simhash as sh
from tests.llm.conftest import prose


def edited(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        after, k = rows[(i + 1) % len(rows)][1], len(text) // 4
        out.append((str(doc_id), len(text), sha256((text[: len(text) - k] + after[:k]).encode()).hexdigest()))
    return sorted(out)


def test_edits_fingerprints_and_likeness(docs, clashing, none):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    for some in (docs, clashing):
        got = sh.edit_report(some, per_bucket=3).collect()
        assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == edited(rows)
    texts = {}
    for doc_id, t in rows:
        texts.setdefault(doc_id, t)
    prints = {}
    for r in got:
        assert prints.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"] and len(r["fingerprint"]) == 32
        a, b = int(r["fingerprint"], 16), int(r["edited_fingerprint"], 16)
        assert abs(r["near_edited"] - (1 - (a ^ b).bit_count() / 128)) < 1e-12 and 0 <= r["near_next"] <= 1
        assert r["class_id"] == min(d for d, t in texts.items() if t == texts[r["doc_id"]] and d is not None or d == r["doc_id"] is None) if r["doc_id"] is not None else True
    assert sh.edit_report(none).collect() == []


def test_fingerprints_are_votes(spark):
    text = "a b c d e f"
    rows = spark.createDataFrame([(0, text), (1, text + " g"), (2, "")], "k int, text string")
    got = {r["k"]: (r["high"], r["low"]) for r in sh.fingerprints(rows, ["k"], "text").collect()}
    words, votes = text.split(), [0] * 128
    for w in zip(words, words[1:], words[2:]):
        h = spark.range(1).select(F.xxhash64(*map(F.lit, w)), F.xxhash64(F.lit(7), *map(F.lit, w))).first()
        for half in (0, 1):
            for i in range(64):
                votes[64 * half + i] += 1 if (h[half] >> i) & 1 else -1
    want = [sum(1 << i for i in range(64) if votes[64 * half + i] > 0) for half in (0, 1)]
    assert [x % 2**64 for x in got[0]] == want and got[1] != got[0]


def test_all_pairs_within_the_radius(spark):
    rng, prints = random.Random(5), set()
    while len(prints) < 120:
        base = rng.getrandbits(128)
        prints.add(base)
        for _ in range(4):
            x = base
            for i in rng.sample(range(128), rng.randint(0, 6)):
                x ^= 1 << i
            prints.add(x)
    signed = lambda x: x - 2**64 if x >> 63 else x
    rows = [(signed(x >> 64), signed(x & (2**64 - 1))) for x in prints]
    frame = spark.createDataFrame(rows, "high long, low long")
    for search in (sh.Search(), sh.Search(radius=2, blocks=5), sh.Search(radius=0, blocks=1)):
        got = [((r["a_high"] % 2**64) << 64 | (r["a_low"] % 2**64), (r["b_high"] % 2**64) << 64 | (r["b_low"] % 2**64)) for r in sh.close_pairs(frame, search).collect()]
        want = {frozenset(p) for p in combinations(prints, 2) if (p[0] ^ p[1]).bit_count() <= search.radius}
        assert len(got) == len(want) and {frozenset(p) for p in got} == want


def test_links_count_texts(spark):
    rows = [(1, "t1", 0, 0), (2, "t1", 0, 0), (3, "t2", 0, 1), (4, "t3", 0, 1), (5, "t4", 7, 0), (6, "t5", -1, -1)]
    got = {r["text_sha256"]: (r["class_id"], r["n_links"]) for r in sh.links(spark.createDataFrame(rows, "doc_id long, text_sha256 string, high long, low long")).collect()}
    assert got == {"t1": (1, 3), "t2": (3, 2), "t3": (4, 2), "t4": (5, 1), "t5": (6, 0)}


def test_all_pairs_within_the_radius_of_edits(spark):
    rng, prints = random.Random(6), set()
    for _ in range(40):
        base = rng.getrandbits(128)
        prints |= {base} | {base ^ sum(1 << i for i in rng.sample(range(128), n)) for n in (1, 6, 9, 12, 13)}
    signed = lambda x: x - 2**64 if x >> 63 else x
    frame = spark.createDataFrame([(signed(x >> 64), signed(x & (2**64 - 1))) for x in prints], "high long, low long")
    got = [frozenset((r[a] % 2**64) << 64 | r[b] % 2**64 for a, b in (("a_high", "a_low"), ("b_high", "b_low"))) for r in sh.close_pairs(frame, sh.EDITED).collect()]
    want = {frozenset(p) for p in combinations(prints, 2) if (p[0] ^ p[1]).bit_count() <= sh.EDITED.radius}
    assert len(got) == len(want) and set(got) == want
    # Counts instead of pairs, also where a key's fingerprints fill several chunks.
    weight = {x: i % 3 + 1 for i, x in enumerate(sorted(prints))}
    counted = spark.createDataFrame([(signed(x >> 64), signed(x & (2**64 - 1)), n) for x, n in weight.items()], "high long, low long, n long")
    for search, chunk in ((sh.EDITED, 2), (sh.Search(radius=12, blocks=14), 1024), (sh.Search(radius=40, blocks=41), 5)):
        near = {(r["high"] % 2**64) << 64 | r["low"] % 2**64: r["near"] for r in sh.near_counts(counted, search, chunk).collect()}
        sums = {x: sum(weight[y] for y in prints if y != x and (x ^ y).bit_count() <= search.radius) for x in prints}
        assert near == {x: n for x, n in sums.items() if n}


def test_buckets_fill_evenly_however_ids_lie(spark):
    from collections import Counter

    ids = [*range(900), 9 * 10**18, -(10**15), *[10**12 + i for i in range(600)], *[None] * 500]
    docs = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string")
    rows = sh.bucketed(docs, "doc_id", 20).collect()
    assert max(Counter(r["bucket"] for r in rows).values()) <= 60 and len(rows) == len(ids)
    known = sorted((r["doc_id"], r["bucket"]) for r in rows if r["doc_id"] is not None)
    assert [b for _, b in known] == sorted(b for _, b in known) and min(b for _, b in known) >= 0
    assert all(r["bucket"] < 0 for r in rows if r["doc_id"] is None)
    only = sh.edit_report(docs.filter("doc_id is null"), per_bucket=20)
    assert only.count() == 500


def test_texts_with_one_changed_word_are_linked(spark):
    rng, rows = random.Random(8), []
    for i in range(60):
        words = prose(3000 + i, [150, 300, 1000][i % 3]).split(" ")
        near = list(words)
        near[rng.randrange(len(near))] = "changed"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(near))]
    got = sh.edit_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    linked = {r["doc_id"] for r in got if r["n_links"] == 1}
    assert len(got) == 120 and len(linked) >= 0.9 * 120 and all(r["n_links"] <= 1 for r in got)


def test_no_python_in_the_plan(docs):
    plan = sh.edit_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_chunks_of_a_large_key_meet_in_many_tasks(spark):
    # One key in most tables: 300 fingerprints that differ in the low bits only, in chunks of about 32.
    prints = [x << 3 | x.bit_count() % 8 for x in range(300)]
    counted = spark.createDataFrame([(0, x, 1) for x in prints], "high long, low long, n long")
    frame = sh.near_counts(counted, sh.EDITED, 32)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "fold" in plan  # most pairs end there
    dealt = [line for line in plan.splitlines() if "hashpartitioning(" in line and "chunk#" in line.split("hashpartitioning(")[1]]
    assert dealt and all("other#" in line for line in dealt)
    got = {r["low"]: r["near"] for r in frame.collect()}
    want = {x: sum(1 for y in prints if x != y and (x ^ y).bit_count() <= sh.EDITED.radius) for x in prints}
    assert got == {x: n for x, n in want.items() if n}
