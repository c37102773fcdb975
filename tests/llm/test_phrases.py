"""Phrases by stripes against counting every phrase of every piece."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from revisit.llm import phrases
from revisit.llm.phrases import Bloom, Mining

DOCS = "doc_id long, text string, lang string"


def by_hand(rows, m: Mining) -> list[tuple]:
    """lang, rank, phrase, a, l, r, n, score. rows: (lang, text)."""
    lower = {c: c + 32 for c in range(65, 91)}
    f, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, m.longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= m.least}
        rows = []
        for p, a in candidates.items():
            inside = (q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * candidates[q] >= m.subsumed * a for q in inside):
                continue
            score, k = min((m.scale * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((score, a, " ".join(p), counts[p[:k]], counts[p[k:]]))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i, p, a, left, right, sizes[lang], score) for i, (score, a, p, left, right) in enumerate(rows[: m.top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def texts(seed: int, n: int, words: int = 12) -> list[str]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Ä", "É", "ß😀", "THE"]
    some = []
    for _ in range(n):
        out = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            out[3:3] = ["a", "fixed", "passage", "of", "words", "w1"]
        some.append("".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "\x0b", " "]) for w in out))
    return some


@pytest.mark.parametrize("mining", [Mining(least=3), Mining(least=3, words_together=50), Mining(least=2, top=7, longest=4, subsumed=50, shards=3)])
def test_against_counting(spark, mining):
    rows = [(i, t, [None, "en", "und", "de"][i % 4]) for i, t in enumerate(texts(1, 300))]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert rows_of(phrases.collocations(docs, mining)) == by_hand([(r[2], r[1]) for r in rows], mining)


def test_edge_documents_and_clashing_columns(docs, clashing):
    m = Mining(least=2)
    want = by_hand([(r["lang"], r["text"]) for r in docs.collect()], m)
    assert rows_of(phrases.collocations(docs, m)) == want and want
    extra = clashing.selectExpr("*", "1 AS lang_", "2 AS prefix", "3 AS shard", "4 AS next", "5 AS n", "6 AS phrase")
    assert rows_of(phrases.collocations(extra, m)) == want


def test_empty_table(none):
    out = phrases.collocations(none)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.count() == 0


def test_hot_prefix_and_ties(spark):
    """A word before thousands of others, and languages whose phrases all tie."""
    rows = [(i, f"the x{i % 500} the x{i % 500}. common line here", "en" if i % 3 else "de") for i in range(3000)]
    m = Mining(least=4, top=40)
    got = rows_of(phrases.collocations(spark.createDataFrame(rows, DOCS).repartition(7), m))
    assert got == by_hand([(r[2], r[1]) for r in rows], m)


def test_a_key_over_many_batches(spark):
    """Parts of one stripe that fill many Arrow batches are added without loss."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [("en", "p", 0, ["a", "b", ""], [1, 2, 3])] * 200 + [("en", "q", 0, ["a"], [1])] * 5
        out = phrases.merged(spark.createDataFrame(rows, phrases.STRIPE).repartition(9), 10).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {r["prefix"]: (r["total"], dict(zip(r["next"], r["n"]))) for r in out}
    assert got == {"p": (1200, {"a": 200, "b": 400}), "q": (5, {})}


def test_bloom_never_denies_a_member():
    rng = np.random.default_rng(1)
    members, others = rng.integers(0, 1 << 63, 4000).astype(np.uint64), rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    bloom = Bloom(1 << 16)
    bloom.add(members)
    assert bloom.test(members).all() and bloom.test(others).mean() < 0.05
    full = Bloom(64, np.full(8, 255, np.uint8))
    assert full.test(others).all()


def test_a_full_filter_only_costs_rows(spark):
    rows = [(i, t, "en") for i, t in enumerate(texts(5, 200))]
    tight, wide = Mining(least=3, max_bits=1 << 16), Mining(least=3)
    docs = spark.createDataFrame(rows, DOCS)
    read = docs.select("lang", "text")
    full = spark.sparkContext.broadcast((64, b"\xff" * 8))
    more = phrases.entries(phrases.merged(phrases.phrase_stripes(read, full, wide, 16), wide.least))
    counts = Counter()
    for _, text, _ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.replace("THE", "the")):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts.update(" ".join(words[i : i + k]) for k in (3, 4) for i in range(len(words) - k + 1))
    assert {r["phrase"]: r["a"] for r in more.collect()} == {p: n for p, n in counts.items() if n >= 3}
    assert rows_of(phrases.collocations(docs, tight)) == rows_of(phrases.collocations(docs, wide))


def test_words_of_a_text():
    words = phrases.Words()
    words.add("en", ["Ab\tc, D".encode(), b"", "é.\n\x0b!?Z".encode()])
    stream, langs = words.stream()
    known = list(words.number)
    assert [known[i].decode() if i else "|" for i in stream] == ["ab", "c", "|", "d", "|", "é", "|", "z", "|"] and set(langs) == {0}
    assert pa.array(known[1:]).cast(pa.string()).to_pylist() == ["ab", "c", "d", "é", "z"]
