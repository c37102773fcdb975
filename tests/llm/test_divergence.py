from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from revisit.llm import divergence as dv
from tests.llm.conftest import prose


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    return len({j for i, w in enumerate(windows) if counts[w] > 1 for j in (i, i + 1, i + 2)})


def base(text):
    t, words = text or "", words_of(text)
    lines = [x for x in t.split("\n") if words_of(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), repeated(words)


def test_base_counts(docs, clashing, none):
    want = sorted((str(r["doc_id"]), *base(r["text"])) for r in docs.collect())
    for some in (docs, clashing):
        measured, verdict = dv.judged(some)
        got = measured.select("doc_id", *(F.col(verdict)[x] for x in dv.BASE)).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == want
    assert dv.judged(none)[0].collect() == []


def test_repeated_words_by_each_way(spark):
    texts = ["a b c a b c", "a a a a a a", "a b c d", "x y z " * 400, " ".join(f"{i} {i + 1} {i}" for i in range(200)) * 2, "a b", "", prose(1, 2000), prose(1, 500) + " " + prose(1, 500)]
    texts.append(" ".join(prose(2, 400).split()[:30] + ["p q r s t u v p q r s"]))
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    words = F.filter(F.split("t", r"\s+"), lambda w: w != "")
    for r in rows.select("t", dv.repeat_words(words).alias("n")).collect():
        assert r["n"] == repeated(words_of(r["t"])), r["t"][:50]


def test_distance(spark):
    cases = [([1.0, 2.0, 3.0], [3.0, 2.0, 1.0]), ([1.0, 0.0], [0.0, 1.0]), ([5.0, 5.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])]
    rows = spark.createDataFrame(cases, "p array<double>, q array<double>")
    for (p, q), r in zip(cases, rows.select(dv.js_distance(F.col("p"), F.col("q")).alias("d")).collect()):
        if not sum(p):
            assert r["d"] is None
            continue
        x, y = [a / sum(p) for a in p], [b / sum(q) for b in q]
        kl = lambda u, m: sum(a * math.log2(a / b) for a, b in zip(u, m) if a)
        m = [(a + b) / 2 for a, b in zip(x, y)]
        assert abs(r["d"] - math.sqrt((kl(x, m) + kl(y, m)) / 2)) < 1e-12


def test_odd_texts_go_and_short_ones_are_not_judged_by_histograms(spark):
    rows = [(i, prose(i, 300), "en") for i in range(40)]
    rows += [(100, prose(50, 300).upper(), "en"), (101, " ".join(w + "$$$" for w in prose(51, 300).split()), "en"), (102, "abc " * 30, "en"), (103, "ABC DEF", None)]
    measured, verdict = dv.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {r["doc_id"]: r[verdict] for r in measured.collect()}
    assert all(got[i]["kept"] for i in range(40))
    assert not got[100]["kept"] and not got[101]["kept"] and not got[102]["kept"]
    assert got[103]["class_distance"] is None and got[103]["word_distance"] is None
    kept = dv.quality_filter(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert kept.columns == ["doc_id", "text", "lang"] and kept.count() == 40


def test_no_python_in_the_plan(docs):
    plan = dv.statistics(docs, dv.Limits(), "text", "lang", "s")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
