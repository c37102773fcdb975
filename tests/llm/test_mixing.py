from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from revisit.llm import mixing as mx


def fill(sizes, mix):
    """Targets by giving the excess of full sources to the others, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(names)}
    total, full = mix.share * sum(sizes.values()), set()
    while True:
        rest = total - sum(mix.max_repeats * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        target = {s: mix.max_repeats * sizes[s] if s in full else rest * weight[s] / w for s in names}
        over = {s for s in names if s not in full and target[s] > mix.max_repeats * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.fixture()
def sizes(spark, tmp_path):
    rows = [(i, i // 2 * 2, ["b", "a", None, "c", "d", "ä", "zero"][i * i % 7], 0 if i * i % 7 == 6 or i % 13 == 0 else (i * 37) % 500 + (20_000 if i == 50 else 0)) for i in range(900)]
    spark.createDataFrame(rows, "row long, doc_id long, source string, size long").write.parquet(str(tmp_path / "s"))
    return spark.read.parquet(str(tmp_path / "s"))


@pytest.mark.parametrize("mix", [mx.Mix(block=64, bucket_digits=1, slots_together=50), mx.Mix(weights=(1, 30, 2), block=7, slots_together=1000), mx.Mix(weights=(100, 1), block=512), mx.Mix(max_repeats=3, share=2.5)])
def test_sources_reach_their_targets(sizes, mix):
    by_source = {r["source"]: r["n"] for r in sizes.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    want = fill(by_source, mix)
    goals, schedule = mx.mixed(sizes, mix)
    goals = {r["k"]: r for r in goals.collect()}
    for g in goals.values():
        assert g["target"] == pytest.approx(want[g["source"]]) and abs(g["goal"] - g["target"]) <= 0.5
    rows, size = schedule.collect(), {r["row"]: r["size"] for r in sizes.collect()}
    taken, words = {}, {}
    for r in rows:
        taken[r["k"]] = taken.get(r["k"], 0) + r["high"] - r["low"]
        words.setdefault(r["row"], []).append((r["repeat"], r["low"], r["high"]))
    assert all(taken.get(k, 0) == g["goal"] for k, g in goals.items())
    for row, parts in words.items():
        at = {}
        for repeat, low, high in sorted(parts):
            assert low == at.get(repeat, 0) and low < high <= size[row]
            at[repeat] = high
    blocks = {(r["slot"], r["k"], r["block"]) for r in rows}
    slots = sorted(b[0] for b in blocks)
    assert slots == list(range(len(slots)))
    # Each source's blocks come in order of slots, and any stretch of the schedule holds its share of each source.
    for k, g in goals.items():
        mine = sorted((b[0], b[2]) for b in blocks if b[1] == k)
        assert [b for _, b in mine] == list(range(len(mine)))
        for n in (len(slots) // 3, len(slots) // 2):
            assert abs(sum(s < n for s, _ in mine) - len(mine) * n / max(1, len(slots))) < 4


def test_reruns_agree(sizes):
    one, two = (sorted(map(tuple, mx.mixed(sizes, mx.Mix(block=64))[1].collect())) for _ in range(2))
    assert one == two


def test_documents_and_report(docs, clashing, none):
    for some in (docs, clashing):
        report = mx.mix_report(some).collect()
        assert len(report) == docs.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in report)
        by = {}
        for r in report:
            by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
        assert all(abs(sum(v) - k[1]) <= 0.5 for k, v in by.items())
        out = mx.mix_documents(some)
        assert out.columns == some.columns
        rows = out.select("doc_id", "text", "n_chars").collect()
        assert sum(len(r["text"].encode().split()) for r in rows) == sum(r["taken"] for r in report)
        texts = {}
        for r in docs.collect():
            texts.setdefault(r["doc_id"], []).append(r["text"] or "")
        assert all(any(t.strip(" \n\t").startswith(r["text"].strip(" \n\t")) for t in texts[r["doc_id"]]) for r in rows)
    assert mx.mix_report(none).collect() == [] and mx.mix_documents(none).collect() == []


def test_first_words(spark):
    rows = spark.createDataFrame([("  a  b\nc d ", 2), ("a b", 1), ("é ü x", 2)], "t string, n long")
    assert [r[0] for r in rows.select(mx.first_words(F.col("t"), F.col("n"))).collect()] == ["a  b", "a", "é ü"]


def test_no_python_in_the_plan(docs):
    plan = mx.mix_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
