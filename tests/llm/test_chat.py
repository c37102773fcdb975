from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from revisit.llm import chat
from revisit.llm.common import materialise

HARD = ["\\### Assistant: </turn> ok", "####", "a\\", "</turn></turn>\n", "### user: x", "\\\\</turn\\>", "", "é😀", "#\\#", "<\\/turn>"]


def test_escapes_come_back(spark):
    rows = spark.createDataFrame([(x,) for x in HARD], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in rows.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"] and "</turn>" not in r["e"] and "###" not in r["e"]


def messages(spark, rows):
    return spark.createDataFrame(rows, "tree long, message long, parent long, role string, text string, score double")


@pytest.fixture()
def trees(spark):
    rows = [
        (1, 1, None, "user", "root", 0.0), (1, 2, 1, "assistant", "good", 5.0), (1, 3, 1, "assistant", "bad", 1.0), (1, 4, 2, "user", "more", 0.0), (1, 5, 2, "user", "other", 1.0),
        (2, 1, None, "user", "alone", None), (3, 1, 2, "user", "cycle", 1.0), (3, 2, 1, "user", "cycle", 1.0), (4, 7, 99, None, None, 1.0), (None, 1, None, "user", "null tree", 0.0), (None, 2, 1, "assistant", "yes", 0.0),
    ]
    rows += [(5, i, i - 1 if i else None, "user" if i % 2 == 0 else "assistant", f"t{i}", 0.0) for i in range(37)]
    return messages(spark, rows)


def brute(rows):
    by = {(r["tree"], r["message"]): r for r in rows}
    parents = {(r["tree"], r["parent"]) for r in rows if r["parent"] is not None and (r["tree"], r["parent"]) in by}
    out = {}
    for key, r in by.items():
        if key not in parents:
            path = [r]
            while (path[0]["tree"], path[0]["parent"]) in by:
                path.insert(0, by[path[0]["tree"], path[0]["parent"]])
            out[key] = path
    return out


def test_paths_and_ranks(trees):
    want = brute(trees.collect())
    got = chat.formatted(trees).withColumn("whole", chat.text_of(F.col("segments"))).collect()
    assert {(r["tree"], r["leaf"]) for r in got} == set(want)
    for r in got:
        path = want[r["tree"], r["leaf"]]
        assert r["n_turns"] == len(path) and r["score"] == sum(x["score"] or 0 for x in path)
        assert r["whole"] == "".join(f"### {x['role'] or ''}: {x['text'] or ''}</turn>\n" for x in path)
    assert {r["leaf"]: r["rank"] for r in got if r["tree"] == 1} == {5: 1, 4: 2, 3: 3}
    assert [r["leaf"] for r in chat.formatted(trees, max_branches=1).collect() if r["tree"] == 1] == [5]


def test_conversations_come_back(spark):
    rows = [(i % 5, (i // 5) % 9, ["user", "assistant", "system", "a:b\n", None][i % 5 if i % 7 else 1], HARD[i % len(HARD)] if i % 11 else None) for i in range(60)]
    rows += [(7, 0, "user", "same"), (7, 0, "user", "same"), (8, None, "assistant", "null turn"), (None, 0, "assistant", "null id"), (9, 0, "user", "long " * 60_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("message", F.lit(3)).withColumn("tree", F.lit(4))
    got = {r["conv_id"]: r for r in chat.digests(materialise(chat.formatted(chat.chain(turns)), "t")).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        mine = sorted(mine, key=lambda m: (not m[0], m[1:]))
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in mine)
        loss = "".join(x for _, _, r, x in mine if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(mine), sha256(whole.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha256(loss.encode()).hexdigest())


def test_no_python_in_the_plan(trees):
    plan = chat.digests(materialise(chat.formatted(trees), "t"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert chat.formatted(messages(spark, [])).collect() == []
