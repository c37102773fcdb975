"""The registered queries: held-out accuracy, SQL, and the pipeline against its stages."""

from __future__ import annotations

import zlib

import pytest
from tests.oracle_check import compare, duck

import corpus_pipeline
from revisit.llm.oracles import ORACLES
from revisit.llm.queries import REGISTRY


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_operators_and_the_pipeline():
    import __spark_entry__

    names = {n.split("_")[0] for n in __spark_entry__.queries() if n.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in __spark_entry__.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf_dir, con, name):
    assert compare(REGISTRY[name](spark, sf_dir), con.execute(ORACLES[name])) is None


@pytest.mark.parametrize(("name", "column", "modulus", "rest", "limit"), [("op3_windowed_recurrent_toxicity", "toxic", 3, 1, 0.7), ("op7_rule_ensemble", "quality", 5, 0, 0.3)])
def test_held_out_accuracy(spark, con, name, column, modulus, rest, limit):
    sf_dir = "/root/testdata/sf0.1"
    labels = dict(duck(sf_dir).execute(f"SELECT doc_id, {column} FROM labels").fetchall())
    rows = REGISTRY[name](spark, sf_dir).collect()
    assert len(rows) == duck(sf_dir).execute("SELECT count(*) FROM documents").fetchone()[0]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == rest)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= limit)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held) > 0.95
    # Of the rare class, toxic or bad, most are found; of the other, few are taken for it.
    rare = 1 if column == "toxic" else 0
    of = {y: [r["predicted"] == rare for r in held if (labels[r["doc_id"]] == rare) == y] for y in (True, False)}
    assert sum(of[True]) >= 0.8 * len(of[True]) > 0 and sum(of[False]) <= 0.02 * len(of[False])


def test_pipeline_stages(spark, sf_dir, con):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    from revisit.llm.common import materialise

    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
        counts.append(docs.count())
        if name != "pack":
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "suffix_array_dedup", "source_mix", "pack"]
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    want = con.execute(f"SELECT count(*) FROM ({ORACLES['op8_distribution_divergence']}) WHERE kept").fetchone()[0]
    assert counts[1] == want


def stages(docs, spark, sf_dir, folder):
    """Each stage's rows, written and read again as the next one's."""
    out = []
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def test_pipeline_on_edge_documents(spark, clashing, sf_dir, tmp_path):
    *kept, packed = stages(clashing, spark, sf_dir, tmp_path)
    given = {r["doc_id"]: r for r in clashing.collect()}
    for docs in kept:
        assert docs.columns == clashing.columns
        extra = [c for c in clashing.columns if c not in ("doc_id", "text", "n_chars")]
        assert all([r[c] for c in extra] == [given[r["doc_id"]][c] for c in extra] for r in docs.collect())
    first, near, cut, _ = (d.collect() for d in kept)
    assert {r["doc_id"] for r in first} >= {r["doc_id"] for r in near} >= {r["doc_id"] for r in cut} != set()
    # The equal texts 0 and 4, the latter in three rows, leave the least id.
    assert sum(r["doc_id"] in (0, 4) for r in first) == 4 and [r["doc_id"] for r in near if r["doc_id"] in (0, 4)] == [0]
    assert all(r["text"] and r["text"] in given[r["doc_id"]]["text"] for r in near)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(packed.columns) and packed.count() > 0


def test_pipeline_on_an_empty_table(spark, none, sf_dir, tmp_path):
    for docs in stages(none, spark, sf_dir, tmp_path):
        assert docs.isEmpty()


def test_a_stage_removes_the_scratch_of_those_before(spark, docs, sf_dir, tmp_path):
    from pathlib import Path

    from revisit.session import shared_dir

    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = set(shared.glob("llm-*"))
    got = stages(docs, spark, sf_dir, tmp_path)
    left = {p.name.split("-")[1] for p in set(shared.glob("llm-*")) - before}
    assert left <= {"pack"} and all(d.count() >= 0 for d in got)


def test_every_operator_has_sql_or_a_test_of_its_own():
    from pathlib import Path

    modules = {"op1": "token_planes", "op2": "packing", "op3": "toxicity", "op5": "simhash", "op6": "dartminhash", "op7": "rule_ensemble", "op10": "suffix_dedup"}
    without = {name.split("_")[0] for name in REGISTRY} - {name.split("_")[0] for name in ORACLES}
    assert without == set(modules) and all((Path(__file__).parent / f"test_{m}.py").exists() for m in modules.values())
