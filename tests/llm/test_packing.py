from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from revisit.llm import packing as pk
from revisit.llm.tokens import Encoder, Room

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_combinations_fill_the_window():
    found = pk.combinations(12, 3)
    want = {(a, b, c) for a in range(13) for b in range(a + 1) for c in range(b + 1) if a + b + c == 12}
    assert {tuple((*w, 0, 0)[:3]) for w in found} == want and len(found) == len(set(found))


def test_least_squares_meets_its_conditions():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = rng.random((8, 15)), rng.standard_normal(8)
        x = pk.nnls(a, b)
        gain = a.T @ (b - a @ x)
        assert (x >= 0).all() and gain.max() < 1e-6 and abs(gain[x > 0]).max(initial=0) < 1e-6


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=16, max_size=16))
def test_a_plan_uses_what_is_there(counts):
    used = np.zeros(16, int)
    for way, n in pk.plan(np.array(counts), 3):
        assert sum(way) == 16 and n > 0
        for x in way:
            used[x - 1] += n
    assert (used <= counts).all()


def check(rows, texts, window):
    plain = Tokenizer.from_file(PATH)
    ids = {}
    for doc_id, text in texts:
        ids.setdefault(doc_id, []).append(np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for doc_id, pieces in by_doc.items():
        assert sum(p["length"] for p in pieces) == sum(map(len, ids[doc_id]))
        for p in pieces:
            assert any(len(x) == p["doc_tokens"] and zlib.crc32(x[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"] for x in ids[doc_id])
        if len(ids[doc_id]) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p["start"]):
                assert p["start"] == at
                at += p["length"]
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window
    return by_sequence


def test_pieces_are_exact(docs, clashing, none):
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    small = pk.Packing(window=256, grain=16, buckets=4)
    for some in (docs, clashing):
        check(pk.pack_report(some, PATH, small).collect(), texts, 256)
    assert pk.pack_report(none, PATH).collect() == []


def test_little_padding(spark, tmp_path):
    lengths = spark.range(6000).selectExpr("id as row", "1 + pmod(xxhash64(id), 1500) + if(id % 40 = 0, 5000, 0) as n_tokens")
    lengths.write.parquet(str(tmp_path / "l"))
    lengths = spark.read.parquet(str(tmp_path / "l"))
    rows = pk.packed(lengths).collect()
    total, sequences = sum(r["length"] for r in rows), {r["sequence_id"] for r in rows}
    assert total == lengths.groupBy().sum("n_tokens").first()[0]
    assert 2048 * len(sequences) < 1.02 * total
    whole = {}
    for r in rows:
        whole.setdefault(r["row"], []).append((r["start"], r["length"]))
    for pieces in whole.values():
        at = 0
        for start, n in sorted(pieces):
            assert start == at
            at += n


@pytest.mark.parametrize("ids", [True])
def test_ids_on_request(docs, ids):
    for r in pk.pack_report(docs, PATH, ids=ids).collect():
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]


def test_places_need_no_python_workers_of_their_own(spark, tmp_path, monkeypatch):
    spark.range(3000).selectExpr("id as row", "1 + pmod(xxhash64(id), 3000) as n_tokens").write.parquet(str(tmp_path / "l"))
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda *a, **b: pytest.fail("rows went through Python"))
    lengths = spark.read.parquet(str(tmp_path / "l"))
    assert pk.packed(lengths).groupBy().sum("length").first() == lengths.groupBy().sum("n_tokens").first()
    short = lengths.selectExpr("row", "1L as n_tokens").limit(3).localCheckpoint()
    assert sorted(tuple(r)[1:] for r in pk.packed(short).collect()) == [(0, 1, 0, 0), (0, 1, 0, 1), (0, 1, 0, 2)]


def test_the_pipelines_encoders_are_small(docs, monkeypatch):
    seen, plain = [], pk.encoded
    monkeypatch.setattr(pk, "encoded", lambda *a: seen.append(a[-1]) or plain(*a))
    corpus_pipeline.STAGES[-1][1](docs.sparkSession, docs, "").count()
    (room,) = seen
    # Mostly words that stand once, as in large corpora.
    rng = np.random.default_rng(5)
    words = rng.integers(97, 123, (300_000, 7), np.uint8).view("S7").ravel().astype(str)
    texts = [" ".join(words[lo : lo + 500]) for lo in range(0, len(words), 500)]

    def held(room):
        enc, ids = Encoder(PATH, False, room.most), []
        tracemalloc.start()
        try:
            for x in enc.encode(texts, room.together):
                ids.append(zlib.crc32(x.tobytes()))
            return ids, tracemalloc.get_traced_memory()[1] / 2**20
        finally:
            tracemalloc.stop()

    (large, much), (small, little) = held(Room()), held(room)
    assert small == large and little < 60 < much, (little, much)
