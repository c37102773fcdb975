from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from revisit.llm import hashing
from revisit.llm.tokens import Encoder, _dealt, column_texts


@pytest.fixture(scope="module", params=[("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def pair(request):
    path = public_tokenizers.path(request.param[0])
    plain = Tokenizer.from_file(path)
    return Encoder(path, request.param[1], most=2000), plain


def test_pieces_give_the_library_ids(pair, texts):
    mine, plain = pair
    for _ in range(2):
        for t, ids in zip(texts, mine.encode(texts)):
            assert ids.tolist() == plain.encode(t or "", add_special_tokens=False).ids


ODD = "ab AB.,'s \n\t́ ​\x1c\x85　é1٣漢😀İΣς"


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(alphabet=ODD, max_size=40), st.text(max_size=30)))
def test_pieces_of_any_text(text):
    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        mine, plain = _ENCODERS[name]
        assert next(mine.encode([text])).tolist() == plain.encode(text, add_special_tokens=False).ids


def _load(name, spaced):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    return Encoder(path, spaced), plain


_ENCODERS = {"byte_bpe_50k.json": _load("byte_bpe_50k.json", True), "word_bpe_49k.json": _load("word_bpe_49k.json", False)}


@settings(max_examples=100, deadline=None)
@given(some=st.lists(st.one_of(st.none(), st.text(alphabet="ab c\n\tdé", max_size=40)), max_size=6))
def test_runs_are_those_of_the_words(some):
    hashes, owner = hashing.runs(*hashing.word_hashes(*hashing.text_bytes(pa.array(some, pa.string()))), 3)
    key = {}
    for i, text in enumerate(some):
        words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        mine = hashes[owner == i].tolist()
        want = [tuple(words[j : j + 3]) for j in range(max(1, len(words) - 2))] if words else []
        assert len(mine) == len(want)
        for h, w in zip(mine, want):
            assert key.setdefault(w, h) == h
    assert len(set(key.values())) == len(key)


def test_a_sliced_array_keeps_its_texts():
    array = pa.array(["zz", "a b", None, "c"])
    data, offsets = hashing.text_bytes(array.slice(1))
    assert bytes(data) == b"a bc" and offsets.tolist() == [0, 3, 3, 4]
    assert np.diff(hashing.word_hashes(data, offsets)[1]).tolist() == [2, 0, 1]


SPECIAL = ["hello <|endoftext|>", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>c", "<|startoftext|> <|endoftext|>.", "<|ENDOFTEXT|> x", "<|endoftext", "\n<|endoftext|>\n", "x <|endoftext|>| y"]


def test_strings_of_special_tokens(pair):
    """They become the tokens, as with the library's defaults."""
    mine, plain = pair
    for some in (SPECIAL, SPECIAL[::-1], [" ".join(SPECIAL)] * 2):
        for text, ids in zip(some, mine.encode(some)):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_files_that_cut_in_another_way_are_given_whole_texts(tmp_path, texts):
    import json

    for name, spaced, change in (("byte_bpe_50k.json", True, {"add_prefix_space": True}), ("word_bpe_49k.json", False, None)):
        file = json.loads(open(public_tokenizers.path(name), encoding="utf-8").read())
        if change:
            file["pre_tokenizer"] |= change
        else:
            file["normalizer"] = {"type": "Lowercase"}
        path = str(tmp_path / name)
        with open(path, "w", encoding="utf-8") as out:
            json.dump(file, out)
        mine, plain = Encoder(path, spaced), Tokenizer.from_file(path)
        assert not mine.by_pieces
        for text, ids in zip(texts, mine.encode(texts)):
            assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids
    assert Encoder(public_tokenizers.path("byte_bpe_50k.json"), True).by_pieces and Encoder(public_tokenizers.path("word_bpe_49k.json"), False).by_pieces


@pytest.mark.parametrize("most", [1, 7, 200, 5000])
def test_least_hashed_ids(spark, most):
    from pyspark.sql import functions as F

    from revisit.llm.common import least_hashed

    ids = spark.range(-300, 700).withColumnRenamed("id", "a.b")
    want = [tuple(r) for r in spark.range(-300, 700).select(F.xxhash64("id"), "id").collect()]
    assert least_hashed(ids, "a.b", most) == sorted(want)[:most]
    assert least_hashed(ids.limit(0), "a.b", most) == []


class Counted(dict):
    """A table that counts how often it is asked."""

    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)


def test_a_part_is_looked_up_once_in_a_group_of_texts(pair):
    """Not once for each time it occurs, nor for each mark behind it."""
    mine, plain = pair
    mine.known, mine.old = Counted(), {}
    some = [f"word other{mark} word{mark} again\nother{mark} word" for mark in (".", ",", "?!")] * 50
    for _ in range(2):
        mine.known.asked = 0
        for text, ids in zip(some, mine.encode(some)):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
        assert mine.known.asked < 15
    assert not any(key[0].isalpha() and key[-1] in ".,!" for key in mine.known)


@settings(max_examples=150, deadline=None)
@given(some=st.lists(st.one_of(st.none(), st.text(alphabet=ODD, max_size=15), st.text(alphabet="ab .,\n<é'", max_size=30), st.sampled_from(SPECIAL)), max_size=8), together=st.sampled_from([1, 150, 1 << 20]))
def test_groups_of_texts_of_all_kinds(some, together):
    for mine, plain in _ENCODERS.values():
        assert [x.tolist() for x in mine.encode(some, together)] == [plain.encode(x or "", add_special_tokens=False).ids for x in some]


@pytest.mark.parametrize("step", [1, 3, 100])
def test_ids_are_dealt_in_steps(step):
    ids, n = np.arange(7, dtype="<u2"), np.array([2, 0, 4, 1])
    codes = np.array([3, 1, 0, 1, 2, 2, 0, 1], np.int32)
    got, ends = _dealt(ids, n, codes, step)
    assert got.tolist() == [6, 0, 1, 2, 3, 4, 5, 2, 3, 4, 5, 0, 1] and got.dtype == ids.dtype and ends.tolist() == [1, 1, 3, 3, 7, 11, 13, 13]
    assert [len(x) for x in _dealt(ids, n, codes[:0], step)] == [0, 0]


def test_a_columns_texts():
    for kind in (pa.string(), pa.large_string()):
        assert list(column_texts(pa.array(["z", "a", None, "", "é"], kind).slice(1), rows=2)) == ["a", None, "", "é"]
    assert list(column_texts(pa.array([], pa.string()))) == []
