from __future__ import annotations

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from revisit.llm import token_planes as tp

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("planes", ["bits", "bytes"])
@pytest.mark.parametrize("dtype", ["<u2", "<u4"])
def test_planes_and_files_round_trip(planes, dtype):
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 50_000, n).astype(dtype) for n in (0, 1, 7, 8, 63, 64, 65, 1000, 0, 3)] + [np.full(200, 9, dtype)]
    file = io.BytesIO()
    writer = tp.Writer(file, np.dtype(dtype), tp.Layout(block=64, planes=planes))
    for i, ids in enumerate(docs):
        writer.add(None if i == 3 else i - 5, ids)
    writer.close()
    reader = tp.Reader(file, file.tell())
    start = 0
    for i, (doc_id, at, ids) in enumerate(reader.documents()):
        assert doc_id == (None if i == 3 else i - 5) and at == start and ids.tolist() == docs[i].tolist()
        start += len(ids)
    assert start == sum(map(len, docs)) and len(reader.head["chunks"]) == -(-start // 64)


@pytest.mark.parametrize("dtype", ["<u2", "<u4"])
def test_plane_b_holds_bit_b(dtype):
    ids = np.random.default_rng(2).integers(0, 60_000, 77).astype(dtype)
    planes = tp.to_planes(ids, "bits")
    assert len(planes) == 8 * ids.dtype.itemsize
    for b, plane in enumerate(planes):
        assert plane == bytes(sum((int(x) >> b & 1) << i for i, x in enumerate(ids[lo : lo + 8])) for lo in range(0, 77, 8))
    assert tp.from_planes(planes, 77, ids.dtype, "bits").tolist() == ids.tolist()


def test_damage_is_found():
    file = io.BytesIO()
    writer = tp.Writer(file, np.dtype("<u2"), tp.Layout(block=64, planes="bytes", level=1))
    writer.add(1, np.random.default_rng(1).integers(0, 60000, 64).astype("<u2"))
    writer.close()
    data = bytearray(file.getvalue())
    first, _, _, sizes = tp.Reader(io.BytesIO(data), len(data)).head["chunks"][0]
    data[first + sizes[0] - 6] ^= 255
    with pytest.raises(Exception):
        tp.Reader(io.BytesIO(data), len(data)).block(0)
    with pytest.raises(ValueError):
        tp.Reader(io.BytesIO(data[:-1]), len(data) - 1)


def expected(rows):
    plain = Tokenizer.from_file(PATH)
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_all_documents_come_back(docs, clashing, none):
    for some in (docs, clashing):
        got = sorted((tuple(r) for r in tp.round_trip(some, PATH, tp.Layout(block=512)).collect()), key=lambda r: r[1])
        assert got == expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert tp.round_trip(none, PATH).collect() == []
