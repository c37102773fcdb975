"""Token ids in binary files of bit planes.

A file holds the ids of documents in order. The ids are cut into blocks of fixed size; a block is transposed
into planes (plane b holds bit b, or byte b, of each id), each plane is compressed with zstandard (or kept as
a single byte if it is constant) and a chunk index at the end says where each block's planes lie, with the
block's crc32. The file's documents (doc_id, first id, number of ids) lie there too, compressed.

    magic | planes of block 0 | planes of block 1 ... | index (zstandard over JSON and arrays) | index length | magic

Each task writes one file, under a name of its own attempt, to the folder that all machines share; the files
that count are those in the manifest table, which Spark writes when all tasks have ended. The manifest also
holds the number of ids before each file. A document may span blocks, but not files.

Null texts are empty: one end id. Repeated rows are documents of their own; equal doc_ids are put in order
of text. An empty table gives an empty manifest.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revisit.llm.common import col, scratch_path
from revisit.llm.tokens import column_texts, encoder

MAGIC = b"IDPLANE1"


@dataclass(frozen=True)
class Layout:
    """planes: "bits" or "bytes". block: ids in a block, a multiple of 8."""

    block: int = 65536
    planes: str = "bits"
    level: int = 3


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """The planes of some ids, lowest bit or byte first. ids: of a little-endian unsigned type."""
    rows = ids.view(np.uint8).reshape(len(ids), ids.dtype.itemsize)
    columns = [np.ascontiguousarray(rows[:, i]) for i in range(rows.shape[1])]
    if planes == "bytes":
        return [x.tobytes() for x in columns]
    return [np.packbits(x & np.uint8(1 << b), bitorder="little").tobytes() for x in columns for b in range(8)]


def from_planes(stored: list[bytes], n: int, dtype: np.dtype, planes: str) -> np.ndarray:
    rows = np.zeros((n, dtype.itemsize), np.uint8)
    for i in range(dtype.itemsize):
        if planes == "bytes":
            rows[:, i] = np.frombuffer(stored[i], np.uint8)
            continue
        column = np.zeros(n, np.uint8)
        for b, plane in enumerate(stored[8 * i : 8 * i + 8]):
            column |= np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little", count=n) << np.uint8(b)
        rows[:, i] = column
    return rows.view(dtype).reshape(n)


class Writer:
    """Writes ids to an open binary file."""

    def __init__(self, out, dtype: np.dtype, layout: Layout):
        import zstandard

        self.out, self.dtype, self.layout = out, dtype, layout
        self.zstd = zstandard.ZstdCompressor(level=layout.level)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.chunks: list[list] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.at = out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.layout.block:
            all_ids = np.concatenate(self.waiting)
            full = len(all_ids) // self.layout.block * self.layout.block
            for i in range(0, full, self.layout.block):
                self._block(all_ids[i : i + self.layout.block])
            self.waiting, self.n_waiting = [all_ids[full:].copy()], len(all_ids) - full

    def _block(self, ids: np.ndarray) -> None:
        sizes, first = [], self.at
        for plane in to_planes(np.ascontiguousarray(ids), self.layout.planes):
            stored = plane[:1] if plane == plane[:1] * len(plane) else self.zstd.compress(plane)
            if len(stored) == 1:
                sizes.append(-1)
            else:
                sizes.append(len(stored))
            self.at += self.out.write(stored)
        self.chunks.append([first, len(ids), zlib.crc32(ids.tobytes()), sizes])

    def close(self) -> None:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        nulls = [i for i, x in enumerate(self.doc_ids) if x is None]
        head = {"dtype": self.dtype.str, "planes": self.layout.planes, "ids": self.n_ids, "docs": len(self.doc_ids), "nulls": nulls, "chunks": self.chunks}
        text = json.dumps(head).encode()
        docs = np.array([x or 0 for x in self.doc_ids], "<i8").tobytes() + np.array(self.lengths, "<i8").tobytes()
        index = self.zstd.compress(struct.pack("<Q", len(text)) + text + docs)
        self.out.write(index + struct.pack("<Q", len(index)) + MAGIC)


class Reader:
    """Reads a file that can seek."""

    def __init__(self, file, size: int):
        import zstandard

        self.file, self.zstd = file, zstandard.ZstdDecompressor()
        file.seek(size - 16)
        tail = file.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a whole file of id planes")
        n = struct.unpack("<Q", tail[:8])[0]
        file.seek(size - 16 - n)
        index = self.zstd.decompress(file.read(n))
        m = struct.unpack("<Q", index[:8])[0]
        self.head = json.loads(index[8 : 8 + m])
        docs = np.frombuffer(index[8 + m :], "<i8").reshape(2, self.head["docs"])
        self.doc_ids, self.lengths = docs
        self.dtype = np.dtype(self.head["dtype"])

    def block(self, k: int) -> np.ndarray:
        first, n, crc, sizes = self.head["chunks"][k]
        plane_bytes = n if self.head["planes"] == "bytes" else (n + 7) // 8
        self.file.seek(first)
        data, at, planes = self.file.read(sum(max(s, 1) for s in sizes)), 0, []
        for s in sizes:
            part = data[at : at + max(s, 1)]
            planes.append(part * plane_bytes if s < 0 else self.zstd.decompress(part))
            at += max(s, 1)
        ids = from_planes(planes, n, self.dtype, self.head["planes"])
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"block {k} is damaged")
        return ids

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, first id and ids of each document, block by block."""
        nulls, left, k, start = set(self.head["nulls"]), np.empty(0, self.dtype), 0, 0
        for i, (doc_id, n) in enumerate(zip(self.doc_ids.tolist(), self.lengths.tolist())):
            if len(left) < n:
                parts, have = [left], len(left)
                while have < n:
                    parts.append(self.block(k))
                    have += len(parts[-1])
                    k += 1
                left = np.concatenate(parts)
            yield (None if i in nulls else doc_id), start, left[:n]
            left, start = left[n:], start + n


def write_planes(docs: DataFrame, path: str, tokenizer: str, spaced: bool = True, end_id: int = 2, layout: Layout = Layout()) -> DataFrame:
    """Write all documents (doc_id, text) in ascending doc_id order below a new path; returns the manifest.

    Manifest: part, file, n_ids, n_docs, start (ids in all files before).
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part = encoder(tokenizer, spaced), TaskContext.get().partitionId()
        end = np.array([end_id], enc.dtype)
        file = out = writer = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                file = f"{path}/files/part-{part:06d}-{uuid.uuid4().hex}.planes"
                fs, at = _filesystem(file)
                fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                out = fs.open_output_stream(at)
                writer = Writer(out, enc.dtype, layout)
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode(column_texts(batch.column(1)))):
                writer.add(doc_id, np.concatenate([ids, end]))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": file, "n_ids": writer.n_ids, "n_docs": len(writer.doc_ids)}])

    ordered = docs.select(col("doc_id"), col("text")).repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    written = ordered.mapInArrow(run, "part long, file string, n_ids long, n_docs long")
    written.write.parquet(f"{path}/written")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.parquet(f"{path}/written").withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    manifest.write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_planes(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (little-endian unsigned 32-bit, binary) of each document; a file is one task's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "ids"]
        for batch in batches:
            for row in batch.to_pylist():
                fs, at = _filesystem(row["file"])
                rows, size = [], 0
                with fs.open_input_file(at) as file:
                    for doc_id, start, ids in Reader(file, file.size()).documents():
                        rows.append((doc_id, row["start"] + start, ids.astype("<u4").tobytes()))
                        size += 4 * len(ids)
                        if size > 4 << 20 or len(rows) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], names)

    manifest = spark.read.parquet(f"{path}/manifest").select("file", "start")
    n = max(1, manifest.count())
    return manifest.repartitionByRange(n, "start").mapInArrow(run, "doc_id long, start long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, layout: Layout = Layout()) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of all documents, read back from the files."""
    spark = docs.sparkSession
    path = scratch_path(spark, "planes")
    write_planes(docs, path, tokenizer, layout=layout)
    return read_planes(spark, path).select("doc_id", "start", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").cast("long").alias("ids_crc32"))
