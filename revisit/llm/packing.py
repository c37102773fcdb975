"""Packing documents into windows by non-negative least squares over length combinations.

Documents are cut into full windows and a rest. Lengths are rounded up to `grain`; all combinations of up to
`depth` lengths that fill a window are enumerated, and non-negative least squares finds how often to repeat
each so that the lengths used match the histogram. Counts are rounded down and cut to what is there. The
pieces of a length, ranked by hash, take the places that the combinations have for it. What is left over is
packed greedily: laid end to end, each next window is filled to the brim, cutting the piece at its end.

Only the histogram, at most `window` numbers, comes to the driver. Padding is under `grain` for each piece of a
combination, half of it on average, and one window's at the end. Ranks and sums are made in two levels, so no
task holds all pieces of a length.

Null texts are empty: one end id. Repeated rows are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revisit.llm.common import col, materialise, row_slices, running
from revisit.llm.tokens import Room, column_texts, encoder


@dataclass(frozen=True)
class Packing:
    """grain must divide window. buckets: into how many a length's pieces are spread for ranking."""

    window: int = 2048
    grain: int = 16
    depth: int = 3
    buckets: int = 256


def combinations(full: int, depth: int) -> list[tuple[int, ...]]:
    """All ways to write `full` as a sum of at most `depth` whole numbers, largest first."""

    def of(left: int, most: int, parts: int) -> Iterator[tuple[int, ...]]:
        if left == 0:
            yield ()
        elif parts:
            for x in range(min(left, most), 0, -1):
                if x * parts < left:
                    break
                yield from ((x, *rest) for rest in of(left - x, x, parts - 1))

    return list(of(full, full, depth))


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that makes |a x - b| least, by active sets."""
    n = a.shape[1]
    ata, atb = a.T @ a, a.T @ b
    x, active = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(atb).max(initial=0)))
    for _ in range(3 * n):
        gain = np.where(active, -np.inf, atb - ata @ x)
        k = int(gain.argmax())
        if gain[k] <= tolerance:
            break
        active[k] = True
        while True:
            at = np.flatnonzero(active)
            s = np.linalg.lstsq(ata[np.ix_(at, at)], atb[at], rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[at] = s
                break
            bad = s <= 0
            step = (x[at][bad] / np.maximum(x[at][bad] - s[bad], 1e-300)).min()
            x[at] += step * (s - x[at])
            active[at[(x[at] <= 1e-12 * max(1.0, x.max())) & bad]] = False
            x[~active] = 0
    return x


def plan(counts: np.ndarray, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations and how often to use each. counts[i]: pieces of rounded length i + 1; the last fills a window."""
    full = len(counts)
    ways = [w for w in combinations(full, depth) if all(counts[x - 1] for x in w)]
    if not ways:
        return []
    a = np.zeros((full, len(ways)))
    for j, way in enumerate(ways):
        for x in way:
            a[x - 1, j] += 1
    scale = max(1, counts.max())
    x = nnls(a, counts / scale) * scale
    left, out = counts.astype(np.int64).copy(), []
    for j in np.argsort(-x, kind="stable"):
        need = a[:, j].astype(np.int64)
        used = need > 0
        n = min(int(x[j]), int((left[used] // need[used]).min()))
        if n > 0:
            left -= n * need
            out.append((ways[j], n))
    return out


def encoded(docs: DataFrame, tokenizer: str, spaced: bool, end_id: int, room: Room = Room()) -> DataFrame:
    """A written table: row, doc_id, n_tokens, ids (of the encoder's type, as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, spaced, room.most)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            found = enc.encode(column_texts(batch.column(2)), room.together)
            for lo in range(0, batch.num_rows, 512):
                some = batch.slice(lo, 512)
                ids = [x.tobytes() + end for x in islice(found, some.num_rows)]
                n = pa.array([len(x) // enc.dtype.itemsize for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), n, pa.array(ids, pa.binary())], ["row", "doc_id", "n_tokens", "ids"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), col("doc_id").cast("long").alias("doc_id"), col("text").alias("text"))
    return materialise(rows.mapInArrow(run, "row long, doc_id long, n_tokens long, ids binary"), "pack-ids")


def packed(lengths: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """row, start, length, sequence_id, offset of each piece. lengths: row (unique), n_tokens; a written table."""
    spark, size, grain = lengths.sparkSession, packing.window, packing.grain
    pieces = lengths.select("row", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / size))).alias("k"))
    pieces = pieces.select("row", (F.col("k") * size).alias("start"), F.least(F.lit(size), F.col("n_tokens") - F.col("k") * size).alias("length"))
    pieces = pieces.withColumn("bin", F.ceil(F.col("length") / grain).cast("int"))
    counts = np.zeros(size // grain, np.int64)
    for r in pieces.groupBy("bin").count().collect():  # at most window / grain rows
        counts[r["bin"] - 1] = r["count"]
    chosen = plan(counts, packing.depth)
    taken, places, first = np.zeros(len(counts), np.int64), [], 0
    for way, n in chosen:
        for position, x in enumerate(way):
            places.append((x, int(taken[x - 1]), n, first, position))
            taken[x - 1] += n
        first += n
    # As an Arrow table: a list of rows would go through Python workers of their own, which stay beside the others.
    kinds = {"bin": pa.int32(), "base": pa.int64(), "n": pa.int64(), "first": pa.int64(), "position": pa.int32()}
    columns = zip(*places) if places else [()] * len(kinds)
    places = spark.createDataFrame(pa.table({k: pa.array(x, t) for (k, t), x in zip(kinds.items(), columns)}))
    bucket = F.pmod(F.xxhash64("row", "start"), F.lit(packing.buckets))
    ranked = materialise(running(pieces, ["bin"], bucket, ["row", "start"], F.lit(1).cast("long"), "rank"), "pack-ranks")
    used = [int(x) for x in taken]
    limit = F.element_at(F.array(*map(F.lit, used)).cast("array<bigint>"), F.col("bin"))
    # At most depth rows for each combination: a table bounded by the window and the depth.
    here = (ranked["bin"] == places["bin"]) & (F.col("rank") >= F.col("base")) & (F.col("rank") < F.col("base") + F.col("n"))
    placed = ranked.filter(F.col("rank") < limit).join(F.broadcast(places), here)
    placed = placed.select("row", "start", "length", (F.col("first") + F.col("rank") - F.col("base")).alias("sequence_id"), "position")
    before = Window.partitionBy("sequence_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select("row", "start", "length", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))
    rest = ranked.filter(F.col("rank") >= limit).select("row", "start", "length")
    rest = running(rest, [], bucket, ["row", "start"], F.col("length"), "at")
    window = F.explode(F.sequence(F.floor(F.col("at") / size), F.floor((F.col("at") + F.col("length") - 1) / size))).alias("w")
    rest = rest.select("row", "start", "length", "at", window)
    low, high = F.greatest("at", F.col("w") * size), F.least(F.col("at") + F.col("length"), (F.col("w") + 1) * size)
    rest = rest.select("row", (F.col("start") + low - F.col("at")).alias("start"), (high - low).alias("length"), (F.col("w") + first).alias("sequence_id"), (low - F.col("w") * size).alias("offset"))
    return placed.unionByName(rest)


def pack_report(docs: DataFrame, tokenizer: str, packing: Packing = Packing(), spaced: bool = False, end_id: int = 1, ids: bool = False, room: Room = Room()) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece of all documents (doc_id, text).

    ids adds the piece's ids, little-endian unsigned 32-bit. room: of the workers that encode.
    """
    tokens = encoded(docs, tokenizer, spaced, end_id, room)
    pieces = packed(tokens.select("row", "n_tokens"), packing)
    cuts = pieces.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("cuts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            out = []
            for doc_id, n, data, some in zip(*(c.to_pylist() for c in batch.columns)):
                wide = np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4")
                for c in some:
                    part = wide[c["start"] : c["start"] + c["length"]].tobytes()
                    out.append((doc_id, c["start"], c["length"], zlib.crc32(part), n, c["sequence_id"], c["offset"], *([part] * ids)))
            kinds = [pa.int64()] * 7 + [pa.binary()] * ids
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] * ids)]
            columns = zip(*out) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names)

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return tokens.join(cuts, "row").select("doc_id", "n_tokens", "ids", "cuts").mapInArrow(run, kind + ", ids binary" * ids)
