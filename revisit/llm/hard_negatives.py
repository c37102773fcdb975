"""Hard negatives by segment summaries: bounds from means and deviations spare exact scores.

Each vector is cut into equal segments; the mean and the deviation of every segment are stored with it. Within a
segment of length L, the inner product of two vectors is L (mean * mean) plus that of their centred parts, which lies
within L (deviation * deviation) of zero. Summed over segments this bounds the score. `refined` starts with few
long segments, drops the pairs whose bounds cannot reach what certain pairs already show, and goes on with shorter
segments for the rest, down to the exact score of what is left. Coarser summaries follow from the stored finest ones.

The stated queries, the anchors, meet all rows in blocks: rows are dealt by hash to parts, anchors to sides, and one
task takes one side of one part, both of bounded size. It returns its first few of each anchor; a window ranks those.
So a label, a vector or an id with a third of all rows is spread like any other. First the positives of all anchors are
found, then, with the scores that they set, the negatives of each. Nothing is sampled and no row is left out; where
bounds say nothing, as for vectors without structure, all scores are computed, by matrix products.

Defined results: rows with a null label or vector, or a null or not finite component (also one that is too large when
scaled), take no part. A row without an id is never an anchor and comes after the others of its score, as null. Shorter
vectors count as filled up with zeros. Repeated rows are rows of their own: each anchor among them has its results, and
is the other's positive; ties go by id, equal ids by row. An anchor without positives or negatives has no row; an empty
table gives none. Scores are exact whole numbers; those beyond 64 bits are ordered exactly and shown as the largest or
least long. Scaled components beyond 1e17 count as 1e17. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revisit.llm.common import col, materialise

_STORED = "row bigint, id bigint, label bigint, vector binary, segments binary, most double"
_FOUND = "anchor bigint, place int, score {}, lost int, id bigint, row bigint"
_SCORES = {"double": ("bigint", pa.int64()), "long": ("bigint", pa.int64()), "object": ("decimal(38,0)", pa.decimal128(38, 0))}
_LARGEST = 1e17


@dataclass(frozen=True)
class Mining:
    """positives, negatives: how many of each. low, high: per cent of the positive's score that a negative may have.

    levels: segments of a vector, from coarse to fine. rows_least, rows_most: rows of a part. anchors: anchors of a side.
    """

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: int = 256
    levels: tuple[int, ...] = (4, 16)
    rows_least: int = 1024
    rows_most: int = 65_536
    anchors: int = 2048
    pairs_together: int = 1 << 20


def summaries(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of each vector."""
    cut = vectors.reshape(len(vectors), segments, -1)
    return cut.mean(axis=2), cut.std(axis=2)


def coarser(mean: np.ndarray, deviation: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The summaries of fewer segments, from those of more."""
    mean, deviation = (x.reshape(len(x), segments, -1) for x in (mean, deviation))
    middle = mean.mean(axis=2)
    return middle, np.sqrt((deviation**2 + (mean - middle[:, :, None]) ** 2).mean(axis=2))


class Block:
    """Some rows with their stored summaries, in order of (id, row), rows without an id last."""

    def __init__(self, table: pa.Table, mining: Mining):
        ids = table.column("id").combine_chunks()
        self.lost = np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy()
        self.rows = table.column("row").to_numpy()
        order = np.lexsort((self.rows, self.ids, self.lost))
        self.lost, self.ids, self.rows = self.lost[order], self.ids[order], self.rows[order]
        self.labels = table.column("label").to_numpy()[order]
        self.vectors = _matrix(table.column("vector"))[order]
        fine = mining.levels[-1]
        stored = _matrix(table.column("segments"))[order]
        mean, deviation = stored[:, :fine], stored[:, fine:]
        self.levels = [coarser(mean, deviation, m) for m in mining.levels[:-1]] + [(mean, deviation)]
        self.lengths = np.linalg.norm(self.vectors, axis=1)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def bounds(a: Block, some: slice, b: Block, level: int, pairs: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest scores that summaries allow: of all anchors of the slice with all rows, or of some pairs."""
    (am, ad), (bm, bd) = a.levels[level], b.levels[level]
    am, ad, length = am[some], ad[some], a.vectors.shape[1] / am.shape[1]
    slack = 1e-9  # for rounding
    if pairs is None:
        middle, radius = length * (am @ bm.T), length * (ad @ bd.T)
        radius += slack * np.outer(a.lengths[some], b.lengths) + 1e-6
    else:
        i, j = pairs
        middle, radius = length * np.einsum("ij,ij->i", am[i], bm[j]), length * np.einsum("ij,ij->i", ad[i], bd[j])
        radius += slack * a.lengths[some][i] * b.lengths[j] + 1e-6
    return middle - radius, middle + radius


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """Of each line, as a column; -inf where there are fewer."""
    if values.shape[1] < k:
        return np.full((len(values), 1), -np.inf)
    return np.partition(values, -k, axis=1)[:, -k, None]


#: What is still open after a look at bounds: (least, largest, open) -> open.
Keep = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def refined(a: Block, some: slice, b: Block, open_: np.ndarray, keep: Keep, mining: Mining) -> np.ndarray:
    """The pairs that no level of segments rules out."""
    least = np.full(open_.shape, -np.inf)
    largest = np.full(open_.shape, np.inf)
    for level in range(len(mining.levels)):
        if not open_.any():
            break
        if open_.mean() > 1 / 8:
            low, high = bounds(a, some, b, level)
            np.maximum(least, low, out=least)
            np.minimum(largest, high, out=largest)
        else:
            pairs = np.nonzero(open_)
            low, high = bounds(a, some, b, level, pairs)
            least[pairs], largest[pairs] = np.maximum(least[pairs], low), np.minimum(largest[pairs], high)
        open_ = keep(least, largest, open_)
    return open_


def scores(a: Block, some: slice, b: Block, open_: np.ndarray, kind: str) -> np.ndarray:
    """Exact scores where open, as whole numbers: doubles if they hold them, longs or objects otherwise."""
    x, y = a.vectors[some], b.vectors
    if kind == "object":
        whole = lambda m: np.array([[int(v) for v in line] for line in m], object).reshape(m.shape)
        return whole(x) @ whole(y).T
    if kind == "long":
        x, y = x.astype(np.int64), y.astype(np.int64)
    if open_.mean() > 1 / 16:
        return x @ y.T
    out = np.zeros(open_.shape, x.dtype)
    pairs = np.nonzero(open_)
    out[pairs] = np.einsum("ij,ij->i", x[pairs[0]], y[pairs[1]])
    return out


def first(found: np.ndarray, open_: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of each line's k highest scores among the open ones; equal scores go by column."""
    if found.dtype != object and open_.shape[1] > k:
        limit = kth_largest(np.where(open_, found.astype(np.float64), -np.inf), k)
        open_ = open_ & (found.astype(np.float64) >= limit)
    i, j = np.nonzero(open_)
    values = found[i, j]
    order = sorted(range(len(i)), key=lambda p: (i[p], -values[p], j[p])) if found.dtype == object else np.lexsort((j, -values, i))
    i, j = i[order], j[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    return i[place < k], j[place < k]


def _slices(n: int, rows: int, mining: Mining) -> Iterator[slice]:
    step = max(1, mining.pairs_together // max(rows, 1))
    return (slice(at, min(at + step, n)) for at in range(0, n, step))


def _found(a: Block, b: Block, parts: list[tuple], kind: str) -> pa.Table:
    """Rows of _FOUND from (anchors, places, rows, scores)."""
    if not parts:
        return _nothing(kind)
    i, place, j, value = (np.concatenate([p[k] for p in parts]) for k in range(4))
    value = [Decimal(int(v)) for v in value] if kind == "object" else value.astype(np.int64)
    return pa.table({"anchor": a.rows[i], "place": place.astype(np.int32), "score": pa.array(value, _SCORES[kind][1]), "lost": b.lost[j].astype(np.int32), "id": b.ids[j], "row": b.rows[j]})


def _nothing(kind: str) -> pa.Table:
    kinds = {"anchor": pa.int64(), "place": pa.int32(), "score": _SCORES[kind][1], "lost": pa.int32(), "id": pa.int64(), "row": pa.int64()}
    return pa.table({name: pa.array([], of) for name, of in kinds.items()})


def positives_of(a: Block, b: Block, kind: str, mining: Mining) -> pa.Table:
    """Of each anchor the first rows of its label in a part, other than itself."""
    k, out = mining.positives, []

    def keep(least: np.ndarray, largest: np.ndarray, open_: np.ndarray) -> np.ndarray:
        return open_ & (largest >= kth_largest(np.where(open_, least, -np.inf), k))

    for some in _slices(len(a.rows), len(b.rows), mining):
        open_ = (a.labels[some, None] == b.labels) & (a.rows[some, None] != b.rows)
        if kind != "object":
            open_ = refined(a, some, b, open_, keep, mining)
        found = scores(a, some, b, open_, kind)
        i, j = first(found, open_, k)
        out.append((i + some.start, np.zeros(len(i)), j, found[i, j]))
    return _found(a, b, out, kind)


def negatives_of(a: Block, b: Block, wanted: dict[int, list], kind: str, mining: Mining) -> pa.Table:
    """Of each anchor and positive the first rows of other labels in a part with scores in its range. wanted: positives' scores by anchor row."""
    k, out = mining.negatives, []
    lists = [wanted.get(int(r)) or [] for r in a.rows]
    width = max(map(len, lists), default=0)
    whole = object if kind == "object" else np.int64 if kind == "long" else np.float64
    low, high = np.ones((len(lists), width), whole), np.zeros((len(lists), width), whole)  # an empty range where there are fewer
    for r, values in enumerate(lists):
        for w, p in enumerate(map(int, values)):
            low[r, w], high[r, w] = -(-mining.low * p // 100), mining.high * p // 100

    for some in _slices(len(a.rows), len(b.rows), mining):

        lo, hi = low[some].astype(np.float64), high[some].astype(np.float64)
        valid = lo <= hi
        from_, to = np.where(valid, lo, np.inf).min(axis=1, initial=np.inf)[:, None], np.where(valid, hi, -np.inf).max(axis=1, initial=-np.inf)[:, None]
        widest = (hi - lo).max(initial=-1)

        def keep(least: np.ndarray, largest: np.ndarray, open_: np.ndarray) -> np.ndarray:
            open_ = open_ & (largest >= from_) & (least <= to)
            if (largest - least).min(initial=np.inf) > widest:
                return open_  # nothing can be certain
            any_ = np.zeros_like(open_)
            for w in range(width):
                begin, end = lo[:, w, None], hi[:, w, None]
                certain = open_ & (least >= begin) & (largest <= end)
                if certain.any():
                    begin = np.maximum(begin, kth_largest(np.where(certain, least, -np.inf), k))
                any_ |= valid[:, w, None] & (largest >= begin) & (least <= end)
            return open_ & any_

        open_ = a.labels[some, None] != b.labels
        if kind != "object":
            open_ = refined(a, some, b, open_, keep, mining)
        if not open_.any():
            continue
        found = scores(a, some, b, open_, kind)
        for w in range(width):
            i, j = first(found, open_ & (found >= low[some, w, None]) & (found <= high[some, w, None]), k)
            out.append((i + some.start, np.full(len(i), w), j, found[i, j]))
    return _found(a, b, out, kind)


def stored(rows: DataFrame, mining: Mining, id_: str, label: str, vector: str) -> DataFrame:
    """A written table of the rows that take part: row, id, label, vector (doubles), segments (means, then deviations), most."""
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= 1.7976931348623157e308 / mining.scale))
    taking = rows.select(F.monotonically_increasing_id().alias("row"), col(id_).cast("long").alias("id"), col(label).cast("long").alias("label"), col(vector).cast("array<double>").alias("vector"))
    taking = taking.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & whole)
    fine = mining.levels[-1]
    longest = taking.agg(F.max(F.size("vector"))).first()[0] or 1
    width = math.ceil(longest / fine) * fine

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, n = batch.column(3), batch.num_rows
            if not n:
                continue
            lengths = lists.value_lengths().to_numpy()
            vectors = np.zeros((n, width))
            vectors[np.arange(width) < lengths[:, None]] = np.clip(np.floor(mining.scale * lists.flatten().to_numpy()), -_LARGEST, _LARGEST)
            segments = np.hstack(summaries(vectors, fine))
            binary = lambda m: pa.array([line.tobytes() for line in m], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], binary(vectors), binary(segments), pa.array(np.abs(vectors).max(axis=1))], names=["row", "id", "label", "vector", "segments", "most"])

    return materialise(taking.mapInArrow(of, _STORED), "negatives-vectors")


def _arithmetic(vectors: DataFrame, mining: Mining) -> str:
    """double, long or object: what holds all scores exactly, and the ends of their ranges."""
    most, size = vectors.agg(F.max("most"), F.max(F.octet_length("vector"))).first()
    reach = (int(most or 0) ** 2) * ((size or 0) // 8)
    return "double" if reach < 2**53 else "long" if reach * max(100, mining.low, mining.high) < 2**62 else "object"


def _part(rows: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(rows), F.lit(n)).cast("int")


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k of each key, with their rank."""
    order = (F.col("score").desc(), "lost", "id", "row")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Callable[[Column], Column], mining: Mining = Mining(), id_: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. anchor: which ids are anchors."""
    vectors = stored(rows, mining, id_, label, vector)
    kind = _arithmetic(vectors, mining)
    anchors = materialise(vectors.filter(F.col("id").isNotNull() & anchor(F.col("id"))), "negatives-anchors")
    n, queries = vectors.count(), anchors.count()
    part = min(max(mining.rows_least, n // 64), mining.rows_most)
    parts, sides = max(1, math.ceil(n / part)), max(1, math.ceil(queries / mining.anchors))
    dealt = vectors.drop("most").withColumn("part", _part(F.col("row"), parts)).withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(sides - 1))))
    met = anchors.drop("most").withColumn("side", _part(F.col("row"), sides)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    block, found = ["side", "part"], _FOUND.format(_SCORES[kind][0])

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        return positives_of(Block(left, mining), Block(right, mining), kind, mining) if len(left) and len(right) else _nothing(kind)

    positives = met.groupBy(*block).cogroup(dealt.groupBy(*block)).applyInArrow(find_positives, found)
    positives = materialise(_best(positives, ["anchor"], mining.positives), "negatives-positives")
    wanted = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("wanted"))
    with_wanted = anchors.drop("most").join(wanted.select(F.col("anchor").alias("row"), F.col("wanted.score").alias("wanted")), "row")
    met = with_wanted.withColumn("side", _part(F.col("row"), sides)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _nothing(kind)
        ranges = dict(zip(left.column("row").to_pylist(), left.column("wanted").to_pylist()))
        return negatives_of(Block(left, mining), Block(right, mining), ranges, kind, mining)

    negatives = met.groupBy(*block).cogroup(dealt.groupBy(*block)).applyInArrow(find_negatives, found)
    negatives = _best(negatives, ["anchor", "place"], mining.negatives)
    named = lambda name: F.when(F.col("lost") == 0, F.col("id")).alias(name)
    score = F.expr("cast(greatest(least(score, 9223372036854775807), -9223372036854775808) as bigint)")
    return (
        negatives.select("anchor", (F.col("place") + 1).alias("nth"), F.col("rank").cast("int").alias("rank"), named("negative_id"), score.alias("negative_score"))
        .join(positives.select("anchor", F.col("rank").alias("nth"), named("positive_id"), score.alias("positive_score")), ["anchor", "nth"])
        .join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
