"""Reversible line dedup: cuckoo filters by shard in front of exact reference counts of lines.

A line's key is the line without white space at its ends, A-Z lower-cased, as a 128-bit hash. The index has two
written tables:

- the reference counts: of each key the number of documents that hold it, and the largest id among them;
- one cuckoo filter for each shard of the keys, with a fingerprint of every key that `documents` documents and
  more hold. A fingerprint can be taken out again, which a Bloom filter does not allow.

`insert` adds documents' references to the counts, and the keys that come to the limit to their shard's filter;
`remove` takes references back, and fingerprints out where a key falls below the limit. Only what crosses the limit
touches a filter; a shard that gets too full is built anew, of twice the size, from its counts. So removing what was
inserted gives the index as it was. Each step writes a new version and leaves the old one.

`marked` asks the filters which lines may be repeated. What they let through, true repeats and a few others, is looked
up in the exact counts; the rest of the lines never leave their row. The filters are broadcast if all of them together
have at most `most_bytes`, which is measured; beyond that every long line is looked up, with the same result.

Skew: a line with a third of all references is summed within batches and before the shuffle, so that it is one row
of each task; looking it up is a join of many rows with one, which Spark splits. Shards grow with the documents.

Defined results: a null or empty text is one empty line; kept, null stays null, and a text whose lines all go becomes
empty. A row is a document: repeated rows count each, and with the largest id all keep the line, as do rows without an
id if no holder has one; a null id is smaller than any. Long texts are read whole. Ties can't occur: a key has one
largest id. Empty tables give an empty index and result. Other columns stay as they are; added ones avoid their names.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from revisit.llm.common import col, fresh, materialise

_SPACES = b" \t\n\x0b\x0c\r"
_COUNTS = "hi bigint, lo bigint, n bigint, largest bigint"
_FILTERS = "shard int, room bigint, bits binary"


@dataclass(frozen=True)
class Rules:
    """least: code points of a key. documents: holders from which a key's lines go. load: of a filter. most_bytes: of all filters, to be broadcast."""

    least: int = 20
    documents: int = 3
    load: float = 0.8
    most_bytes: int = 64 << 20


def line_keys(text: bytes, least: int) -> list[bytes | None]:
    """The key of each line; None for those that are too short."""
    out: list[bytes | None] = []
    for line in text.split(b"\n"):
        line = line.strip(_SPACES)
        size = len(line)
        if size < least or (size < 4 * least and len(line.decode()) < least):
            out.append(None)
        else:
            out.append(xxh3_128_digest(line.lower()))  # bytes: A-Z only
    return out


def _halves(keys: Iterable[bytes]) -> np.ndarray:
    """Keys as lines of two longs."""
    return np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)


def _mix(x: np.ndarray) -> np.ndarray:
    """64 well mixed bits of 64 bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Cuckoo:
    """Buckets of four 16-bit fingerprints; each key has two buckets. Whole arrays of keys are handled at once.

    Keys are 64-bit numbers. Whatever finds no place after many moves is kept in `rest`, as a fingerprint with a bucket.
    """

    def __init__(self, buckets: int, data: np.ndarray | None = None, rest: np.ndarray | None = None):
        self.buckets = buckets
        self.data = np.zeros((buckets, 4), np.uint16) if data is None else data
        self.rest = np.zeros((0, 2), np.int64) if rest is None else rest

    @classmethod
    def of_size(cls, keys: int, load: float) -> Cuckoo:
        """Room for so many keys."""
        return cls(1 << max(4, math.ceil(math.log2(max(keys, 1) / (4 * load)))))

    @property
    def room(self) -> int:
        return 4 * self.buckets

    def __len__(self) -> int:
        return int(np.count_nonzero(self.data)) + len(self.rest)

    def _marks(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = _mix(keys.astype(np.int64).view(np.uint64))
        return (mixed >> np.uint64(48)).astype(np.int64) % 65535 + 1, (mixed & np.uint64(self.buckets - 1)).astype(np.int64)

    def _other(self, mark: np.ndarray, at: np.ndarray) -> np.ndarray:
        return at ^ (_mix(mark.astype(np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def insert(self, keys: np.ndarray, rounds: int = 500) -> None:
        """One fingerprint more for each key. In each round a bucket takes one, in a free place or for another, which moves on."""
        mark, at = self._marks(keys)
        mark, at = self._placed(mark, at)
        at = self._other(mark, at)
        for turn in range(rounds):
            if not len(mark):
                return
            mark, at = self._placed(mark, at)
            if not len(mark):
                return
            _, chosen = np.unique(at, return_index=True)
            out = self.data[at[chosen], turn % 4].astype(np.int64)
            self.data[at[chosen], turn % 4] = mark[chosen]
            mark[chosen], at[chosen] = out, self._other(out, at[chosen])
        self.rest = np.concatenate([self.rest, np.stack([mark, at], axis=1)])

    def _placed(self, mark: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What finds no free place in its bucket."""
        full = np.zeros(len(mark), bool)
        while not full.all():
            waiting = np.flatnonzero(~full)
            _, chosen = np.unique(at[waiting], return_index=True)
            chosen = waiting[chosen]
            free = self.data[at[chosen]] == 0
            can = free.any(axis=1)
            self.data[at[chosen[can]], free[can].argmax(axis=1)] = mark[chosen[can]]
            full[chosen[~can]] = True
            keep = np.ones(len(mark), bool)
            keep[chosen[can]] = False
            mark, at, full = mark[keep], at[keep], full[keep]
        return mark, at

    def delete(self, keys: np.ndarray) -> None:
        """One fingerprint less for each key; each must have been inserted."""
        mark, at = self._marks(keys)
        for _ in range(2):
            none = np.zeros(len(mark), bool)
            while not none.all():
                waiting = np.flatnonzero(~none)
                _, chosen = np.unique(at[waiting], return_index=True)
                chosen = waiting[chosen]
                same = self.data[at[chosen]] == mark[chosen, None]
                has = same.any(axis=1)
                self.data[at[chosen[has]], same[has].argmax(axis=1)] = 0
                none[chosen[~has]] = True
                keep = np.ones(len(mark), bool)
                keep[chosen[has]] = False
                mark, at, none = mark[keep], at[keep], none[keep]
            at = self._other(mark, at)
        for m, a in zip(mark, at):
            either = (self.rest[:, 0] == m) & ((self.rest[:, 1] == a) | (self.rest[:, 1] == self._other(np.array([m]), np.array([a]))[0]))
            self.rest = np.delete(self.rest, np.flatnonzero(either)[:1], axis=0)

    def test(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be among those inserted."""
        mark, at = self._marks(keys)
        other = self._other(mark, at)
        found = (self.data[at] == mark[:, None]).any(axis=1) | (self.data[other] == mark[:, None]).any(axis=1)
        for m, a in self.rest:
            found |= (mark == m) & ((at == a) | (other == a))
        return found

    def to_bytes(self) -> bytes:
        return np.array([self.buckets, len(self.rest)], np.int64).tobytes() + self.rest.tobytes() + self.data.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Cuckoo:
        buckets, rest = np.frombuffer(data, np.int64, 2)
        end = 16 + 16 * int(rest)
        return cls(int(buckets), np.frombuffer(data, np.uint16, offset=end).reshape(-1, 4).copy(), np.frombuffer(data[16:end], np.int64).reshape(-1, 2).copy())


def references(docs: DataFrame, doc_id: str, text: str, least: int) -> DataFrame:
    """hi, lo, n, largest: the keys of the documents, with the number of documents and the largest id."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            texts = batch.column(1).cast(pa.binary())
            for i in range(batch.num_rows):
                value = texts[i].as_py()
                if value:
                    own = {k for k in line_keys(value, least) if k is not None}
                    keys += own
                    rows += [i] * len(own)
            if not keys:
                continue
            ids = batch.column(0).take(pa.array(rows))
            halves = _halves(keys)
            found = pa.table({"hi": halves[:, 0], "lo": halves[:, 1], "id": ids}).group_by(["hi", "lo"]).aggregate([([], "count_all"), ("id", "max")])
            yield from found.select(["hi", "lo", "count_all", "id_max"]).rename_columns(["hi", "lo", "n", "largest"]).to_batches()

    read = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    return read.mapInArrow(of, _COUNTS).groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.max("largest").alias("largest"))


@dataclass(frozen=True)
class LineIndex:
    """A version of the index: counts (hi, lo, n, largest), filters (shard, bits)."""

    counts: DataFrame
    filters: DataFrame
    shards: int
    rules: Rules = Rules()
    doc_id: str = "doc_id"
    text: str = "text"

    @classmethod
    def empty(cls, spark: SparkSession, documents: int = 0, rules: Rules = Rules(), doc_id: str = "doc_id", text: str = "text") -> LineIndex:
        """An index without lines, in shards for about so many documents."""
        shards = 64
        while shards * 100_000 < documents:
            shards *= 2
        return cls(spark.createDataFrame([], _COUNTS), spark.createDataFrame([], _FILTERS), shards, rules, doc_id, text)

    def _references(self, docs: DataFrame) -> DataFrame:
        return references(docs, self.doc_id, self.text, self.rules.least)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with the documents' lines as well."""
        new = self._references(docs).select("*", F.lit(0).cast("long").alias("before"))
        old = self.counts.select("*", F.col("n").alias("before"))
        both = old.unionByName(new).groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.max("largest").alias("largest"), F.sum("before").alias("before"))
        return self._next(materialise(both, "lines-counts"))

    def remove(self, docs: DataFrame, remaining: DataFrame) -> LineIndex:
        """The index without the documents, which must have been inserted; remaining: all others.

        Where the largest holder of a key goes, the next is found among the remaining documents.
        """
        gone = self._references(docs).toDF("hi", "lo", "lost", "lost_largest")
        left = F.col("n") - F.coalesce("lost", F.lit(0))
        changed = F.col("lost").isNotNull() & F.col("largest").eqNullSafe(F.col("lost_largest")) & (left > 0)
        both = self.counts.join(gone, ["hi", "lo"], "left").select("hi", "lo", left.alias("n"), "largest", F.col("n").alias("before"), changed.alias("changed"))
        both = materialise(both, "lines-left")
        again = both.filter("changed").select("hi", "lo")
        found = self._references(remaining).join(again, ["hi", "lo"], "left_semi").select("hi", "lo", F.col("largest").alias("next"))
        largest = F.when(F.col("changed"), F.col("next")).otherwise(F.col("largest")).alias("largest")
        out = both.join(found, ["hi", "lo"], "left").select("hi", "lo", "n", largest, "before")
        return self._next(materialise(out, "lines-counts"))

    def _next(self, both: DataFrame) -> LineIndex:
        """The next version, from counts with those before; rows without references are on their way out."""
        limit = self.rules.documents
        shard = F.col("lo").bitwiseAND(F.lit(self.shards - 1)).cast("int")
        keys = both.select(shard.alias("shard"), "hi", "n", "before")
        # A row a shard at most comes to the driver.
        needed = {r["shard"]: r["n"] for r in keys.filter(F.col("n") >= limit).groupBy("shard").agg(F.count("*").alias("n")).collect()}
        rooms = {r["shard"]: r["room"] for r in self.filters.select("shard", "room").collect()}
        load = self.rules.load
        tight = [s for s, n in needed.items() if n > load * rooms.get(s, 0)]
        anew = F.col("shard").isin(tight) if tight else F.lit(False)
        rise, fall = (F.col("n") >= limit) & (F.col("before") < limit), (F.col("n") < limit) & (F.col("before") >= limit)
        change = F.when(anew, F.when(F.col("n") >= limit, 1)).otherwise(F.when(rise, 1).when(fall, -1))
        changes = keys.select("shard", "hi", change.alias("change")).filter("change is not null")
        rebuilt = frozenset(tight)

        def turned(own: pa.Table, changes: pa.Table) -> pa.Table:
            shard = (own if len(own) else changes).column("shard")[0].as_py()
            hi, change = changes.column("hi").to_numpy(), changes.column("change").to_numpy()
            # Room for twice as many as there are, if it is built anew.
            cuckoo = Cuckoo.of_size(2 * len(hi), load) if shard in rebuilt or not len(own) else Cuckoo.from_bytes(own.column("bits")[0].as_py())
            cuckoo.delete(hi[change < 0])
            cuckoo.insert(hi[change > 0])
            return pa.table({"shard": pa.array([shard], pa.int32()), "room": pa.array([cuckoo.room], pa.int64()), "bits": pa.array([cuckoo.to_bytes()], pa.binary())})

        filters = self.filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(turned, _FILTERS)
        return replace(self, counts=both.filter("n > 0").drop("before"), filters=materialise(filters, "lines-filters"))

    def repeated(self) -> DataFrame:
        """hi, lo, largest: the keys whose lines go, but for those of the largest id."""
        return self.counts.filter(F.col("n") >= self.rules.documents).select("hi", "lo", "largest")

    def _filter(self, spark: SparkSession) -> tuple[str, Broadcast] | None:
        """All filters, broadcast, with a name of their own, or None if they are too large for that."""
        size = self.filters.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]
        if size > self.rules.most_bytes:
            return None
        return uuid.uuid4().hex, spark.sparkContext.broadcast({r["shard"]: bytes(r["bits"]) for r in self.filters.collect()})

    def marked(self, docs: DataFrame, into: str) -> DataFrame:
        """The documents with the keys of the lines that may be repeated: an array of (hi, lo)."""
        least, shards, given = self.rules.least, self.shards, self._filter(docs.sparkSession)

        @F.arrow_udf("array<struct<hi:bigint,lo:bigint>>")
        def keys(texts: pa.Array) -> pa.Array:
            own = [{k for k in line_keys(t, least) if k is not None} if t else () for t in texts.cast(pa.binary()).to_pylist()]
            sizes = np.array([len(k) for k in own], np.int64)
            halves = _halves(k for some in own for k in some)
            if given is not None:
                keep = _tested(given, halves, shards)
                sizes = np.bincount(np.repeat(np.arange(len(own)), sizes)[keep], minlength=len(own))
                halves = halves[keep]
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=["hi", "lo"]))

        return docs.withColumn(into, keys(col(self.text)))

    def kept(self, docs: DataFrame, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
        """The documents, which the index holds, without repeated lines; and their numbers of lines before, and dropped."""
        row, hits, gone, new = fresh(docs, "_row", "_hits", "_gone", "_new")
        # One written copy ties each row's text to its number.
        marked = materialise(self.marked(docs, hits).withColumn(row, F.monotonically_increasing_id()), "lines-marked")
        each = marked.select(col(row).alias("row"), col(self.doc_id).cast("long").alias("id"), F.explode(col(hits)).alias("k")).select("row", "id", "k.hi", "k.lo")
        verdict = each.join(self.repeated(), ["hi", "lo"]).filter(~F.col("id").eqNullSafe(F.col("largest")))
        verdict = verdict.groupBy("row").agg(F.collect_list(F.struct("hi", "lo")).alias("gone")).toDF(row, gone)
        open_ = marked.filter(F.size(col(hits)) > 0).join(verdict, row, "left")
        least = self.rules.least

        @F.arrow_udf("struct<text:string,n:bigint>")
        def without(texts: pa.Array, gone: pa.Array) -> pa.Array:
            out, dropped = [], []
            for value, keys in zip(texts.cast(pa.binary()).to_pylist(), gone.to_pylist()):
                away = {k.tobytes() for k in np.array([(x["hi"], x["lo"]) for x in keys], "<i8")}
                lines = value.split(b"\n")
                stay = [line for line, key in zip(lines, line_keys(value, least)) if key not in away]
                out.append(b"\n".join(stay))
                dropped.append(len(lines) - len(stay))
            return pa.StructArray.from_arrays([pa.array(out, pa.binary()).cast(pa.string()), pa.array(dropped, pa.int64())], names=["text", "n"])

        changed = open_.filter(col(gone).isNotNull()).withColumn(new, without(col(self.text), col(gone)))
        same = open_.filter(col(gone).isNull()).drop(gone).unionByName(marked.filter(F.size(col(hits)) == 0))
        same = same.withColumn(new, F.struct(col(self.text).alias("text"), F.lit(0).cast("long").alias("n")))
        text = F.coalesce(col(self.text), F.lit(""))
        lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
        columns = [col(new)["text"].alias(c) if c == self.text else col(c) for c in docs.columns]
        return changed.drop(gone).unionByName(same).select(*columns, lines.alias(n_lines), col(new)["n"].alias(n_dropped))


_opened: dict[str, dict[int, Cuckoo]] = {}


def _tested(given: tuple[str, Broadcast], halves: np.ndarray, shards: int) -> np.ndarray:
    """Which keys the filters let through; a worker opens those of one index at a time, once."""
    name, filters = given
    if name not in _opened:
        _opened.clear()
        _opened[name] = {s: Cuckoo.from_bytes(b) for s, b in filters.value.items()}
    opened, out = _opened[name], np.zeros(len(halves), bool)
    shard = halves[:, 1] & (shards - 1)
    for s, some in _runs(shard, np.argsort(shard, kind="stable")):
        if s in opened:
            out[some] = opened[s].test(halves[some, 0])
    return out


def _runs(values: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value with the places that hold it."""
    if len(order):
        ordered = values[order]
        cuts = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
        yield from ((int(values[part[0]]), part) for part in np.split(order, cuts))


def line_report(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of each document, the index holding just these."""
    index = LineIndex.empty(docs.sparkSession, docs.count(), rules).insert(docs)
    kept = index.kept(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
