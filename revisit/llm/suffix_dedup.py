"""Removing passages that stand earlier, by two-stage suffix sorting.

Each byte covered by a `length`-byte string that also starts earlier (by doc_id, then place) goes. A document
is its UTF-8 bytes; matches stay inside documents and are judged on the input.

Equal strings are brought together by anchors: in each `length` bytes, the `gram` bytes of least hash, so
equal strings have the same anchor at the same place. What surrounds an anchor, as far as strings that hold
it reach, is its context.

1. Each task finds its documents' anchors. Of equal contexts it sends on the first; the others stand
   later than one with the same bytes, so all their bytes go, and a hot passage leaves each task once.
2. Anchors of one hash are sorted by context and place and read as a stream: of equal contexts, all
   but the first go whole. First contexts are kept only where an anchor has several.
3. Their bytes are fetched and cut into two segments, for strings that reach far to the left of the anchor and for the
   others. A segment's key holds the bytes that all its strings have around the anchor, so groups are
   small even where an anchor is common. Segments of one key lie side by side in a task, which takes them block by block
   (whole groups), sorts all suffixes of a block (suffix_sort) and finds by adjacent common prefixes
   which strings stand more than once.
   Keys with more segments than a block holds (a common passage shorter than a string, amid different text) are
   not grouped: their strings go by 128-bit hashes, of which each task sends on the first of a block, as in 1 and 2.
4. Spans are gathered by document and taken out.

Nulls are empty texts. Rows of one doc_id are put in order of text, equal rows in any order, of which the first
counts as earliest. A null doc_id comes first. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisit.llm.common import col, fresh, materialise, row_slices
from revisit.llm.hashing import mix, text_bytes
from revisit.llm.suffix_sort import common_prefixes, suffix_array, words_at


@dataclass(frozen=True)
class Repeats:
    """length: of strings. gram: bytes of an anchor, a multiple of 8. block: bytes of whole groups sorted at once; a larger group goes by hashes of its strings."""

    length: int = 100
    gram: int = 24
    block: int = 1 << 20
    together: int = 1 << 19

    @property
    def left(self) -> int:
        """How far strings that hold an anchor may begin before it."""
        return self.length - self.gram

    @property
    def group(self) -> int:
        """How many segments a block holds in any case."""
        return self.block // (self.length + self.left // 2)


# ------------------------------------------------------------ anchors


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each window of the given width, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors(data: np.ndarray, r: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a text's anchors: in each window, all grams of least hash."""
    n, width = len(data), r.left + 1
    if n < r.length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    words = words_at(data, 0)
    h = np.zeros(n - r.gram + 1, np.uint64)
    for i in range(0, r.gram, 8):
        h = (h ^ words[i : i + len(h)]) * np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
    h = (h * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    h ^= h >> np.uint64(32)
    least = _sliding(h, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    best = _sliding(np.concatenate([edge, least, edge]), width, np.maximum)
    at = np.flatnonzero(best == h)
    return at, h[at]


_MULTIPLIERS = mix(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)


def _contexts(data: np.ndarray, at: np.ndarray, r: Repeats) -> np.ndarray:
    """Hashes of the bytes from `left` before each anchor to `length` after it, ends of the text included."""
    reach = -(-(r.left + r.length) // 8) * 8
    words = words_at(np.concatenate([np.zeros(r.left, np.uint8), data, np.zeros(reach, np.uint8)]), 0)
    around = words[at[:, None] + np.arange(0, reach, 8)]
    # The last word may hold bytes beyond the context.
    over = reach - r.left - r.length
    around[:, -1] &= np.uint64(2**64 - (1 << (8 * over)))
    around ^= around >> np.uint64(31)
    around *= _MULTIPLIERS[: around.shape[1]]
    ends = (np.minimum(at, r.left) << 32 | np.minimum(len(data) - at, r.length)).astype(np.uint64)
    return mix(around.sum(axis=1, dtype=np.uint64) ^ mix(ends))


_ANCHOR = "h long, ctx long, doc long, tie int, at int, size int, gone boolean"


def _batch(columns, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


_ANCHOR_NAMES = ["h", "ctx", "doc", "tie", "at", "size", "gone"]


def _sent(parts: list[tuple], r: Repeats) -> Iterator[pa.RecordBatch]:
    """A task's anchors: of equal contexts the first, the others marked gone and dealt out by place."""
    if not parts:
        return
    h, ctx, doc, tie, at, size = (np.concatenate(x) for x in zip(*parts))
    both = mix(h) ^ ctx
    order = np.argsort(both, kind="stable")
    same = np.zeros(len(both), bool)
    same[1:] = both[order[1:]] == both[order[:-1]]
    tied = same.copy()
    tied[:-1] |= same[1:]
    some = order[tied]
    gone = np.zeros(len(both), bool)
    if len(some):
        sub = some[np.lexsort((at[some], tie[some], doc[some], both[some]))]
        late = np.zeros(len(sub), bool)
        late[1:] = both[sub[1:]] == both[sub[:-1]]
        gone[sub[late]] = True
    h = np.where(gone, mix(doc.view(np.uint64) ^ mix(at.astype(np.uint64))), h)
    columns = [h.view(np.int64), ctx.view(np.int64), doc, tie, at, size, gone]
    for lo in range(0, len(h), 1 << 16):
        yield _batch([c[lo : lo + (1 << 16)] for c in columns], _ANCHOR_NAMES)


def find_anchors(docs: DataFrame, r: Repeats) -> DataFrame:
    """All anchors of documents (doc, tie, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            doc, tie = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                at, h = anchors(data[a:b], r)
                if len(at):
                    m = len(at)
                    parts.append((h, _contexts(data[a:b], at, r), np.full(m, doc[i]), np.full(m, tie[i], np.int32), at.astype(np.int32), np.full(m, b - a, np.int32)))
                    n += m
                    if n >= r.together:
                        yield from _sent(parts, r)
                        parts, n = [], 0
        yield from _sent(parts, r)

    return docs.select("doc", "tie", "text").mapInArrow(run, _ANCHOR)


def repeated_anchors(found: DataFrame) -> DataFrame:
    """Of anchors sorted by hash, context and place: those whose context stands earlier (gone) and first contexts of anchors that have several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # hash and context of the row before
        head = None  # the first row of the last hash, as long as it wasn't sent
        for batch in batches:
            if not batch.num_rows:
                continue
            h, ctx, gone = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(6).to_numpy(zero_copy_only=False)
            new_h, new_ctx = np.ones(len(h), bool), np.ones(len(h), bool)
            new_h[1:] = h[1:] != h[:-1]
            if last is not None:
                new_h[0] = h[0] != last[0]
                new_ctx[0] = new_h[0] or ctx[0] != last[1]
            new_ctx[1:] = new_h[1:] | (ctx[1:] != ctx[:-1])
            late = ~new_ctx | gone
            another = new_ctx & ~new_h & ~gone
            wanted = late | another
            heads = np.maximum.accumulate(np.where(new_h, np.arange(len(h)), -1))
            of = np.unique(heads[another])
            if len(of) and of[0] < 0:
                if head is not None:
                    yield head
                    head = None
                of = of[1:]
            wanted[of] = True
            end = heads[-1]
            if end >= 0:
                head = None if wanted[end] else batch.slice(end, 1)
            last = (h[-1], ctx[-1])
            columns = [*batch.columns[:6], pa.array(late)]
            yield pa.RecordBatch.from_arrays(columns, _ANCHOR_NAMES).filter(pa.array(wanted))

    dealt = found.repartition("h").sortWithinPartitions("h", "ctx", "doc", "tie", "at")
    return dealt.mapInArrow(run, _ANCHOR)


# ------------------------------------------------------------ segments


def segments(texts: DataFrame, r: Repeats) -> DataFrame:
    """key, doc, tie, begin, bytes of the segments around anchors: texts has doc, tie, text and anchors (h, at)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = r.left // 2
        for batch in row_slices(batches):
            data, offsets = text_bytes(batch.column(2))
            out: list[tuple] = []
            for i, found in enumerate(batch.column(3).to_pylist()):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                doc, tie = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for x in found:
                    h, p = x["h"], x["at"]
                    # Strings that begin at least `half` before the anchor hold all of that; the others hold the rest after it.
                    cut = p - half
                    if cut >= 0:
                        lo, hi = max(0, p - r.left), min(len(text), cut + r.length)
                        if hi - lo >= r.length:
                            out.append((h, text[cut : p + r.gram], 0, doc, tie, lo, text[lo:hi]))
                    lo, hi, sure = max(0, cut + 1), min(len(text), p + r.length), cut + 1 + r.length
                    if hi - lo >= r.length:
                        out.append((h, text[p:sure], 1, doc, tie, lo, text[lo:hi]))
            if out:
                h, part, side, doc, tie, begin, content = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(_keys(h, part, side)), pa.array(doc, pa.int64()), pa.array(tie, pa.int32()), pa.array(begin, pa.int32()), pa.array(content, pa.binary())], ["key", "doc", "tie", "begin", "bytes"])

    return texts.select("doc", "tie", "text", "anchors").mapInArrow(run, "key long, doc long, tie int, begin int, bytes binary")


def _keys(h, part, side) -> np.ndarray:
    import xxhash

    sub = np.array([xxhash.xxh3_64_intdigest(x, seed=s) for x, s in zip(part, side)], np.uint64)
    return mix(np.array(h, np.int64).view(np.uint64) ^ sub).view(np.int64)


def _later_strings(rows: list[tuple[int, int, int, bytes]], r: Repeats) -> Iterator[tuple[int, int, int, int]]:
    """Spans (doc, tie, begin, end) of the strings in some segments that also stand earlier."""
    data = np.frombuffer(b"".join(x[3] for x in rows), np.uint8)
    sizes = np.array([len(x[3]) for x in rows])
    starts = np.cumsum(sizes) - sizes
    words = words_at(data, r.length + 16)
    order = suffix_array(data, r.length, words)
    owner = np.repeat(np.arange(len(rows)), sizes)
    inside = np.arange(len(data)) - starts[owner]
    order = order[(sizes[owner] - inside >= r.length)[order]]
    if not len(order):
        return
    shared = common_prefixes(order, words, r.length)
    docs = {x: i for i, x in enumerate(sorted({x[:2] for x in rows}))}
    ordinal = np.array([docs[x[:2]] for x in rows])
    begin = np.array([x[2] for x in rows])
    place = (ordinal[owner[order]] << 32) | (begin[owner[order]] + inside[order])
    runs = np.flatnonzero(shared < r.length)
    least = np.minimum.reduceat(place, runs)
    later = place > np.repeat(least, np.diff(np.append(runs, len(place))))
    spots = np.unique(place[later])
    if not len(spots):
        return
    breaks = np.flatnonzero(np.diff(spots) > r.length) + 1
    names = list(docs)
    for some in np.split(spots, breaks):
        doc, tie = names[int(some[0]) >> 32]
        yield doc, tie, int(some[0]) & 0xFFFFFFFF, (int(some[-1]) & 0xFFFFFFFF) + r.length


def _spans_of(places: np.ndarray, r: Repeats) -> Iterator[tuple[int, int, int, int]]:
    """Spans (doc, tie, begin, end) of the strings at some places (doc, tie, at), sorted."""
    doc, tie, at = places["doc"], places["tie"], places["at"]
    apart = np.flatnonzero((doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (at[1:] - at[:-1] > r.length)) + 1
    first = np.concatenate([[0], apart])
    last = np.append(apart, len(places)) - 1
    yield from zip(doc[first].tolist(), tie[first].tolist(), at[first].tolist(), (at[last] + r.length).tolist())


_PLACE = np.dtype([("doc", np.int64), ("tie", np.int32), ("at", np.int32)])
_STRING = "gone boolean, a long, b long, doc long, tie int, begin int, end int"
_STRING_NAMES = ["gone", "a", "b", "doc", "tie", "begin", "end"]


def _sent_strings(rows: list[tuple], r: Repeats) -> Iterator[pa.RecordBatch]:
    """Of the equal strings in some segments (doc, tie, begin, bytes) the first, and spans of the others, marked gone and dealt out by place."""
    import xxhash

    n = np.array([max(0, len(x[3]) - r.length + 1) for x in rows], np.int64)
    if not n.sum():
        return
    hashes = b"".join([xxhash.xxh3_128_digest(x[3][i : i + r.length]) for x in rows for i in range(len(x[3]) - r.length + 1)])
    pair, place = np.frombuffer(hashes, np.int64).reshape(-1, 2), np.empty(n.sum(), _PLACE)
    place["doc"], place["tie"] = (np.repeat([x[i] for x in rows], n) for i in (0, 1))
    place["at"] = np.repeat([x[2] for x in rows], n) + np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
    order = np.lexsort((place["at"], place["tie"], place["doc"], pair[:, 1], pair[:, 0]))
    pair, place = pair[order], place[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]).any(axis=1)
    # A string may lie in several segments: the same place again is not a later one.
    late = place != place[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    sent = place[new]
    columns = [np.zeros(len(sent), bool), pair[new, 0], pair[new, 1], sent["doc"], sent["tie"], sent["at"], sent["at"] + np.int32(r.length)]
    for lo in range(0, len(sent), 1 << 16):
        yield _batch([c[lo : lo + (1 << 16)] for c in columns], _STRING_NAMES)
    if late.any():
        doc, tie, begin, end = (np.array(c) for c in zip(*_spans_of(np.unique(place[late]), r)))
        a = mix(doc.view(np.uint64) ^ mix(begin.astype(np.uint64))).view(np.int64)
        yield _batch([np.ones(len(doc), bool), a, a, doc, tie.astype(np.int32), begin.astype(np.int32), end.astype(np.int32)], _STRING_NAMES)


def later_strings(found: DataFrame, r: Repeats) -> DataFrame:
    """What later_spans gives, without grouping segments: no task holds more than a block of them, and a string leaves each block once."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append(row)
                size += len(row[3])
                if size >= r.block:
                    yield from _sent_strings(rows, r)
                    rows, size = [], 0
        yield from _sent_strings(rows, r)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # hash and least place of the string before
        for batch in batches:
            if not batch.num_rows:
                continue
            gone, a, b, doc, tie, begin = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:6])
            place = np.empty(len(a), _PLACE)
            place["doc"], place["tie"], place["at"] = doc, tie, begin
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            new[0] = last is None or last[0] != (a[0], b[0])
            heads = np.maximum.accumulate(np.where(new, np.arange(len(a)), -1))
            least = place[np.maximum(heads, 0)]
            if last is not None:
                least[heads < 0] = last[1]
            last = ((a[-1], b[-1]), least[-1])
            yield pa.RecordBatch.from_arrays(batch.columns[3:], _STRING_NAMES[3:]).filter(pa.array(gone | (place != least)))

    sent = found.select("doc", "tie", "begin", "bytes").mapInArrow(send, _STRING)
    dealt = sent.repartition("a", "b").sortWithinPartitions("gone", "a", "b", "doc", "tie", "begin")
    return dealt.mapInArrow(run, "doc long, tie int, begin int, end int")


def later_spans(found: DataFrame, r: Repeats) -> DataFrame:
    """doc, tie, begin, end of strings that stand earlier in a segment of the same key.

    found is read more than once. Equal strings have the same key, so each key goes one way or the other whole.
    """
    large = materialise(found.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > r.group).select("key"), "suffix-large")
    if large.isEmpty():
        return _grouped_spans(found, r)
    # Spark knows the size of the written keys: it broadcasts few of them, and shuffles by key beyond its threshold.
    return _grouped_spans(found.join(large, "key", "left_anti"), r).unionByName(later_strings(found.join(large, "key", "left_semi"), r))


def _grouped_spans(found: DataFrame, r: Repeats) -> DataFrame:
    """What later_spans gives, for keys that have no more segments than a block holds."""

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Segments in whole groups of two or more, about a block at a time."""
        ready, size, group, key = [], 0, [], None
        for batch in batches:
            for k, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    if len(group) > 1:
                        ready += group
                        size += sum(len(x[3]) for x in group)
                        if size >= r.block:
                            yield ready
                            ready, size = [], 0
                    group, key = [], k
                group.append(tuple(row))
        if len(group) > 1:
            ready += group
        if ready:
            yield ready

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
        for rows in grouped(batches):
            spans = list(_later_strings(rows, r))
            if spans:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*spans), kinds)], ["doc", "tie", "begin", "end"])

    dealt = found.repartition("key").sortWithinPartitions("key", "doc", "tie", "begin")
    return dealt.mapInArrow(run, "doc long, tie int, begin int, end int")


# ------------------------------------------------------------ documents


def _identified(docs: DataFrame, doc_id: str, text: str, doc: str, tie: str) -> DataFrame:
    """The documents with two more columns: a key that orders them, unique as a pair."""
    docs = docs.withColumn(doc, F.coalesce(col(doc_id).cast("long"), F.lit(-(2**63)).cast("long")))
    if docs.groupBy(col(doc)).count().filter("count > 1").isEmpty():
        return docs.withColumn(tie, F.lit(0))
    return materialise(docs.withColumn(tie, F.row_number().over(Window.partitionBy(col(doc)).orderBy(col(text)))), "suffix-docs")


def spans(docs: DataFrame, r: Repeats = Repeats()) -> DataFrame:
    """doc, tie, cuts (begin, end) of each document (doc, tie, text) that loses something."""
    repeated = materialise(repeated_anchors(find_anchors(docs, r)), "suffix-anchors")
    whole = repeated.filter("gone").select("doc", "tie", F.greatest(F.lit(0), F.col("at") - r.left).alias("begin"), F.least("size", F.col("at") + r.length).alias("end"))
    open_ = repeated.filter("not gone")
    several = open_.groupBy("doc", "tie").agg(F.collect_list(F.struct("h", "at")).alias("anchors"))
    cut = materialise(segments(docs.join(several, ["doc", "tie"]), r), "suffix-segments")
    found = whole.unionByName(later_spans(cut, r))
    return found.groupBy("doc", "tie").agg(F.collect_list(F.struct("begin", "end")).alias("cuts"))


def _kept(data: np.ndarray, cuts: list[dict] | None) -> tuple[np.ndarray, int, int]:
    """The bytes that stay, the number that go, and the number of runs that go."""
    if not cuts:
        return data, 0, 0
    edges = np.zeros(len(data) + 1, np.int64)
    np.add.at(edges, [c["begin"] for c in cuts], 1)
    np.add.at(edges, [c["end"] for c in cuts], -1)
    gone = np.cumsum(edges[:-1]) > 0
    return data[~gone], int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())


def dedup_report(docs: DataFrame, r: Repeats = Repeats()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of all documents (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            out = []
            for i, cuts in enumerate(batch.column(2).to_pylist()):
                kept, gone, n = _kept(data[offsets[i] : offsets[i + 1]], cuts)
                out.append((int(offsets[i + 1] - offsets[i]), gone, n, sha256(kept.tobytes()).hexdigest()))
            columns = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string())))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    named = _identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", "text", "doc", "tie")
    cuts = spans(named.select("doc", "tie", "text"), r)
    rows = named.join(cuts, ["doc", "tie"], "left").select("doc_id", "text", "cuts")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, r: Repeats = Repeats(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repeated passages taken out of their texts, with the columns they came with.

    Where a cut leaves part of a character, the part goes too. A changed text's n_chars, where docs has that
    column, is set to its length. Documents of which nothing is left stay, with an empty text.
    """
    doc, tie, cuts_name = fresh(docs, "_doc", "_tie", "_cuts")

    names = list(docs.columns)
    at, chars = names.index(text), names.index("n_chars") if "n_chars" in names and text != "n_chars" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            *columns, cuts = batch.columns
            cuts = cuts.to_pylist()
            data, offsets = text_bytes(columns[at])
            old, new = columns[at].to_pylist(), []
            for i, c in enumerate(cuts):
                new.append(old[i] if not c else _kept(data[offsets[i] : offsets[i + 1]], c)[0].tobytes().decode("utf-8", "ignore"))
            columns[at] = pa.array(new, pa.string())
            if chars is not None:
                columns[chars] = pa.array([n if not c else len(x) for n, c, x in zip(columns[chars].to_pylist(), cuts, new)], columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    named = _identified(docs, doc_id, text, doc, tie)
    cuts = spans(named.select(col(doc).alias("doc"), col(tie).alias("tie"), col(text).alias("text")), r).toDF(doc, tie, cuts_name)
    rows = named.join(cuts, [doc, tie], "left").select(*(col(c) for c in names), cuts_name)
    # Plain names on the way: a column's own may hold dots.
    plain = [f"c{i}" for i in range(len(names))]
    kinds = T.StructType([T.StructField(n, f.dataType) for n, f in zip(plain, docs.schema)])
    return rows.toDF(*plain, "cuts").mapInArrow(run, kinds).toDF(*names)
