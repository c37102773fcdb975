"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

A task reads its documents as streams of word numbers and makes one stripe per (language, prefix, shard): the
words that follow the prefix, with their counts. `merged` brings the stripes of a key together and adds them
element by element. From merged stripes follow

- extensions: a prefix with one of its next words is a phrase, the entry is its count;
- prefix totals: a word's entries, the end of the piece among them, add up to the word's occurrences;
- subsumption maxima: the largest entry of a stripe is the largest extension of the prefix to the right, and the
  same entries, keyed by the phrase without its first word, give the largest extension to the left.

First all stripes of one-word prefixes are made. Those of two and three words are made in a second pass, only where
all word pairs inside may be frequent. A Bloom filter of the frequent pairs says so; it has at most `max_bits` bits,
whatever the corpus, and a false answer costs a row, not a wrong result: counts come from the stripes. A phrase that
a longer candidate subsumes is subsumed by one that is a word longer, since the words between are as frequent, so
one-word extensions suffice.

No task holds a stripe as a whole: its words are dealt to `shards` by hash, which grow with the square root of the
number of documents. Merging reads a partition in key order and holds one stripe of one shard.

Defined results: a null language is `und`, one language with a literal `und`. Null, empty and blank texts have no
words; a language without a candidate has no row. Repeated rows count as often as they occur, whatever their ids.
Texts of any length are read whole, a piece at a time. Ties in the score go by a, then by the bytes of the phrase.
Other columns of the documents are not read, so their names can't clash. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revisit.llm.common import col, materialise, running

#: Bytes that end a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
#: Never part of UTF-8: stands for the end of a piece.
_END = b"\xff"


def _reading() -> bytes:
    """The table that lower-cases A-Z, makes tabs spaces and ends of pieces _END."""
    table = bytearray(range(256))
    table[65:91] = range(97, 123)
    table[9] = 32
    for end in PIECE_ENDS:
        table[end] = _END[0]
    return bytes(table)


_READING = _reading()
STRIPE = "lang string, prefix string, shard int, next array<string>, n array<bigint>"
MERGED = "lang string, prefix string, shard int, total bigint, next array<string>, n array<bigint>"
_STRIPE_ARROW = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("shard", pa.int32()), ("next", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))])
_MERGED_ARROW = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("shard", pa.int32()), ("total", pa.int64()), ("next", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))])


@dataclass(frozen=True)
class Mining:
    """least: occurrences of a candidate. longest: its words. subsumed: per cent of its occurrences inside a longer one that drop it.

    top: rows of a language. max_bits: most bits of the filter (32 MiB). words_together: words that a task turns
    into stripes at once. shards: parts of a stripe, at least.
    """

    least: int = 30
    longest: int = 4
    subsumed: int = 80
    top: int = 2000
    scale: int = 2_000_000
    max_bits: int = 1 << 28
    words_together: int = 2_000_000
    words_known: int = 600_000
    shards: int = 16


def _mix(x: np.ndarray) -> np.ndarray:
    """64 well mixed bits of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(words: Iterable[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64)


def pair_hashes(langs: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of word pairs of languages, from the hashes of each."""
    return _mix(_mix(first + np.uint64(0x9E3779B97F4A7C15) * langs) + second)


class Bloom:
    """Bits of a set of 64-bit hashes, three to a member. No member is ever denied."""

    def __init__(self, bits: int, data: np.ndarray | None = None):
        self.bits, self.data = bits, np.zeros(bits // 8, np.uint8) if data is None else data

    def places(self, hashes: np.ndarray) -> list[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        return [((hashes + np.uint64(i) * step) & np.uint64(self.bits - 1)).astype(np.int64) for i in range(3)]

    def add(self, hashes: np.ndarray) -> None:
        for at in self.places(hashes):
            np.bitwise_or.at(self.data, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def __contains__(self, value: int) -> bool:
        return bool(self.test(np.array([value], np.uint64))[0])

    def test(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each may be a member."""
        found = np.ones(len(hashes), bool)
        for at in self.places(hashes):
            found &= (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        return found


class Words:
    """Word numbers of the texts of some documents, with an end after each piece and text."""

    def __init__(self):
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[_END]
        self.langs: dict[str, int] = {}
        self.parts: list[np.ndarray] = []
        self.of: list[tuple[int, int]] = []
        self.size = 0

    def add(self, lang: str, texts: list[bytes]) -> None:
        words = (_END.join(texts) + _END).translate(_READING).replace(_END, b" \xff ").split()
        part = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
        self.parts.append(part)
        self.of.append((self.langs.setdefault(lang, len(self.langs)), len(part)))
        self.size += len(part)

    def stream(self) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words, and of their languages; number 0 ends a piece. Only one end stands in a row."""
        words = np.concatenate(self.parts)
        langs = np.repeat(np.array([x for x, _ in self.of], np.int64), [n for _, n in self.of])
        keep = words != 0
        keep[1:] |= words[:-1] != 0
        return words[keep], langs[keep]


def _read(batches: Iterator[pa.RecordBatch], mining: Mining, together: int = 4_000_000) -> Iterator[Words]:
    """Words of bounded numbers of documents; columns lang and text. A text is never split."""
    words = Words()
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
        of: dict[str, list[int]] = defaultdict(list)
        for i, lang in enumerate(langs):
            of[lang].append(i)
        for lang, rows in of.items():
            some, size = [], 0
            for i in rows:
                text = texts[i].as_py()
                if text:
                    some.append(text)
                    size += len(text)
                if size >= together or (some and i == rows[-1]):
                    words.add(lang, some)
                    some, size = [], 0
                if words.size >= mining.words_together or len(words.number) >= mining.words_known:
                    yield words
                    words = Words()
            if some:
                words.add(lang, some)
    if words.size:
        yield words


def _stripes(langs: np.ndarray, prefix: np.ndarray, following: np.ndarray, names: list[str], prefixes: pa.Array, words: pa.Array, shard_of: np.ndarray) -> pa.RecordBatch | None:
    """Stripes of occurrences: of each its language, the number of its prefix, that of its next word."""
    if not len(prefix):
        return None
    n_shards, n_words = int(shard_of.max()) + 1, len(words)
    key = (prefix * n_shards + shard_of[following]) * n_words + following
    if len(names) > 1:
        if len(names) * len(prefixes) * n_shards * n_words >= 1 << 62:
            raise OverflowError("too many different words and languages in one part")
        key += langs * (len(prefixes) * n_shards * n_words)
    key, n = np.unique(key, return_counts=True)
    stripe, following = np.divmod(key, n_words)
    starts = np.flatnonzero(np.concatenate(([True], stripe[1:] != stripe[:-1])))
    stripe = stripe[starts]
    offsets = pa.array(np.append(starts, len(key)).astype(np.int32))
    lang, prefix = np.divmod(stripe // n_shards, len(prefixes))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.string()).take(pa.array(lang)),
            prefixes.take(pa.array(prefix)),
            pa.array((stripe % n_shards).astype(np.int32)),
            pa.ListArray.from_arrays(offsets, words.take(pa.array(following))),
            pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int64))),
        ],
        schema=_STRIPE_ARROW,
    )


def _tables(words: Words) -> tuple[list[str], pa.Array, np.ndarray]:
    """Languages, words as text (the end of a piece is empty), and hashes of words."""
    known = list(words.number)
    known[0] = b""
    return list(words.langs), pa.array(known, pa.binary()).cast(pa.string()), _hashes(known)


def _shards(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (_mix(hashes) % np.uint64(shards)).astype(np.int64)


def word_stripes(docs: DataFrame, mining: Mining, shards: int) -> DataFrame:
    """Stripes of one-word prefixes of the documents' parts; an empty next word is the end of a piece."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _read(batches, mining):
            stream, langs = words.stream()
            names, text, hashes = _tables(words)
            at = np.flatnonzero(stream[:-1] != 0)
            out = _stripes(langs[at], stream[at].astype(np.int64), stream[at + 1].astype(np.int64), names, text, text, _shards(hashes, shards))
            if out is not None:
                yield from _small(out)

    return docs.mapInArrow(of, STRIPE)


def phrase_stripes(docs: DataFrame, frequent, mining: Mining, shards: int) -> DataFrame:
    """Stripes of prefixes of two to longest - 1 words, where all word pairs may be frequent. frequent: (bits, bytes), broadcast."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, data = frequent.value
        bloom = Bloom(bits, np.frombuffer(data, np.uint8))
        for words in _read(batches, mining):
            stream, langs = words.stream()
            names, text, hashes = _tables(words)
            of_lang, of_word = _hashes(x.encode() for x in names), _shards(hashes, shards)
            at = np.flatnonzero((stream[:-1] != 0) & (stream[1:] != 0))
            pairs = np.zeros(len(stream), bool)
            pairs[at] = bloom.test(pair_hashes(of_lang[langs[at]], hashes[stream[at]], hashes[stream[at + 1]]))
            prefixes, number, starts = text, stream.astype(np.int64), np.flatnonzero(pairs)
            for length in range(2, mining.longest):
                # number: of the prefix of length - 1 words that starts there.
                pair, inverse = np.unique(number[starts] * len(text) + stream[starts + length - 1], return_inverse=True)
                first, last = np.divmod(pair, len(text))
                prefixes = pc.binary_join_element_wise(prefixes.take(pa.array(first)), text.take(pa.array(last)), " ")
                number = np.full(len(stream), -1, np.int64)
                number[starts] = inverse
                starts = starts[pairs[starts + length - 1]]
                out = _stripes(langs[starts], number[starts], stream[starts + length].astype(np.int64), names, prefixes, text, of_word)
                if out is not None:
                    yield from _small(out)

    return docs.mapInArrow(of, STRIPE)


def _small(batch: pa.RecordBatch, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _added(table: pa.Table, least: int) -> pa.RecordBatch:
    """The stripes of some keys, which stand in key order, added element by element; entries below `least` go only into the total."""
    table = table.combine_chunks()
    keys = [table.column(x).combine_chunks() for x in ("lang", "prefix", "shard")]
    new = np.ones(table.num_rows, bool)
    new[1:] = np.logical_or.reduce([pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False) for k in keys])
    lists = table.column("next").combine_chunks()
    of = (np.cumsum(new) - 1)[pc.list_parent_indices(lists).to_numpy()]
    flat = pa.table({"key": pa.array(of), "next": lists.flatten(), "n": table.column("n").combine_chunks().flatten()})
    found = flat.group_by(["key", "next"]).aggregate([("n", "sum")]).sort_by("key").combine_chunks()
    of, n = found.column("key").to_numpy(), found.column("n_sum").to_numpy()
    total = np.add.reduceat(n, np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))))
    keep = (n >= least) & pc.not_equal(found.column("next"), "").to_numpy()
    offsets = pa.array(np.searchsorted(of[keep], np.arange(len(total) + 1)).astype(np.int32))
    first = pa.array(np.flatnonzero(new))
    values = found.column("next").combine_chunks().filter(pa.array(keep))
    return pa.RecordBatch.from_arrays(
        [*(k.take(first) for k in keys), pa.array(total), pa.ListArray.from_arrays(offsets, values), pa.ListArray.from_arrays(offsets, pa.array(n[keep]))],
        schema=_MERGED_ARROW,
    )


def merged(stripes: DataFrame, least: int) -> DataFrame:
    """lang, prefix, shard, total (of all entries), and the next words with `least` occurrences and more."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last key's rows may go on in the next batch.
            same = pc.and_(pc.and_(pc.equal(batch.column("lang"), batch.column("lang")[-1]), pc.equal(batch.column("prefix"), batch.column("prefix")[-1])), pc.equal(batch.column("shard"), batch.column("shard")[-1]))
            cut = batch.num_rows - int(pc.sum(same.cast(pa.int64())).as_py())
            if cut:
                yield _added(pa.Table.from_batches([*held, batch.slice(0, cut)]), least)
                held = []
            held.append(batch.slice(cut))
            if len(held) > 16:
                held = [_again(_added(pa.Table.from_batches(held), 1))] if not cut else held
        if held:
            yield _added(pa.Table.from_batches(held), least)

    def _again(batch: pa.RecordBatch) -> pa.RecordBatch:
        """A merged stripe as a stripe: what is not in its list ended the piece."""
        rows = []
        for r in batch.to_pylist():
            words, n = r["next"] or [], r["n"] or []
            ends = r["total"] - sum(n)
            rows.append({"lang": r["lang"], "prefix": r["prefix"], "shard": r["shard"], "next": words + [""] * (ends > 0), "n": n + [ends] * (ends > 0)})
        return pa.RecordBatch.from_pylist(rows, schema=_STRIPE_ARROW)

    keys = ["lang", "prefix", "shard"]
    return stripes.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(of, MERGED)


def entries(stripes: DataFrame) -> DataFrame:
    """lang, phrase, a: the extensions that merged stripes hold."""
    each = F.explode(F.arrays_zip("next", "n")).alias("e")
    return stripes.select("lang", "prefix", each).select("lang", F.concat_ws(" ", "prefix", "e.next").alias("phrase"), F.col("e.n").alias("a"))


def pair_filter(pairs: DataFrame, mining: Mining) -> tuple[int, bytes]:
    """A Bloom filter of word pairs, of 16 bits a pair up to max_bits: (bits, bytes). pairs: lang, phrase."""
    bits = 1 << 16
    count = pairs.count()
    while bits < mining.max_bits and bits < 16 * count:
        bits *= 2
    part = 1 << 15

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = Bloom(bits)
        for batch in batches:
            words = [x.encode().split(b" ") for x in batch.column(1).to_pylist()]
            bloom.add(pair_hashes(_hashes(x.encode() for x in batch.column(0).to_pylist()), _hashes(x[0] for x in words), _hashes(x[1] for x in words)))
        parts = bloom.data.reshape(-1, min(part, len(bloom.data)))
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([parts[i].tobytes() for i in used], pa.binary())], names=["part", "bits"])

    def either(group: pa.Table) -> pa.Table:
        out = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in group.column("bits").to_pylist()])
        return pa.table({"part": group.column("part").slice(0, 1), "bits": pa.array([out.tobytes()], pa.binary())})

    kind = "part int, bits binary"
    # At most max_bits come to the driver.
    found = pairs.select("lang", "phrase").mapInArrow(of, kind).groupBy("part").applyInArrow(either, kind).collect()
    out = bytearray(bits // 8)
    for part_no, data in found:
        out[part_no * len(data) : (part_no + 1) * len(data)] = data
    return bits, bytes(out)


def scored(candidates: DataFrame, counts: DataFrame, sizes: DataFrame, mining: Mining) -> DataFrame:
    """Candidates (lang, phrase, a) with l, r, n and score of their lowest cut. counts: lang, phrase, a of all parts; sizes: lang, n."""
    length = F.size(F.split("phrase", " "))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), length - 1)))
    left = F.expr("substring_index(phrase, ' ', k)")
    rest = F.expr("substring(phrase, length(substring_index(phrase, ' ', k)) + 2)")
    cuts = cuts.select("lang", "phrase", "a", "k", left.alias("left"), rest.alias("rest"))
    parts = counts.select("lang", "phrase", "a")
    cuts = cuts.join(parts.toDF("lang", "left", "l"), ["lang", "left"]).join(parts.toDF("lang", "rest", "r"), ["lang", "rest"])
    exact = f"bigint((cast(a as decimal(20,0)) * {mining.scale}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))))"
    lowest = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("cut")
    out = cuts.groupBy("lang", "phrase", "a").agg(lowest)
    return out.join(sizes, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def unsubsumed(candidates: DataFrame, mining: Mining) -> DataFrame:
    """Candidates that no longer candidate, of one word more, holds in `subsumed` per cent of their occurrences."""
    longer = candidates.filter(F.size(F.split("phrase", " ")) > 2)
    without_last = F.expr("substring(phrase, 1, length(phrase) - length(substring_index(phrase, ' ', -1)) - 1)")
    without_first = F.expr("substring(phrase, length(substring_index(phrase, ' ', 1)) + 2)")
    inside = longer.select("lang", F.explode(F.array(without_last, without_first)).alias("phrase"), "a")
    maxima = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    keep = F.expr(f"most is null or cast(most as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * {mining.subsumed}")
    return candidates.join(maxima, ["lang", "phrase"], "left").filter(keep).select("lang", "phrase", "a")


def ranked(phrases: DataFrame, mining: Mining, salts: int = 32) -> DataFrame:
    """The first `top` rows of each language, with rank from 1.

    First of each of `salts` parts of a language, so that at most top x salts rows of it go on; then ranks in two levels.
    """
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = phrases.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    best = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("place") <= mining.top)
    best = materialise(best.drop("place", "salt"), "phrases-best")
    bucket = F.floor((F.lit(mining.scale) - F.col("score")) / 4096)
    out = running(best, ["lang"], bucket, order, F.lit(1), "before")
    return out.withColumn("rank", F.col("before") + 1).filter(F.col("rank") <= mining.top)


def collocations(docs: DataFrame, mining: Mining = Mining(), text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language."""
    spark = docs.sparkSession
    read = docs.select(F.coalesce(col(lang), F.lit("und")).alias("lang"), col(text).alias("text"))
    shards = max(mining.shards, math.ceil(math.sqrt(docs.count()) / 16))
    one = materialise(merged(word_stripes(read, mining, shards), mining.least), "phrases-words")
    counted = materialise(one.groupBy("lang", "prefix").agg(F.sum("total").alias("a")), "phrases-counts")
    sizes = counted.groupBy("lang").agg(F.sum("a").alias("n"))
    words = counted.filter(F.col("a") >= mining.least).select("lang", F.col("prefix").alias("phrase"), "a")
    pairs = materialise(entries(one), "phrases-pairs")
    frequent = spark.sparkContext.broadcast(pair_filter(pairs, mining))
    more = materialise(entries(merged(phrase_stripes(read, frequent, mining, shards), mining.least)), "phrases-longer")
    frequent.unpersist()
    candidates = pairs.unionByName(more)
    counts = words.unionByName(candidates)
    out = scored(unsubsumed(candidates, mining), counts, sizes, mining)
    return ranked(out, mining).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
