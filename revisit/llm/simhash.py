"""SimHash fingerprints of documents, and all of them within a Hamming radius of each.

A text's terms are its runs of `term_words` words (a shorter text is one term); each occurrence votes, so a
term weighs as often as it stands there. Each bit of a term's hash votes for or against that bit of the
fingerprint; ties and texts without words give 0 bits. Two 64-bit hashes make a fingerprint of 128 bits.

Search: the bits are cut into `blocks` blocks. Two fingerprints within the radius r differ in at most r
blocks, so they agree in some choice of blocks - r of them; for each choice, there is a table of fingerprints keyed by
those blocks (a permutation that puts them first). Equal fingerprints are one row in the tables, so copies don't meet
each other there. Fingerprints that are alone with their key in a table drop out; the others are gathered in chunks of
bounded size, and chunks of a key meet: each fingerprint gets the number of those near it in the other chunk, so no
pair becomes a row. A pair counts at the first choice that shows it, that of the first blocks in which it agrees.
`close_pairs` lists the pairs instead.

One changed word changes `term_words` terms. Single words, each weighing as often as it stands in the text, move least:
`EDITED`, which edit_report uses, is set by the distances of such edits (README).

Nulls are empty texts. Repeated rows count as copies. Long texts are split into words whole. Ties in doc_id go by text,
those of many rows without an id by a hash of the text first. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revisit.llm.common import SPACES, WORD_GAP, let, materialise

BITS = 128


@dataclass(frozen=True)
class Search:
    radius: int = 3
    blocks: int = 6
    term_words: int = 3


#: Finds texts of 100 words and more with one changed word; 28 tables with keys of 32 bits.
EDITED = Search(radius=6, blocks=8, term_words=1)
CHUNK = 1024
KEY = ["mixed", "choice", "kl"]


def _lanes(sums: list[Column], n: Column) -> Column:
    """64 bits from sums that hold the votes for bit i and, 32 bits higher, for bit i + 32."""
    out = F.lit(0).cast("long")
    for i, s in enumerate(sums):
        low, high = s.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")), F.shiftrightunsigned(s, 32)
        out = out.bitwiseOR(F.when(2 * low > n, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
        out = out.bitwiseOR(F.shiftleft(F.when(2 * high > n, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")), i + 32))
    return out


def terms(text: Column, term_words: int) -> Column:
    """The text's terms, as an array of structs of words; one struct of all null for a text without words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.split(F.lower(trimmed), WORD_GAP, -1)


def fingerprints(texts: DataFrame, keys: list[str], text: str, search: Search = Search()) -> DataFrame:
    """keys, high, low: the two halves of each text's fingerprint. keys identify a row; equal keys must hold equal texts.

    Each word is a row for a moment; votes are added up in each task before the shuffle, which then moves
    one row of sums per text and task.
    """
    words = texts.select(*keys, terms(F.col(text), search.term_words).alias("words"))
    n = search.term_words
    shifted = [F.slice("words", F.lit(j + 1), F.greatest(F.size("words") - n + 1, F.lit(1))) for j in range(n)]
    term = words.select(*keys, F.explode(F.arrays_zip(*shifted)).alias("term"))
    parts = [F.col("term")[str(j)] for j in range(n)]
    hashed = term.select(*keys, F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(7), *parts).alias("b"))
    both = F.lit(0x0000000100000001).cast("long")
    sums = [F.sum(F.shiftright(h, i).bitwiseAND(both)).alias(f"{h}{i}") for h in ("a", "b") for i in range(32)]
    voted = hashed.groupBy(*keys).agg(F.count("*").alias("n"), *sums)
    high, low = (_lanes([F.col(f"{h}{i}") for i in range(32)], F.col("n")) for h in ("a", "b"))
    return voted.select(*keys, high.alias("high"), low.alias("low"))


def as_text(high: Column, low: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def distance(a_high: Column, a_low: Column, b_high: Column, b_low: Column) -> Column:
    return F.bit_count(a_high.bitwiseXOR(b_high)) + F.bit_count(a_low.bitwiseXOR(b_low))


def _masks(blocks: int) -> list[tuple[int, int]]:
    """The bits of each block, as signed 64-bit masks of the two halves."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    out = []
    for low, high in zip(edges, edges[1:]):
        bits = ((1 << high) - 1) ^ ((1 << low) - 1)
        out.append((signed(bits >> 64), signed(bits & ((1 << 64) - 1))))
    return out


def _tables(distinct: DataFrame, search: Search) -> tuple[DataFrame, list[tuple[int, ...]]]:
    """The rows once for each choice of blocks, with KEY (the choice and the bits of its blocks); and the choices."""
    blocks = _masks(search.blocks)
    chosen = list(combinations(range(search.blocks), search.blocks - search.radius))
    choices = [tuple(sum(blocks[i][half] for i in some) for half in (0, 1)) for some in chosen]
    masks = F.array(*(F.struct(F.lit(i).alias("choice"), F.lit(h).cast("long").alias("h"), F.lit(low).cast("long").alias("l")) for i, (h, low) in enumerate(choices)))
    keyed = distinct.select("*", F.explode(masks).alias("m"))
    kh, kl = F.col("high").bitwiseAND(F.col("m.h")), F.col("low").bitwiseAND(F.col("m.l"))
    # With the low half a key as good as with the high one; its first column differs between most keys, so sorting is quick.
    mixed = kh.bitwiseXOR(F.shiftleft(kl, 32).bitwiseOR(F.shiftrightunsigned(kl, 32)))
    key = (mixed.alias("mixed"), F.col("m.choice").alias("choice"), kl.alias("kl"))
    return keyed.select(*distinct.columns, *key), chosen


def _last(choice: Column, chosen: list[tuple[int, ...]]) -> Column:
    """The last block of a choice."""
    return F.element_at(F.array(*(F.lit(some[-1]) for some in chosen)), choice + 1)


def _first_shown(x_high: Column, x_low: Column, last: Column, search: Search) -> Column:
    """Whether a pair, of which these are the differing bits, is within the radius and shown by no choice before the one in which it agrees, with this last block."""
    # It is if the pair agrees in no other block before the last of the choice.
    agrees = [(x_high.bitwiseAND(F.lit(h).cast("long")) == 0) & (x_low.bitwiseAND(F.lit(low).cast("long")) == 0) & (last >= i) for i, (h, low) in enumerate(_masks(search.blocks))]
    first = sum((x.cast("int") for x in agrees), F.lit(0)) == search.blocks - search.radius
    return (F.bit_count(x_high) + F.bit_count(x_low) <= search.radius) & first


def close_pairs(distinct: DataFrame, search: Search = Search()) -> DataFrame:
    """Each pair of fingerprints within the radius once: a_high, a_low, b_high, b_low.

    distinct: high, low, each fingerprint once.
    """
    keyed, chosen = _tables(distinct.select("high", "low"), search)
    a, b = keyed.withColumnsRenamed({"high": "a_high", "low": "a_low"}), keyed.withColumnsRenamed({"high": "b_high", "low": "b_low"})
    x_high, x_low = F.col("a_high").bitwiseXOR(F.col("b_high")), F.col("a_low").bitwiseXOR(F.col("b_low"))
    same = (a["mixed"] == b["mixed"]) & (a["choice"] == b["choice"]) & (a["kl"] == b["kl"])
    ordered = (F.col("a_high") < F.col("b_high")) | ((F.col("a_high") == F.col("b_high")) & (F.col("a_low") < F.col("b_low")))
    # Exploded tables are larger than Spark guesses: never a broadcast.
    return a.join(b.hint("merge"), same & ordered & _first_shown(x_high, x_low, _last(a["choice"], chosen), search)).select("a_high", "a_low", "b_high", "b_low")


def near_counts(counted: DataFrame, search: Search = Search(), chunk: int = CHUNK) -> DataFrame:
    """high, low, near: for fingerprints with others within the radius, the sum of their n. counted: high, low (each once), n.

    A key with many fingerprints is cut into chunks by hash. Each two chunks of a key meet in a row of their own, dealt by
    both, and only counts come out. Most pairs end at their folded halves: these differ in no more bits than the pair does.
    """
    keyed, chosen = _tables(counted.select("high", "low", "n"), search)
    shared = materialise(keyed.groupBy(*KEY).agg(F.count("*").alias("size")).filter("size > 1"), "simhash-shared")
    some = keyed.join(shared, KEY).withColumn("chunks", F.ceil(F.col("size") / chunk))
    some = some.withColumn("chunk", F.pmod(F.xxhash64("high", "low"), "chunks"))
    folded = F.struct(F.col("high").bitwiseXOR(F.col("low")).alias("fold"), "high", "low", "n")
    chunks = some.groupBy(*KEY, "chunks", "chunk").agg(F.collect_list(folded).alias("prints"))
    chunks = materialise(chunks, "simhash-chunks")
    alone = chunks.filter("chunks = 1").select("choice", "prints", F.col("prints").alias("others"))
    several, each = chunks.filter("chunks > 1"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    left = several.select(*KEY, "prints", "chunk", each.alias("other"))
    right = several.select(*KEY, F.col("prints").alias("others"), each.alias("chunk"), F.col("chunk").alias("other"))
    # Repeated chunks are larger than Spark guesses: never a broadcast.
    met = left.join(right.hint("merge"), [*KEY, "chunk", "other"]).select("choice", "prints", "others")

    def near(x: Column) -> Column:
        def add(total: Column, y: Column) -> Column:
            x_high, x_low = x["high"].bitwiseXOR(y["high"]), x["low"].bitwiseXOR(y["low"])
            counts = ((x_high != 0) | (x_low != 0)) & _first_shown(x_high, x_low, F.col("last"), search)
            return F.when(counts, total + y["n"]).otherwise(total)

        # Values bound by let are read faster than fields of x.
        maybe = let(x["fold"], lambda fold: F.filter("others", lambda y: F.bit_count(fold.bitwiseXOR(y["fold"])) <= search.radius))
        close = let(x["high"], lambda high: let(x["low"], lambda low: F.filter(maybe, lambda y: distance(high, low, y["high"], y["low"]) <= search.radius)))
        return F.aggregate(close, F.lit(0).cast("long"), add)

    counts = F.transform("prints", lambda x: F.struct(x["high"].alias("high"), x["low"].alias("low"), near(x).alias("near")))
    found = alone.unionByName(met).withColumn("last", _last(F.col("choice"), chosen)).select(F.inline(F.filter(counts, lambda x: x["near"] > 0)))
    return found.groupBy("high", "low").agg(F.sum("near").alias("near"))


def links(printed: DataFrame, search: Search = Search()) -> DataFrame:
    """class_id and n_links of each text: text_sha256, class_id (least doc_id with that text), n_links (other texts within the radius).

    printed: doc_id, text_sha256, high, low.
    """
    texts = printed.groupBy("text_sha256", "high", "low").agg(F.min("doc_id").alias("class_id"))
    # Few bytes, of which many rows are made: as many tasks as a shuffle has, not as few as their size asks for.
    parts = int(printed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = texts.repartition(parts, "high", "low").groupBy("high", "low").agg(F.count("*").alias("n"))
    counted = materialise(counted, "simhash-distinct")
    near = near_counts(counted, search)
    counts = counted.join(near, ["high", "low"], "left")
    return texts.join(counts, ["high", "low"]).select("text_sha256", "class_id", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))


def bucketed(docs: DataFrame, doc_id: str, per_bucket: int, most: int = 1 << 14) -> DataFrame:
    """The documents with `bucket`: an ascending function of doc_id, about `per_bucket` documents each, at most `most` buckets.

    Bounds are quantiles of the ids, in two levels, so that a row is compared with few of them; however ids lie,
    buckets fill evenly. Rows without an id come first, dealt by a hash of their text if they are many.
    """
    found = docs.agg(F.count("*").alias("n"), F.count_if(F.col(doc_id).isNull()).alias("nulls")).first()
    n_buckets = min(most, found["n"] // per_bucket + 1)
    wide = math.isqrt(n_buckets) + 1
    shares = [i / (wide * wide) for i in range(1, wide * wide)]
    bounds = docs.agg(F.percentile_approx(doc_id, shares, 10 * wide * wide).alias("b")).first()["b"] if found["n"] > found["nulls"] else None
    bounds = bounds or [0] * (wide * wide - 1)
    upper, lower = bounds[wide - 1 :: wide], [[*bounds[i * wide : i * wide + wide - 1]] for i in range(wide)]
    below = lambda of: F.size(F.filter(of, lambda b: b <= F.col(doc_id)))
    longs = lambda some: F.array(*(F.lit(x).cast("long") for x in some)) if some else F.array().cast("array<bigint>")
    bucket = let(below(longs(upper)), lambda at: at * wide + below(F.element_at(F.array(*map(longs, lower)), at + 1)))
    dealt = F.pmod(F.xxhash64("text"), F.lit(found["nulls"] // per_bucket + 1)) - (found["nulls"] // per_bucket + 1)
    bucket = F.when(F.col(doc_id).isNull(), dealt).otherwise(bucket).cast("long")
    # Never null, as Spark can see: else it filters one of two readers of the same shuffle, which then are two shuffles.
    return docs.withColumn("bucket", F.coalesce(bucket, F.lit(0).cast("long")))


def with_next(rows: DataFrame, order: list[str], following: list[str]) -> list[DataFrame]:
    """rows (with bucket) with place and next_<column> of the row after each, by bucket and order, the first's after the last.

    Two frames: the rows inside buckets, partitioned by bucket, and the few at the buckets' ends, whose next
    row is the first of the next bucket that has rows. Both read one shuffle by bucket.
    """
    w = Window.partitionBy("bucket").orderBy(*order)
    ahead = F.lead(F.struct(*following)).over(w)
    seen = rows.withColumn("_next", ahead).withColumn("place", F.row_number().over(w))
    every, whole = Window.orderBy("bucket"), Window.partitionBy()
    after = rows.select("bucket").distinct()
    after = after.select(F.col("bucket").alias("_b"), F.coalesce(F.lead("bucket").over(every), F.min("bucket").over(whole)).alias("_after"))
    heads = seen.filter("place = 1").select(F.col("bucket").alias("_head"), F.struct(*following).alias("_next"))
    inside = seen.filter("_next is not null")
    ends = seen.filter("_next is null").drop("_next")
    ends = ends.join(after, ends["bucket"] == after["_b"]).join(heads, F.col("_after") == F.col("_head"))
    return [part.select(*rows.columns, "place", *(F.col("_next")[c].alias(f"next_{c}") for c in following)) for part in (inside, ends)]


def edit_report(docs: DataFrame, search: Search = EDITED, per_bucket: int = 500) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, their likeness, class and links.

    The edited text has the next document's first code points for the last quarter. docs: doc_id, text. Rows
    of one doc_id are put in order of text.
    """
    texts = bucketed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", per_bucket)
    printed = []
    for part in with_next(texts, ["doc_id", "text"], ["text"]):
        n = F.length("text")
        gone = F.floor(n / 4).cast("int")
        edited = F.concat(F.left(F.col("text"), n - gone), F.left(F.col("next_text"), gone))
        both = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), edited.alias("text")))).alias("v")
        rows = part.select("bucket", "place", "doc_id", n.cast("long").alias("n_chars"), both).select("bucket", "place", "doc_id", "n_chars", F.col("v.kind").alias("kind"), F.col("v.text").alias("text"))
        rows = rows.withColumn("sha", F.sha2(F.col("text"), 256))
        printed.append(fingerprints(rows, ["bucket", "place", "kind", "doc_id", "n_chars", "sha"], "text", search))
    prints = materialise(printed[0].unionByName(printed[1]), "simhash-prints")
    texts_, edits = prints.filter("kind = 0"), prints.filter("kind = 1")
    edits = edits.select(F.col("bucket").alias("e_bucket"), F.col("place").alias("e_place"), F.col("sha").alias("edited_sha256"), F.col("high").alias("e_high"), F.col("low").alias("e_low"))
    rows = texts_.select("bucket", F.col("place").alias("at"), "doc_id", "n_chars", F.col("sha").alias("text_sha256"), "high", "low")
    rows = rows.join(edits, (F.col("bucket") == F.col("e_bucket")) & (F.col("at") == F.col("e_place"))).drop("e_bucket", "e_place")
    inside, ends = with_next(rows, ["at"], ["high", "low"])
    known = links(texts_.select("doc_id", F.col("sha").alias("text_sha256"), "high", "low"), search)
    likeness = lambda h, low: 1 - distance(F.col("high"), F.col("low"), F.col(h), F.col(low)) / F.lit(float(BITS))
    return inside.unionByName(ends).join(known, "text_sha256").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("high"), F.col("low")).alias("fingerprint"), as_text(F.col("e_high"), F.col("e_low")).alias("edited_fingerprint"),
        likeness("e_high", "e_low").alias("near_edited"), likeness("next_high", "next_low").alias("near_next"), "class_id", "n_links",
    )
