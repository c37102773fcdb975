"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents are shuffled by hash and laid end to end, once per repeat, and cut into blocks of
equal numbers of words. A source gets as many slots of the schedule as its target fills blocks. Slot i of Q
holds the point (i * g) mod Q, with g an integer near Q over the golden ratio that has no divisor in
common with Q: a golden-ratio sequence on Q points, in which each point comes once. The points are mapped
through the cumulative slot counts of the sources, so each source gets just its slots, spread evenly; its
n-th slot, by rank, takes its n-th block. The last block is cut at the target.

Targets: sources in code point order, null last, weigh 5, 2, 1, repeating, and share 150 % of all words. A
target stops at `max_repeats` times its source's words, the rest being shared by weight among the others.

Ranks and running sums are made in two levels (within buckets, then over bucket totals), so no task holds a
whole source. Repeated rows are documents of their own; null and empty texts have no words and are never
taken; an empty table gives an empty mix. Ties in the shuffle are broken by row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revisit.llm.common import SPACES, WORD_GAP, col, fresh, let, materialise


@dataclass(frozen=True)
class Mix:
    """weights: by rank of source, repeating. block: words in a block. bucket_digits: hex digits of the shuffle key that make a bucket."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    max_repeats: int = 2
    block: int = 512
    bucket_digits: int = 3
    slots_together: int = 65536


def n_words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WORD_GAP, -1))).cast("long")


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """source, k (its rank from 0), source_size, target, goal (whole words to take): one row per source.

    Water-filling in closed form: in order of size over weight, sources are full as long as an equal share
    by weight of what is left exceeds them.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, mix.weights))
    ranked = by_source.withColumn("k", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", weights[F.col("k") % len(mix.weights)].cast("long")).withColumn("most", F.col("source_size") * mix.max_repeats)
    everything = Window.partitionBy()
    filling = Window.orderBy((F.col("most") / F.col("weight")).asc(), "k").rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        ranked.withColumn("total", F.sum("source_size").over(everything) * mix.share)
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("most").over(filling), F.lit(0)))
        .withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(filling), F.lit(0)))
        .withColumn("full", F.col("most") * F.col("left_weight") <= F.col("weight") * F.col("left"))
        .withColumn("open", F.col("total") - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0)).over(everything))
        .withColumn("open_weight", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything))
        .withColumn("target", F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("weight") * F.col("open") / F.col("open_weight")))
    )
    return filled.select("source", "k", "source_size", "target", F.least(F.floor(F.col("target") + 0.5), F.col("most")).cast("long").alias("goal"))


def golden_step(total: int) -> int:
    """A whole number near total over the golden ratio, without a common divisor, whose multiples spread evenly.

    Of the numbers close by, the one whose ratio to total has the smallest partial quotients.
    """

    def unevenness(step: int) -> tuple[int, float]:
        a, b, most = total, step, 0
        while b:
            most, (a, b) = max(most, a // b), (b, a % b)
        return most, abs(step - golden)

    golden = total * (math.sqrt(5) - 1) / 2
    near = range(max(1, int(golden) - 100), max(2, int(golden) + 101))
    return min((x for x in near if math.gcd(x, total) == 1), key=unevenness, default=1)


def slots(goals: DataFrame, mix: Mix) -> DataFrame:
    """slot, k, block: the schedule. goals: k and goal of each source, a small table that is read twice."""
    quota = F.ceil(F.col("goal") / F.lit(mix.block)).cast("long")
    needed = goals.filter("goal > 0").select("k", quota.alias("quota"))
    total = needed.agg(F.coalesce(F.sum("quota"), F.lit(0)).alias("q")).first()["q"]
    step = golden_step(total)
    back = pow(step, -1, total) if total > 1 else 0
    ranges = needed.withColumn("first", F.sum("quota").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)))
    ranges = ranges.withColumn("first", F.coalesce("first", F.lit(0)))
    many = mix.slots_together
    runs = ranges.select("k", F.col("first") + F.col("quota") - 1, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - 1) / many))).alias("run"), "first").toDF("k", "last", "run", "first")
    runs = runs.select("k", (F.col("first") + F.col("run") * many).alias("low"), F.least(F.col("first") + F.col("run") * many + many - 1, F.col("last")).alias("high")).repartition("k", "low")
    # Point p is met in slot p * step^-1 mod total; 128-bit products.
    point = F.explode(F.sequence("low", "high")).alias("point")
    slot = F.expr(f"cast(cast(point as decimal(19,0)) * cast({back} as decimal(19,0)) % cast({max(total, 1)} as decimal(19,0)) as bigint)")
    placed = runs.select("k", point).select("k", slot.alias("slot")).withColumn("part", F.floor(F.col("slot") / many))
    # Written, so that joins know its size: Spark guesses that of exploded ranges from the few rows they come from.
    placed = materialise(placed, "mix-slots")
    parts = placed.groupBy("k", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("k", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    rank = F.row_number().over(Window.partitionBy("k", "part").orderBy("slot")) - 1
    return placed.join(parts, ["k", "part"]).select("slot", "k", (F.col("earlier") + rank).alias("block"))


def streams(sizes: DataFrame, goals: DataFrame, mix: Mix) -> DataFrame:
    """row, k, repeat, begin, size: where each document lies in its source's stream, as far as the goal reaches."""
    repeats = F.explode(F.sequence(F.lit(0), F.lit(mix.max_repeats - 1))).alias("repeat")
    entries = sizes.filter("size > 0").join(goals, sizes["source"].eqNullSafe(goals["source"])).select("row", "doc_id", "size", "k", "goal", "source_size", repeats)
    entries = entries.filter(F.col("repeat") * F.col("source_size") < F.col("goal"))
    entries = entries.withColumn("key", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("repeat").cast("string"))))
    entries = entries.withColumn("bucket", F.substring("key", 1, mix.bucket_digits))
    buckets = entries.groupBy("k", "repeat", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("k").orderBy("repeat", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("k", "repeat", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("bucket_begin"))
    within = Window.partitionBy("k", "repeat", "bucket").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = entries.join(buckets, ["k", "repeat", "bucket"]).withColumn("begin", F.col("bucket_begin") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    return placed.filter("begin < goal").select("row", "k", "repeat", "begin", F.least("size", F.col("goal") - F.col("begin")).alias("size"))


def mixed(sizes: DataFrame, mix: Mix = Mix()) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets, and the mix: slot, k, block, row, repeat, low, high (words of the document).

    sizes: row (unique), doc_id, source, size. It is read several times, so it should be a written table.
    """
    goals = materialise(targets(sizes, mix), "mix-targets")
    pieces = streams(sizes, goals, mix)
    first, last = F.floor(F.col("begin") / mix.block), F.floor((F.col("begin") + F.col("size") - 1) / mix.block)
    pieces = pieces.select("*", F.explode(F.sequence(first, last)).alias("block"))
    low = F.greatest(F.lit(0), F.col("block") * mix.block - F.col("begin")).alias("low")
    high = F.least("size", (F.col("block") + 1) * mix.block - F.col("begin")).alias("high")
    pieces = pieces.select("k", "block", "row", "repeat", low, high)
    return goals, slots(goals, mix).join(pieces, ["k", "block"])


def document_sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """A written table of row, doc_id, source and size."""
    return materialise(docs.select(F.monotonically_increasing_id().alias("row"), col(doc_id).alias("doc_id"), col(source).alias("source"), n_words(col(text)).alias("size")), "mix-sizes")


def mix_report(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target, taken of each document."""
    sizes = document_sizes(docs)
    goals, schedule = mixed(sizes, mix)
    taken = schedule.groupBy("row").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    return (
        sizes.join(taken, "row", "left").join(goals, sizes["source"].eqNullSafe(goals["source"]))
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word; it has more than n."""
    trimmed = F.btrim(text, F.lit(SPACES))
    rest = F.get(F.split(trimmed, WORD_GAP, (n + 1).cast("int")), n.cast("int"))
    return F.rtrim(F.left(trimmed, F.length(trimmed) - F.length(rest)), F.lit(SPACES))


def mix_documents(docs: DataFrame, mix: Mix = Mix(), text: str = "text", source: str = "source") -> DataFrame:
    """The documents that the mix takes, once per repeat, the last of a source cut to the words taken; the columns of docs.

    A cut text's n_chars, where docs has that column, is set to its length. Documents without words are left out.
    """
    row, size = fresh(docs, "_row", "_size")
    # One written copy ties each row's text to its number.
    numbered = materialise(docs.withColumn(row, F.monotonically_increasing_id()).withColumn(size, n_words(col(text))), "mix-docs")
    identity = col("doc_id") if "doc_id" in docs.columns else col(row)
    sizes = numbered.select(col(row).alias("row"), identity.alias("doc_id"), col(source).alias("source"), col(size).alias("size"))
    _, schedule = mixed(sizes, mix)
    words, repeat, key = fresh(numbered, "_words", "_repeat", "_key")
    taken = schedule.groupBy("row", "repeat").agg(F.sum(F.col("high") - F.col("low")).alias("words")).toDF(key, repeat, words)
    out = numbered.join(taken, col(row) == col(key))
    cut = col(words) < col(size)
    changed = {text: F.when(cut, first_words(col(text), col(words))).otherwise(col(text))}
    if "n_chars" in docs.columns and text != "n_chars":
        changed["n_chars"] = F.when(cut, F.length(changed[text])).otherwise(col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*(changed.get(c, col(c)).alias(c) for c in docs.columns))
