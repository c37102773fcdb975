"""DartMinHash: near-duplicate detection by sparse weighted signatures and banded joining.

Elements are runs of five words. Each element has a plane of random darts that depends on its hash alone, one
dart to a unit of area on average, drawn cell by cell; a dart has a rank, a height and a coordinate of the
signature. A text is hit by the darts of its elements that lie below the elements' weights, and its signature
holds the hit of lowest rank for each coordinate: two texts agree on a coordinate with the probability of
their weighted Jaccard similarity. Ranks need be looked at only up to a bound in inverse proportion to the
text's total weight, so a text costs about as many darts as the signature has coordinates, times a logarithm,
plus one cell for each element; texts with a coordinate that nothing hits are done again with twice the bound.

Signatures are joined by bands. Equal texts are first made one class, so that copies cost one signature row.
Within a bucket each class is compared with the bucket's centre, the class that meets most others over all its
buckets, as a common source does: a class first with the first of its buckets' centres, then with the others that
this has not put into its component. Where that has not put a bucket's classes into one
component, an exact prefix filter finds the other pairs that may be near; no bucket is expanded into all its
pairs. All similarities are checked on the elements themselves.
Links (similarity of at least `similarity`) make components by min-label steps on DataFrames.

`weights`: "set" gives each different element the weight 1, so that similarity is plain Jaccard; "count" its
count in the text. Null texts are empty. Texts without words have no elements: they are near only to equal
texts. A text of fewer than five words is one element. Repeated rows are copies. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisit.llm.common import col, fresh, materialise, row_slices
from revisit.llm.hashing import distinct, mix, runs, slices, text_bytes, word_hashes


@dataclass(frozen=True)
class Near:
    """bands * rows coordinates: a pair of similarity 0.8 shares a band with probability 0.9998."""

    words: int = 5
    similarity: float = 0.8
    bands: int = 22
    rows: int = 5
    weights: str = "set"


_CDF = np.cumsum([np.exp(-1.0)] + [np.exp(-1.0) / np.prod(np.arange(1.0, k + 1)) for k in range(1, 20)])


def _unit(h: np.ndarray) -> np.ndarray:
    """Numbers from 0 up to 1 from the high bits of hashes."""
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(hashes: np.ndarray, owner: np.ndarray, weights: np.ndarray, n_texts: int, k: int) -> np.ndarray:
    """n_texts x k signatures; rows of texts without elements are 0. Elements must be sorted by owner."""
    out = np.zeros((n_texts, k), np.uint64)
    total = np.bincount(owner, weights, n_texts)
    bound = np.where(total > 0, k * (np.log(k) + 3.0) / np.maximum(total, 1e-300), 0.0)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        pick = np.isin(owner, todo) if len(todo) < n_texts else np.ones(len(owner), bool)
        e, d, w = hashes[pick], owner[pick], weights[pick]
        # A cell is one unit of rank by one of height.
        high, deep = np.ceil(w).astype(np.int64), np.ceil(bound[d]).astype(np.int64)
        n = high * deep
        at = np.repeat(np.arange(len(e)), n)
        j = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        level, block = j // deep[at], j % deep[at]
        cell = mix(e[at] ^ mix((level.astype(np.uint64) << np.uint64(32)) ^ block.astype(np.uint64)))
        darts = np.searchsorted(_CDF, _unit(cell), side="right")
        hit = np.repeat(np.arange(len(cell)), darts)
        i = np.arange(len(hit)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(cell[hit] + mix(i.astype(np.uint64) + np.uint64(1)))
        rank = block[hit] + _unit(dart)
        who = at[hit]
        keep = (rank < bound[d[who]]) & (level[hit] + _unit(mix(dart ^ np.uint64(0x5DEECE66D))) < w[who])
        dart, rank, text = dart[keep], rank[keep], d[who[keep]]
        place = (mix(dart ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(k)).astype(np.int64)
        slot = text * k + place
        order = np.lexsort((rank, slot))
        slot, dart = slot[order], dart[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        out.reshape(-1)[slot[first]] = dart[first]
        filled = np.bincount(slot[first] // k, minlength=n_texts)
        todo = todo[filled[todo] < k]
        bound[todo] *= 2
    return out


def elements(texts: pa.Array, near: Near) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and weight of each different element, by text and hash."""
    hashes, owner, counts = distinct(*runs(*word_hashes(*text_bytes(texts)), near.words))
    return hashes, owner, (np.ones(len(hashes)) if near.weights == "set" else counts.astype(np.float64))


def banded(numbered: DataFrame, row: str, text: str, near: Near) -> DataFrame:
    """row, text_hash (sha-256), bands: one key per band, none for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for batch in batches:
            for lo, part in slices(batch.column(1)):
                hashes, owner, weights = elements(part, near)
                signed = signatures(hashes, owner, weights, len(part), near.bands * near.rows).reshape(len(part), near.bands, near.rows)
                key = np.full((len(part), near.bands), 0, np.uint64)
                for r in range(near.rows):
                    key = mix(key * np.uint64(3) + signed[:, :, r])
                some = np.bincount(owner, minlength=len(part)) > 0
                offsets = np.concatenate([[0], np.cumsum(some * near.bands)]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(key[some].reshape(-1).view(np.int64)))
                digests = pa.array([sha256((x or "").encode()).digest() for x in part.to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(part)), digests, bands], ["row", "text_hash", "bands"])

    return numbered.select(col(row), col(text)).mapInArrow(run, "row long, text_hash binary, bands array<long>")


def element_sets(texts: DataFrame, near: Near) -> DataFrame:
    """row, hashes (64-bit, ascending), weights (32-bit) of texts (row, text), as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, part in slices(batch.column(1)):
                hashes, owner, weights = elements(part, near)
                cuts = np.searchsorted(owner, np.arange(len(part) + 1))
                h = [hashes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                w = [weights[a:b].astype("<f4").tobytes() if near.weights != "set" else b"" for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(part)), pa.array(h, pa.binary()), pa.array(w, pa.binary())], ["row", "hashes", "weights"])

    return texts.mapInArrow(run, "row long, hashes binary, weights binary")


def similarity(a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity; a and b ascend."""
    if not len(a) or not len(b):
        return 0.0
    at = np.searchsorted(a, b)
    same = a[np.minimum(at, len(a) - 1)] == b
    both = np.minimum(wa[at[same]], wb[same]).sum()
    return float(both / (wa.sum() + wb.sum() - both))


def verified(pairs: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the bound, with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            a, b, ha, hb, wa, wb = (c.to_pylist() for c in batch.columns)
            out = np.empty(len(a))
            for i in range(len(a)):
                x, y = np.frombuffer(ha[i], "<u8"), np.frombuffer(hb[i], "<u8")
                u = np.frombuffer(wa[i], "<f4") if wa[i] else np.ones(len(x))
                v = np.frombuffer(wb[i], "<f4") if wb[i] else np.ones(len(y))
                out[i] = similarity(x, y, u, v)
            keep = out >= near.similarity
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], ["a", "b", "similarity"]).filter(pa.array(keep))

    one = sets.select(F.col("row").alias("a"), F.col("hashes").alias("ha"), F.col("weights").alias("wa"))
    two = sets.select(F.col("row").alias("b"), F.col("hashes").alias("hb"), F.col("weights").alias("wb"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "ha", "hb", "wa", "wb")
    return both.mapInArrow(run, "a long, b long, similarity double")


def prefix_pairs(open_: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """Pairs (a, b) of open classes (class_row, component) that may be similar and are in different components.

    An exact filter, without signatures. Each class's elements are put in one global order, the rarest first.
    Two sets of n >= m elements with similarity s share at least s / (1 + s) * (n + m); so their first
    shared element stands early enough in both that so many can still follow. Near copies differ from their
    common source by rare elements, which come first, so those that are not similar enough seldom meet. The
    shorter side is joined by its size class, and the longer only with the classes its place allows.
    """
    share = near.similarity / (1 + near.similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            rows, hashes, weights = (c.to_pylist() for c in batch.columns)
            some = [np.frombuffer(x, "<u8") for x in hashes]
            # A weight of w counts as w elements, numbered alike in all texts.
            times = [np.frombuffer(w, "<f4").astype(np.int64) if w else np.ones(len(x), np.int64) for x, w in zip(some, weights)]
            some = [x if near.weights == "set" else mix(np.repeat(x, t) ^ (np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)).astype(np.uint64)) for x, t in zip(some, times)]
            row = np.repeat(np.array(rows, np.int64), [len(x) for x in some])
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.concatenate(some).view(np.int64))], ["row", "hash"])

    wanted = sets.join(open_.select(F.col("class_row").alias("row")), "row", "left_semi").select("row", "hashes", "weights")
    each = materialise(wanted.mapInArrow(run, "row long, hash long"), "near-elements")
    often = each.groupBy("hash").agg(F.count("*").alias("often"))
    ordered = each.join(often, "hash").groupBy("row").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("often", "hash"))).alias("elements"))
    first = F.slice("elements", F.lit(1), (F.col("n") - F.ceil(F.col("n") * near.similarity - 1e-6) + 1).cast("int"))
    prefix = ordered.join(open_.withColumnRenamed("class_row", "row"), "row").select("row", "component", "n", F.posexplode(first).alias("place", "e"))
    prefix = materialise(prefix.filter("e.often > 1").select("row", "component", "n", "place", F.col("e.hash").alias("hash")), "near-prefixes")
    size_class = lambda n: F.floor(F.log(n.cast("double")) / F.lit(float(np.log(1.05)))).cast("int")
    low = F.ceil(F.col("n") * near.similarity - 1e-6)
    high = F.least(F.col("n"), F.floor((F.col("n") - F.col("place")) / share - F.col("n") + 1e-6))
    longer = prefix.withColumn("low", low).withColumn("high", high).filter("low <= high and high > 0")
    longer = longer.select(F.col("row").alias("x"), F.col("component").alias("cx"), "n", "place", "hash", F.explode(F.sequence(size_class(F.greatest(F.lit(1), F.col("low"))), size_class(F.col("high")))).alias("class"))
    shorter = prefix.filter(F.col("n") - F.col("place") >= 2 * share * F.col("n") - 1e-6)
    shorter = shorter.select(F.col("row").alias("y"), F.col("component").alias("cy"), F.col("n").alias("m"), F.col("place").alias("at"), "hash", size_class(F.col("n")).alias("class"))
    left = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("at"))
    fits = (F.col("cx") != F.col("cy")) & ((F.col("n") > F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("x") < F.col("y")))) & (left >= share * (F.col("n") + F.col("m")) - 1e-6)
    met = longer.join(shorter.hint("merge"), (longer["hash"] == shorter["hash"]) & (longer["class"] == shorter["class"]) & fits)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of a graph given by edges a, b.

    Each round, every node takes the least label around it and then, twice, its label's label, until nothing changes.
    """
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "near-labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("low"))
        lowered = labels.join(around, labels["node"] == around["a"]).select("node", F.col("component").alias("old"), F.least("component", "low").alias("component"))
        lowered = materialise(lowered, "near-lowered")
        roots = lowered.select(F.col("node").alias("component"), F.col("component").alias("root"))
        jumped = materialise(lowered.join(roots, "component").select("node", "old", F.col("root").alias("component")), "near-jumped")
        roots = jumped.select(F.col("node").alias("component"), F.col("component").alias("root"))
        jumped = materialise(jumped.join(roots, "component").select("node", "old", F.col("root").alias("component")), "near-labels")
        labels = jumped.select("node", "component")
        if jumped.filter("old <> component").isEmpty():
            return labels


def merged(found: DataFrame, more: DataFrame) -> DataFrame:
    """The components after further edges (a, b): only the components that these join are worked on."""
    of = found.select(F.col("node").alias("n"), F.col("component").alias("c"))
    ends = more.join(of, F.col("a") == F.col("n"), "left").select(F.coalesce("c", "a").alias("a"), "b")
    ends = ends.join(of, F.col("b") == F.col("n"), "left").select("a", F.coalesce("c", "b").alias("b")).filter("a <> b")
    joined = components(ends)
    into = joined.select(F.col("node").alias("n"), F.col("component").alias("c"))
    known = found.join(into, F.col("component") == F.col("n"), "left").select("node", F.coalesce("c", "component").alias("component"))
    return known.unionByName(joined.join(found.select("node"), "node", "left_anti"))


def apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends lie in different components; a node that found does not hold is one of its own."""
    of = found.select(F.col("node").alias("n"), F.col("component").alias("c"))
    ends = pairs.join(of, F.col("a") == F.col("n"), "left").select("a", "b", F.coalesce("c", "a").alias("ca"))
    ends = ends.join(of, F.col("b") == F.col("n"), "left").select("a", "b", "ca", F.coalesce("c", "b").alias("cb"))
    return ends.filter("ca <> cb").select("a", "b")


def near_groups(numbered: DataFrame, row: str, doc_id: str, text: str, near: Near = Near()) -> DataFrame:
    """row, doc_id, class_row (least row of the equal texts), group_row (that of the near ones): one row per document.

    numbered: a written table. Least: by doc_id, then by row.
    """
    signed = materialise(banded(numbered, row, text, near), "near-signatures")
    copies = signed.groupBy("text_hash").agg(F.min("row").alias("class_row"), F.first("bands").alias("bands"))
    classes = materialise(copies, "near-classes")
    buckets = classes.filter(F.size("bands") > 0).select("class_row", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    members = materialise(buckets.join(shared, ["band", "key"]), "near-members")
    # First comes the class that meets most others; of several, the least.
    met = members.groupBy("class_row").agg(F.struct((-F.sum("n")).alias("met"), F.col("class_row").alias("row")).alias("rank"))
    ranked = members.join(met, "class_row")
    centres = ranked.groupBy("band", "key").agg(F.min("rank").alias("centre"))
    stars = ranked.join(centres, ["band", "key"]).filter("class_row <> centre.row").select("centre", F.col("class_row").alias("b")).distinct()
    stars = materialise(stars.select("centre", F.col("centre.row").alias("a"), "b"), "near-stars")
    # A class has up to `bands` centres; the first of them first, as that mostly makes the others needless.
    nearest = stars.groupBy("b").agg(F.min("centre").alias("centre")).select(F.col("centre.row").alias("a"), "b")
    stars = stars.select("a", "b")
    candidates = members.select("class_row").distinct()
    # The list of candidates grows with the corpus: joined by shuffle at every size.
    texts = numbered.select(col(row).alias("row"), col(text).alias("text")).join(candidates.hint("merge"), F.col("row") == F.col("class_row"), "left_semi")
    sets = materialise(element_sets(texts, near), "near-sets")
    found = components(materialise(verified(nearest, sets, near), "near-links"))
    others = materialise(apart(stars.join(nearest, ["a", "b"], "left_anti"), found), "near-apart")
    linked = materialise(verified(others, sets, near), "near-links")
    if not linked.isEmpty():
        found = merged(found, linked)
    # What a bucket still holds in several components is compared across them.
    placed = members.join(found.withColumnRenamed("node", "class_row"), "class_row", "left").withColumn("component", F.coalesce("component", "class_row"))
    split = placed.groupBy("band", "key").agg(F.min("component").alias("lowest"), F.max("component").alias("highest")).filter("lowest < highest").select("band", "key")
    open_ = materialise(placed.join(split, ["band", "key"]).select("class_row", "component").distinct(), "near-open")
    compared = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = materialise(prefix_pairs(open_, sets, near), "near-pairs").join(compared, ["a", "b"], "left_anti")
    more = materialise(verified(more, sets, near), "near-links")
    if not more.isEmpty():
        found = merged(found, more)
    grouped = classes.join(found.withColumnRenamed("node", "class_row"), "class_row", "left")
    grouped = grouped.select("text_hash", "class_row", F.coalesce("component", "class_row").alias("group_row"))
    ids = numbered.select(col(row).alias("row"), col(doc_id).alias("doc_id"))
    return signed.select("row", "text_hash").join(grouped, "text_hash").join(ids, "row").select("row", "doc_id", "class_row", "group_row")


def _kept(groups: DataFrame) -> DataFrame:
    """class_id and group_id, the least doc_id of the equal and of the near texts, and whether the row is its group's first."""
    first = F.min(F.struct(F.col("doc_id"), F.col("row")))
    heads = groups.groupBy("group_row").agg(first.alias("head"))
    classes = groups.groupBy("class_row").agg(F.min("doc_id").alias("class_id"))
    return groups.join(heads, "group_row").join(classes, "class_row").select("row", "doc_id", "class_id", F.col("head.doc_id").alias("group_id"), (F.col("row") == F.col("head.row")).alias("kept"))


def number(docs: DataFrame) -> tuple[DataFrame, str]:
    """A written copy of the documents with a row number, which ties each row to its number; and that column's name."""
    (row,) = fresh(docs, "_row")
    return materialise(docs.withColumn(row, F.monotonically_increasing_id()), "near-docs"), row


def near_report(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """doc_id, class_id, group_id, kept of all documents (doc_id, text)."""
    numbered, row = number(docs.select("doc_id", "text"))
    return _kept(near_groups(numbered, row, "doc_id", "text", near)).select("doc_id", "class_id", "group_id", "kept")


def near_dedup(docs: DataFrame, near: Near = Near(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id, with the columns of docs."""
    numbered, row = number(docs)
    kept = _kept(near_groups(numbered, row, doc_id, text, near)).filter("kept").select(F.col("row").alias("_kept"))
    return numbered.join(kept, col(row) == F.col("_kept"), "left_semi").select(*(col(c) for c in docs.columns))
