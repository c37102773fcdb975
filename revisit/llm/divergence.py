"""Quality rules: how far a text's histograms diverge from those of its language.

Two histograms per text, over classes of characters and over common words (between white space, in lower case;
the first bin is all other words), are compared with the
histograms of all texts of the same language by Jensen-Shannon distance (base 2, 0 to 1). A text that is
too short for a histogram isn't judged by it. Base counts (symbols, repeated lines and words) come along.

Everything is row-local but for the references, one small row per language of `COMMON_WORDS` and one for
the rest. Nulls: a null text has no words; a null or unknown language is compared with the rest. Repeated rows are
judged each on their own. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisit.llm.common import SPACES, WORD_GAP, character_counts, col, fresh, let, materialise

#: Frequent function words of each language, the default parameter.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "for", "that", "on", "with", "as", "was"),
    "de": ("der", "die", "und", "das", "von", "den", "zu", "mit", "ein", "nicht", "ist", "in"),
    "fr": ("le", "la", "les", "de", "des", "et", "du", "un", "une", "que", "qui", "pour"),
    "es": ("el", "la", "los", "de", "que", "y", "en", "un", "por", "con", "para", "del"),
}
REST = "*"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
CLASSES = ("plain_lower", "other_lower", "upper", "other_letter", "digit", "symbol", "other", "space")


@dataclass(frozen=True)
class Limits:
    """When a text fails. Distances are Jensen-Shannon, from 0 to 1."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_class_distance: float = 0.3
    min_class_chars: int = 200
    max_word_distance: float = 0.2
    min_histogram_words: int = 200
    common_words: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(COMMON_WORDS))


def _covered(positions: Column) -> Column:
    """Words covered by windows of three that begin at these ascending positions."""
    n = F.size(positions)
    gaps = F.zip_with(F.slice(positions, F.lit(1), n - 1), F.slice(positions, F.lit(2), n - 1), lambda a, b: F.least(F.lit(3), b - a))
    return F.when(n == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3), lambda total, gap: total + gap))


def repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more, the first time included.

    Windows are compared by 64-bit hash. Clean texts are settled by one distinct count; texts with few
    repeated windows look each window up, those with many sort (hash, position) pairs.
    """

    def windows(w: Column) -> Column:
        return F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), F.lit(1), F.size(w) - 2)

    def by_lookup(h: Column, twice: Column) -> Column:
        return F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(twice, x), i)), lambda i: i.isNotNull())

    def by_sort(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def marked(p: Column) -> Column:
            def twin(x: Column, k: Column) -> Column:
                before, after = F.get(p, k - 1)["h"], F.get(p, k + 1)["h"]
                return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

            return F.sort_array(F.transform(F.filter(p, twin), lambda x: x["i"]))

        return let(pairs, marked)

    def counted(h: Column) -> Column:
        in_order = F.sort_array(h)
        twice = let(in_order, lambda s: F.array_distinct(F.filter(s, lambda x, k: F.coalesce(x == F.get(s, k - 1), F.lit(False)))))
        positions = let(twice, lambda t: F.when(F.size(t) <= 16, by_lookup(h, t)).otherwise(by_sort(h)))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(positions, _covered))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(windows(words), counted)).cast("long")


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def statistics(docs: DataFrame, limits: Limits, text: str, lang: str, into: str) -> DataFrame:
    """The documents with a struct column of counts.

    Each intermediate value is a column of its own that later columns refer to more than once, so that Spark
    evaluates it once.
    """
    names = fresh(docs, "_text", "_trimmed", "_words", "_language", "_common", "_places")
    whole, trimmed, words, language, common, places = names
    out = docs.withColumn(whole, F.coalesce(col(text), F.lit("")))
    out = out.withColumn(language, F.when(col(lang).isin(*limits.common_words), col(lang)).otherwise(REST))
    listed = F.array().cast("array<string>")
    for name, some in limits.common_words.items():
        listed = F.when(col(language) == name, F.array(*map(F.lit, some))).otherwise(listed)
    out = out.withColumn(common, listed)
    out, counts, without = character_counts(out, whole)
    out = out.withColumn(trimmed, F.btrim(col(whole), F.lit(SPACES)))
    out = out.withColumn(words, F.when(col(trimmed) == "", F.array().cast("array<string>")).otherwise(F.split(col(trimmed), WORD_GAP, -1)))
    out = out.withColumn(places, F.transform(col(words), lambda w: F.array_position(col(common), F.lower(w))))
    n_common = max(len(x) for x in limits.common_words.values())
    stats = F.struct(
        F.size(col(words)).cast("long").alias("n_words"),
        repeat_words(col(words)).alias("n_repeat_words"),
        (F.length(col(whole)) - counts["space"]).cast("long").alias("word_chars"),
        counts["symbol"].cast("long").alias("n_symbols"),
        _duplicate_lines(col(whole)).alias("n_dup_lines"),
        col(language).alias("language"),
        F.array(*(counts[c].cast("double") for c in CLASSES)).alias("classes"),
        F.array(*(F.size(col(places)) - F.size(F.array_remove(col(places), F.lit(k))) for k in range(n_common + 1))).cast("array<double>").alias("common"),
    )
    return out.withColumn(into, stats).drop(*names, *without)


def references(counted: DataFrame, stats: str, n_common: int) -> DataFrame:
    """One row per language of the limits and one for the rest: the summed histograms of all its texts."""
    s = col(stats)
    sums = [F.sum(s["classes"][i]).alias(f"c{i}") for i in range(len(CLASSES))]
    sums += [F.sum(s["common"][i]).alias(f"w{i}") for i in range(n_common + 1)]
    summed = counted.groupBy(s["language"].alias("reference")).agg(*sums)
    return summed.select("reference", F.array(*(F.col(f"c{i}") for i in range(len(CLASSES)))).alias("classes"), F.array(*(F.col(f"w{i}") for i in range(n_common + 1))).alias("words"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts, arrays of one length; null if one is empty."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def of(n: Column) -> Column:
        shares = F.zip_with(p, q, lambda a, b: F.struct((a / n["p"]).alias("x"), (b / n["q"]).alias("y")))
        terms = F.transform(shares, lambda s: part(s["x"], (s["x"] + s["y"]) / 2) + part(s["y"], (s["x"] + s["y"]) / 2))
        return F.when((n["p"] > 0) & (n["q"] > 0), F.sqrt(F.greatest(F.lit(0.0), total(terms) / 2)))

    return let(F.struct(total(p).alias("p"), total(q).alias("q")), of)


def judged(docs: DataFrame, limits: Limits = Limits(), text: str = "text", lang: str = "lang", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """The documents (columns `keep`, or all) with a struct column of counts, distances and verdict; and that column's name."""
    stats, verdict, reference, ref_classes, ref_words = fresh(docs, "_stats", "quality_rules", "_reference", "_ref_classes", "_ref_words")
    n_common = max(len(x) for x in limits.common_words.values())
    counted = statistics(docs, limits, text, lang, stats).select(*(col(c) for c in (docs.columns if keep is None else keep)), stats)
    counted = materialise(counted, "quality-stats")
    refs = references(counted, stats, n_common).toDF(reference, ref_classes, ref_words)
    s = col(stats)
    joined = counted.join(F.broadcast(refs), s["language"] == col(reference), "left")
    base_failed = (s["n_words"] < limits.min_words) | (100 * s["n_repeat_words"] > limits.max_repeat_percent * s["n_words"])
    class_distance = F.when(s["word_chars"] >= limits.min_class_chars, js_distance(s["classes"], col(ref_classes)))
    long_enough = (s["n_words"] >= limits.min_histogram_words) & (s["language"] != REST)
    word_distance = F.when(long_enough, js_distance(s["common"], col(ref_words)))
    measured = joined.withColumn(
        verdict,
        F.struct(*(s[x].alias(x) for x in BASE), base_failed.alias("base_failed"), class_distance.alias("class_distance"), word_distance.alias("word_distance")),
    ).drop(stats, reference, ref_classes, ref_words)
    v = col(verdict)
    far = (F.coalesce(v["class_distance"], F.lit(0.0)) > limits.max_class_distance) | (F.coalesce(v["word_distance"], F.lit(0.0)) > limits.max_word_distance)
    return measured.withColumn(verdict, v.withField("kept", ~(v["base_failed"] | far))), verdict


def quality_filter(docs: DataFrame, limits: Limits = Limits(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that pass, with the columns they came with."""
    measured, verdict = judged(docs, limits, text, lang)
    return measured.filter(col(verdict)["kept"]).select(*(col(c) for c in docs.columns))
