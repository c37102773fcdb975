"""Shared helpers: table readers, scratch tables, let-bound expressions."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisit.session import remove_dir, shared_dir

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_GAP = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the whole cluster shares."""
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    if _recording:
        _recording[-1].append(path)
    return path


_recording: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Within, paths of scratch tables are added to `paths`."""
    _recording.append(paths)
    try:
        yield
    finally:
        _recording.pop()


def release(paths: list[str], docs: DataFrame) -> None:
    """Remove scratch tables that `docs` does not read; they go from the list as well."""
    used = [unquote(f) for f in docs.inputFiles()]
    for path in [p for p in paths if not any(p.rsplit("/", 1)[1] in f for f in used)]:
        remove_dir(docs.sparkSession, path)
        paths.remove(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: work is done once, and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches, some rows at a time: what a task makes of them as Python objects stays small."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of the frame, whatever extra columns it has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value evaluated once, also where body uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def fields(**kinds: str) -> T.StructType:
    """A schema from name=type pairs."""
    return T._parse_datatype_string(", ".join(f"`{k}` {v}" for k, v in kinds.items()))


def running(df: DataFrame, keys: list[str], bucket: Column, order: list[str], value: Column, into: str) -> DataFrame:
    """The sum of `value` over all rows of the same keys that come before a row, by bucket and then by order.

    Two levels: within (keys, bucket), and over bucket totals, so a task holds a bucket and not a key. The
    bucket must spread a key's rows; `order` must be unique among them.
    """
    b, v, total, earlier = fresh(df, "_bucket", "_value", "_total", "_earlier")
    df = df.withColumn(b, bucket).withColumn(v, value)
    by = [*keys, b]
    totals = df.groupBy(*by).agg(F.sum(v).alias(total))
    over = Window.partitionBy(*keys) if keys else Window.partitionBy()
    totals = totals.select(*by, F.coalesce(F.sum(total).over(over.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(earlier))
    within = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.join(totals, by).withColumn(into, (F.col(earlier) + F.coalesce(F.sum(v).over(within), F.lit(0))).cast("long")).drop(b, v, earlier)


def least_hashed(ids: DataFrame, name: str, most: int) -> list[tuple[int, object]]:
    """(hash, id) of at most `most` of the ids, which are distinct: those of least hash, in its order.

    A hash limit that the count gives lets through little more than `most` ids; only these come to the driver.
    """
    total, margin = ids.count(), most + 6 * math.sqrt(most) + 50
    share, found = 0.0, []
    while share < 1 and len(found) < min(most, total):
        share = min(1.0, margin / max(total, 1)) if not share else min(1.0, 2 * share)
        limit = int((share - 0.5) * 2**64) if share < 1 else 2**63 - 1
        hashed = ids.select(F.xxhash64(col(name)).alias("h"), col(name).alias("id"))
        found = [(r["h"], r["id"]) for r in hashed.filter(F.col("h") <= F.lit(limit)).collect()]
    return sorted(found)[:most]


#: What each step takes from a text, in this order; what is left is "other".
CHARACTER_STEPS = (
    ("plain_lower", "[a-z]+"),
    ("space", r"[\x20\x09-\x0D]+"),
    ("other_lower", r"\p{Ll}+"),
    ("upper", r"\p{Lu}+"),
    ("other_letter", r"\p{L}+"),
    ("digit", r"\p{N}+"),
    ("symbol", "[#*$%&|<>]+"),
)


def character_counts(df: DataFrame, text: str) -> tuple[DataFrame, dict[str, Column], list[str]]:
    """The frame with the texts that are left after each step, the count of each class, and the added columns.

    Each step's text is a column that is used twice, so that Spark evaluates it once; they get short quickly.
    """
    names = fresh(df, *(f"_without_{name}" for name, _ in CHARACTER_STEPS))
    left, counts = text, {}
    for (name, pattern), rest in zip(CHARACTER_STEPS, names):
        df = df.withColumn(rest, F.regexp_replace(col(left), pattern, ""))
        counts[name] = F.length(col(left)) - F.length(col(rest))
        left = rest
    counts["other"] = F.length(col(left))
    return df, counts, names
