"""The table store: full rebuilds written as a new version, checked, then published.

Layout below `root`:  versions/<version>/<table>   Parquet tables of one rebuild
                      published/<number>           pointers: the version that became current with this number
                      failed/<version>             findings and report of a run that published nothing

A version becomes visible when its pointer is created, under the number after the one that the run
started from. A file is created only if it is not there yet, so of two runs that started from the same
version one publishes, and the other fails with `PublishConflict`; it can't hide what it has not seen.
A rebuild that fails its checks gets no pointer, and its tables go. `vacuum` removes old versions.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from revisit import schemas
from revisit.config import Settings
from revisit.operators.quality import foreign_key_violations, load_checks
from revisit.session import remove_dir

SAMPLE = 10  # offending keys that a failed load names
VERSION_TIME = "%Y%m%dT%H%M%S%f"
KEPT_OF_FAILED = ("findings", "validation_report", "validation_report_findings", "validation_report_sources")


class ContractError(ValueError):
    """A table lacks columns the store requires."""


class LoadError(RuntimeError):
    """Staged tables break a rule of the store; nothing was published."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


class PublishConflict(RuntimeError):
    """Another run published since this one started; nothing was published."""


@dataclass(frozen=True)
class Pointer:
    """The last number that was taken, and the version that is current; None before the first."""

    number: int
    version: str | None


def new_version() -> str:
    return f"{datetime.now(timezone.utc):{VERSION_TIME}}-{uuid.uuid4().hex[:8]}"


def version_path(root: str, version: str, table: str = "") -> str:
    return f"{root.rstrip('/')}/versions/{version}/{table}".rstrip("/")


def failed_path(root: str, version: str, name: str = "") -> str:
    return f"{root.rstrip('/')}/failed/{version}/{name}".rstrip("/")


def apply_contract(df: DataFrame, dataset: str, *more: Column) -> DataFrame:
    """Exactly the columns the store has, in order and type, after `more`; a missing one is an error."""
    missing = schemas.missing_columns(df.columns, dataset)
    if missing:
        raise ContractError(f"{dataset}: missing required columns {missing}")
    columns = list(more)
    for field in schemas.STORED[dataset]:
        value = F.col(field.name).cast(field.dataType)
        if field.dataType == schemas.DOUBLE:
            value = F.when(~F.isnan(value), value)  # not-a-number is stored as null
        columns.append(value.alias(field.name))
    return df.select(*columns)


def stage(
    tables: dict[str, DataFrame], root: str, version: str
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Write the tables as a new, unpublished version; return them as stored, and the rows handed over."""
    stored, handed = {}, {}
    for name, df in tables.items():
        out = apply_contract(df, name)
        if name == "sales":
            # Rows from reports come with dense numbers in load order; others get unique ones.
            given = F.col("sales_line_id") if "sales_line_id" in df.columns else F.monotonically_increasing_id()
            out = apply_contract(df, name, given.cast("long").alias("sales_line_id"))
        path = version_path(root, version, name)
        # Counted while writing, so that the plan above does not run twice.
        seen = Observation()
        out.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.mode("error").parquet(path)
        handed[name] = seen.get["n_rows"]
        stored[name] = df.sparkSession.read.parquet(path)
    return stored, handed


def publish(spark: SparkSession, root: str, version: str, seen: Pointer | None = None) -> Pointer:
    """Make a version current, if `seen` (by default what is current now) still is; else `PublishConflict`.

    Atomic where the file system creates a file only if there is none, as a cluster's file system does.
    """
    number = (pointer(spark, root) if seen is None else seen).number + 1
    fs, path = _file(spark, f"{root.rstrip('/')}/published/{number:012d}")
    content = json.dumps({"version": version, "published_at": datetime.now(timezone.utc).isoformat()})
    try:
        out = fs.create(path, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        raise PublishConflict(f"{version}: number {number} below {root} was taken by another run") from error
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    return Pointer(number, version)


def _file(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _file(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def published(spark: SparkSession, root: str) -> list[Pointer]:
    """All pointers in order; one whose run ended while it wrote has no version."""
    folder = f"{root.rstrip('/')}/published"
    numbers = [int(n) for n in _names(spark, folder) if n.isdigit()]
    if not numbers:
        return []
    said = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("number"), F.get_json_object("value", "$.version").alias("version"))
    versions = {int(r.number): r.version for r in said.collect() if r.number.isdigit()}
    return [Pointer(n, versions.get(n)) for n in sorted(numbers)]


def pointer(spark: SparkSession, root: str) -> Pointer:
    taken = published(spark, root)
    return Pointer(taken[-1].number if taken else 0, next((p.version for p in reversed(taken) if p.version), None))


def current_version(spark: SparkSession, root: str) -> str | None:
    return pointer(spark, root).version


def discard(spark: SparkSession, root: str, version: str) -> None:
    """Remove the tables of a run that published nothing; its findings and report go to `failed`."""
    for name in KEPT_OF_FAILED:
        fs, path = _file(spark, version_path(root, version, name))
        if fs.exists(path):
            _, target = _file(spark, failed_path(root, version, name))
            fs.mkdirs(target.getParent())
            fs.rename(path, target)
    remove_dir(spark, version_path(root, version))


def vacuum(spark: SparkSession, root: str, keep: int = 2, unpublished_for: timedelta = timedelta(days=1)) -> list[str]:
    """Remove all but the last `keep` published versions, and unpublished ones that started `unpublished_for` ago and earlier.

    Runs that are still going on are younger. Returns the versions removed.
    """
    known = [p.version for p in published(spark, root) if p.version]
    kept = set(list(dict.fromkeys(reversed(known)))[: max(keep, 1)])
    limit = f"{datetime.now(timezone.utc) - unpublished_for:{VERSION_TIME}}"
    removed = [v for v in _names(spark, f"{root.rstrip('/')}/versions") if v not in kept and (v in known or v.split("-")[0] <= limit)]
    for version in removed:
        remove_dir(spark, version_path(root, version))
    return removed


def read_table(spark: SparkSession, root: str, table: str, version: str | None = None) -> DataFrame:
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing published below {root}")
    return spark.read.parquet(version_path(root, version, table))


def load(
    tables: dict[str, DataFrame], root: str, settings: Settings = Settings(), version: str | None = None
) -> dict[str, DataFrame]:
    """Stage the tables, run every load check on what was stored, and publish if all hold."""
    spark = next(iter(tables.values())).sparkSession
    version, seen = version or new_version(), pointer(spark, root)
    try:
        stored, handed = stage(tables, root, version)
        check_load(stored, handed, settings)
        publish(spark, root, version, seen)
    except Exception:
        discard(spark, root, version)
        raise
    return stored


def check_load(stored: dict[str, DataFrame], handed: dict[str, int], settings: Settings = Settings()) -> None:
    # A fixed number of rules, one row each.
    broken = load_checks(stored, handed, settings).where(F.col("violations") > 0).collect()
    if broken:
        raise LoadError(sorted(_said(r, stored) for r in broken))


def _said(broken: Row, stored: dict[str, DataFrame]) -> str:
    text = f"{broken.table_name}: {broken.rule} broken by {broken.violations} rows"
    if broken.rule != "client_key_known":
        return text
    orphans = foreign_key_violations(stored[broken.table_name], stored["clients"]).orderBy("client_key").limit(SAMPLE)
    return f"{text}, first keys: {', '.join(r.client_key for r in orphans.collect())}"
