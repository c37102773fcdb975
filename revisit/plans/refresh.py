"""One refresh: reports -> clean tables -> quality gate -> load checks -> gold extracts.

Each stage stops the run when it fails. Clean tables and visit days are written once and
read back, so nothing above them is computed twice and a lost executor costs only the
tasks it held.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisit.config import Settings
from revisit.operators import quality, visits
from revisit.plans.cleaning import clean_tables, numbered_sales, reject_counters, rejected_cells
from revisit.plans.gold import dashboard_tables, gold_tables, register_views, require_views
from revisit.schemas import report_columns
from revisit.session import remove_dir, shared_dir
from revisit.sources import files, records, reports, store


class GateError(RuntimeError):
    """The quality gate found errors; the report was written, nothing was published."""

    def __init__(self, problems: list[str], report: dict, findings: str):
        super().__init__("; ".join([*problems, f"all findings: {findings}"]))
        self.problems = problems
        self.report = report


@dataclass(frozen=True)
class RefreshConfig:
    """Paths are folders or globs of report dumps per dataset, and the output root."""

    clients: str
    appointments: str
    sales: str
    root: str
    delimiter: str = ","
    # Also write the clean tables as CSV below the version.
    write_csv: bool = False
    # Published versions to keep, older ones go after a run; None keeps all.
    keep_versions: int | None = None
    # What the names of the views begin with.
    view_prefix: str = "revisit_"
    settings: Settings = field(default_factory=Settings)

    def inputs(self) -> dict[str, str]:
        return {"clients": self.clients, "appointments": self.appointments, "sales": self.sales}


@dataclass(frozen=True)
class RefreshResult:
    version: str
    report: dict
    row_counts: dict[str, int]
    gold: dict
    # What was loaded: rows per table, distinct transactions, the status histogram.
    summary: DataFrame


def refresh(spark: SparkSession, config: RefreshConfig) -> RefreshResult:
    """Run all stages. The scratch copies, which hold client names, go at the end, also of a failed run.

    A failed run leaves no tables; its findings and report lie below `failed`.
    """
    version = store.new_version()
    scratch = f"{shared_dir(spark)}/revisit-raw/{version}"
    try:
        result = _refresh(spark, config, version, scratch)
    except Exception:
        store.discard(spark, config.root, version)
        raise
    finally:
        remove_dir(spark, scratch)
    if config.keep_versions is not None:
        store.vacuum(spark, config.root, config.keep_versions)
    return result


def _refresh(spark: SparkSession, config: RefreshConfig, version: str, scratch: str) -> RefreshResult:
    settings, root = config.settings, config.root
    seen = store.pointer(spark, root)

    def place(name: str) -> str:
        return store.version_path(root, version, name)

    reports.require_sources(spark, list(config.inputs().values()))
    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("error").parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    # The text is read once; headers are searched once, and serve metadata, checks and rows.
    staged = {name: records.stage(reports.read_lines(spark, path), config.delimiter, scratch) for name, path in config.inputs().items()}
    lines = {name: s.lines for name, s in staged.items()}
    found = {name: written(reports.heads(f, settings, config.delimiter), f"{name}_heads") for name, f in lines.items()}
    metadata = {name: reports.report_metadata(f, settings, config.delimiter, found[name]) for name, f in lines.items()}
    landed = {
        name: reports.land(
            frame, report_columns(name), f"{scratch}/{name}", settings, config.delimiter, found[name], reject_counters(name, settings)
        )
        for name, frame in lines.items()
    }
    raw = {name: rows.rows for name, rows in landed.items()}
    data = {name: df.where(~F.col("is_total")) for name, df in raw.items()}
    data["sales"] = numbered_sales(data["sales"], scratch)
    stored, handed = store.stage(clean_tables(data, settings), root, version)
    if config.write_csv:
        for name, df in stored.items():
            files.write_clean_csv(df, place(f"csv/{name}_clean"))

    findings = quality.validate_clients(stored["clients"])
    findings = findings.unionByName(quality.validate_appointments(stored["appointments"], settings))
    findings = findings.unionByName(quality.validate_sales(stored["sales"]))
    for name, df in raw.items():
        findings = findings.unionByName(_empty_columns(df, name)).unionByName(_missing_headers(found[name], name))
        findings = findings.unionByName(_unclosed_quotes(staged[name].unclosed, name))
    findings = findings.unionByName(rejected_cells(spark, {name: rows.counts for name, rows in landed.items()}))
    findings.write.mode("error").parquet(place("findings"))
    findings = spark.read.parquet(place("findings"))
    report = files.write_validation_report(
        spark, place("validation_report"), str(config.inputs()), place(""), findings, metadata
    )
    problems = quality.findings_text(quality.failed(findings))
    if problems:
        raise GateError(problems, report, store.failed_path(root, version, "findings"))
    store.check_load(stored, handed, settings)
    quality.load_summary(stored).write.mode("error").parquet(place("load_summary"))

    days = visits.visit_days(visits.analysis_appointments(stored["appointments"], settings), settings)
    days.write.mode("error").parquet(place("visit_days"))
    days = spark.read.parquet(place("visit_days"))

    register_views(stored["appointments"], stored["clients"], settings, days, prefix=config.view_prefix)
    require_views(spark, prefix=config.view_prefix)
    gold = gold_tables(stored["appointments"], stored["clients"], settings, days)
    for name, df in gold.items():
        df.write.mode("error").parquet(place(f"gold/{name}"))
    gold = {name: spark.read.parquet(place(f"gold/{name}")) for name in gold}
    row_counts = {}
    for name, df in gold.items():
        files.write_gold_csv(df.orderBy(df.columns[0]), place(f"export/{name}"))
        row_counts[name] = df.count()
    files.write_gold_csv(files.data_dictionary(spark, settings), place("export/data_dictionary"))
    for name, df in dashboard_tables(gold, settings).items():
        df.write.mode("error").parquet(place(f"dashboard/{name}"))

    store.publish(spark, root, version, seen)
    return RefreshResult(version, report, row_counts, gold, spark.read.parquet(place("load_summary")))


def _missing_headers(found: DataFrame, dataset: str) -> DataFrame:
    return reports.missing_headers(found).select(
        F.lit(dataset).alias("dataset"),
        F.lit("error").alias("kind"),
        F.lit("file_without_header").alias("name"),
        F.lit(1).cast("long").alias("findings"),
        F.col("source_file").alias("detail"),
    )


def _unclosed_quotes(unclosed: DataFrame, dataset: str) -> DataFrame:
    return unclosed.select(
        F.lit(dataset).alias("dataset"),
        F.lit("warning").alias("kind"),
        F.lit("unclosed_quote").alias("name"),
        F.col("n_lines").alias("findings"),
        F.url_decode(F.replace(F.element_at(F.split("source_file", "/"), -1), F.lit("+"), F.lit("%2B"))).alias("detail"),
    )


def _empty_columns(raw: DataFrame, dataset: str) -> DataFrame:
    empty = reports.empty_columns(reports.column_counts(raw, report_columns(dataset)))
    return empty.select(
        F.lit(dataset).alias("dataset"),
        F.lit("error").alias("kind"),
        F.lit("empty_column").alias("name"),
        F.lit(1).cast("long").alias("findings"),
        F.col("column").alias("detail"),
    )
