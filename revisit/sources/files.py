"""CSV and JSON exchange: clean tables, gold extracts, the dictionary and the report."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisit import schemas
from revisit.config import Settings
from revisit.functions.calendar import parse_datetime
from revisit.functions.text import rejected, strip
from revisit.sources import records, reports
from revisit.sources.store import apply_contract

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_clean_csv(df: DataFrame, path: str) -> None:
    """Clean table as CSV with header. Written in parallel, one file per partition.

    As usual in CSV, a quote inside a quoted cell is doubled. White space around a text is kept. Null is an
    empty cell, an empty text a quoted one.
    """
    df.write.mode("overwrite").format("csv").options(header=True, timestampNTZFormat=TIME_FORMAT, **CSV).save(path)


@dataclass(frozen=True)
class CleanCsv:
    """rows: typed, under the column contract. rejects: column, n_cells that could not be read; a null column
    counts records with more or fewer cells than their header."""

    rows: DataFrame
    rejects: DataFrame


def scan_clean_csv(
    spark: SparkSession, path: str, dataset: str, settings: Settings = Settings(), folder: str | None = None
) -> CleanCsv:
    """Clean CSV under the column contract; identifiers stay text.

    Files may have more columns, in any order: they are read by name. Cells may hold line breaks, and files
    stay splittable. A cell that can't be read as its column's type is null and counted; cells that a
    record lacks are null. A text is an empty text where its cell is quoted, else null.
    """
    lines = records.stage(reports.read_lines(spark, path), ",", folder).lines
    first_line = replace(settings, header_row=0)
    found = records.written(reports.heads(lines, first_line), "heads", folder)
    headers = found.agg(F.array_distinct(F.flatten(F.collect_set("header")))).first()[0] or []
    fields = [f for f in schemas.STORED[dataset] if f.name in headers]
    cells = reports.data_rows(lines, first_line, ",", found, exact=True)
    raw = reports.pick(cells, [f.name for f in fields], [(F.size("cells") != F.size("header")).alias("_ragged")])
    typed = {f.name: _typed(F.col(f.name), f.dataType, settings) for f in fields}
    counts = [F.count_if(rejected(F.col(f.name), typed[f.name])).alias(f.name) for f in fields if f.dataType != schemas.TEXT]
    items = [F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("n_cells")) for f in fields if f.dataType != schemas.TEXT]
    items.append(F.struct(F.lit(None).cast("string").alias("column"), F.col("_ragged").alias("n_cells")))
    rejects = raw.agg(F.count_if("_ragged").alias("_ragged"), *counts).select(F.inline(F.array(*items)))
    return CleanCsv(apply_contract(raw.drop("_ragged").withColumns(typed), dataset), rejects)


def read_clean_csv(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """The rows of `scan_clean_csv`."""
    return scan_clean_csv(spark, path, dataset).rows


def _typed(text: Column, kind: T.DataType, settings: Settings) -> Column:
    if kind == schemas.MOMENT:
        return parse_datetime(text, settings.datetime_formats)
    if kind in (schemas.LONG, schemas.INT):
        # Whole numbers may carry a decimal point when the column also has gaps; they never pass a double.
        whole = F.regexp_extract(strip(text), r"^([+-]?\d+)(?:\.0*)?$", 1)
        return F.nullif(whole, F.lit("")).try_cast(kind)
    if kind == schemas.DOUBLE:
        return strip(text).try_cast(kind)
    return text


def write_gold_csv(df: DataFrame, path: str) -> None:
    """A gold table as one ordered CSV file; it has one row per month or band."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_gold_csv(spark: SparkSession, path: str, name: str, settings: Settings = Settings()) -> DataFrame:
    """A gold extract, ordered by its first column; its month is also given as a date."""
    schema = schemas.gold_schemas(settings)[name]
    df = spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
    first = schema[0].name
    if first in ("month", "cohort_month"):
        df = df.withColumn(f"{first}_start", F.to_date(F.concat(first, F.lit("-01"))))
    return df.orderBy(first)


def data_dictionary(spark: SparkSession, settings: Settings = Settings()) -> DataFrame:
    return spark.createDataFrame(schemas.data_dictionary(settings), "dataset string, field string, definition string")


def write_validation_report(
    spark: SparkSession,
    path: str,
    input_dir: str,
    output_dir: str,
    findings: DataFrame,
    metadata: dict[str, DataFrame],
    limit: int = 100,
) -> dict:
    """One JSON document with the run, and per dataset its sources, findings and metrics.

    All findings, and the sources of each dataset, are written in full as JSON lines beside it
    (`<path>_findings`, `<path>_sources/<dataset>`), by the executors. In the document a list with
    a data-dependent length (values of a histogram, source files) shows its first `limit` entries
    and the total number.
    """
    findings.write.mode("overwrite").json(f"{path}_findings")
    for name, frame in metadata.items():
        frame.write.mode("overwrite").json(f"{path}_sources/{name}")
    ranked = findings.withColumn(
        "entry",
        F.row_number().over(_per_check().orderBy(F.desc_nulls_last("findings"), F.asc_nulls_last("detail"))),
    ).withColumn("entries", F.count(F.lit(1)).over(_per_check()))
    shown = ranked.where(F.col("entry") <= limit).collect()
    datasets: dict[str, dict] = {}
    for r in shown:
        found = datasets.setdefault(r.dataset, {"rows": 0, "errors": [], "warnings": [], "metrics": {}})
        if r.kind == "rows":
            found["rows"] = r.findings
        elif r.kind == "metric":
            if r.name.endswith("_counts"):
                found["metrics"].setdefault(r.name, {})[str(r.detail)] = r.findings
            else:
                found["metrics"][r.name] = r.findings if r.detail is None else r.detail
        elif r.findings:
            text = f"{r.name}: {r.findings}" + (f" ({r.detail})" if r.detail is not None else "")
            found[f"{r.kind}s"].append(text)
        if r.entries > limit:
            found.setdefault("shortened", {})[r.name] = r.entries
    for name, frame in metadata.items():
        sources = frame.orderBy("source_file").limit(limit).collect()
        datasets.setdefault(name, {})["sources"] = [s.asDict() for s in sources]
        datasets[name]["output"] = name
        if (n_sources := frame.count()) > limit:
            datasets[name].setdefault("shortened", {})["sources"] = n_sources
    report = {
        "generated_at_utc": datetime.now(timezone.utc).isoformat(),
        "input_dir": input_dir,
        "output_dir": output_dir,
        "datasets": datasets,
    }
    text = spark.createDataFrame([(json.dumps(report, sort_keys=True),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(path)
    return report


def _per_check():
    return Window.partitionBy("dataset", "kind", "name")
