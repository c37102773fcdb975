"""One query per operator, over the given tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revisit import schemas
from revisit.functions import calendar, text
from revisit.operators import identity, monthly, presentation, quality, retention, visits
from revisit.plans import cleaning, gold
from revisit.session import remove_dir, shared_dir
from revisit.sources import files, records, reports
from workload import dumps, inputs
from workload.inputs import SETTINGS, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def _analysis(spark, sf_dir):
    return visits.analysis_appointments(inputs.appointments(spark, sf_dir), SETTINGS)


def _performance(spark, sf_dir):
    return monthly.monthly_performance(_analysis(spark, sf_dir), inputs.clients(spark, sf_dir), SETTINGS)


def _retention(spark, sf_dir):
    return retention.client_retention(_analysis(spark, sf_dir), inputs.clients(spark, sf_dir), SETTINGS)


# ------------------------------------------------------------ visits and months


@query
def analysis_appointments(spark, sf_dir):
    return _analysis(spark, sf_dir)


@query
def visit_days(spark, sf_dir):
    return visits.visit_days(_analysis(spark, sf_dir), SETTINGS)


@query
def client_completed_visits(spark, sf_dir):
    return visits.client_completed_visits(_analysis(spark, sf_dir), inputs.clients(spark, sf_dir), SETTINGS)


@query
def monthly_performance(spark, sf_dir):
    return _performance(spark, sf_dir)


@query
def month_spine(spark, sf_dir):
    return monthly.month_spine(_analysis(spark, sf_dir))


@query
def active_clients(spark, sf_dir):
    return monthly.active_clients(_analysis(spark, sf_dir), SETTINGS)


@query
def client_retention(spark, sf_dir):
    return _retention(spark, sf_dir)


@query
def client_cohorts(spark, sf_dir):
    return retention.client_cohorts(_retention(spark, sf_dir), SETTINGS)


@query
def visit_intervals(spark, sf_dir):
    return visits.visit_intervals(visits.visit_days(_analysis(spark, sf_dir), SETTINGS))


@query
def repeat_cadence(spark, sf_dir):
    return retention.repeat_cadence_of(_analysis(spark, sf_dir), SETTINGS)


@query
def service_monthly(spark, sf_dir):
    return monthly.service_monthly(_analysis(spark, sf_dir), SETTINGS)


# -------------------------------------------------------------------- dashboard


@query
def headline_latest(spark, sf_dir):
    return presentation.headline_latest(_performance(spark, sf_dir))


@query
def trend_series(spark, sf_dir):
    return presentation.trend_series(_performance(spark, sf_dir))


@query
def leakage_latest(spark, sf_dir):
    return presentation.leakage_latest(_performance(spark, sf_dir))


@query
def retention_table(spark, sf_dir):
    return presentation.retention_table(client_cohorts(spark, sf_dir), SETTINGS)


# ------------------------------------------------------------- scalar functions


@query
def normalize_names(spark, sf_dir):
    turn = F.col("c_custkey") % 6
    raw = (
        F.when(turn == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
        .when(turn == 1, F.replace("c_name", F.lit("#"), F.lit(" \t  No ")))
        .when(turn == 2, F.lit("Walk  IN"))
        .when(turn == 3, F.lit("   "))
        .when(turn == 4, F.lit("WALK-in "))
        .otherwise(F.col("c_name"))
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.normalize_client_name(raw).alias("client_name")
    )


@query
def client_keys(spark, sf_dir):
    return inputs.named_clients(spark, sf_dir).select(
        "c_custkey", text.make_client_key(F.col("client_name"), F.col("first_visit")).alias("client_key")
    )


@query
def normalize_ids(spark, sf_dir):
    key, turn = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 5
    raw = (
        F.when(turn == 0, F.concat(key, F.lit(".0")))
        .when(turn == 1, F.concat(F.lit(" "), key, F.lit("  ")))
        .when(turn == 2, F.concat(F.lit("a"), key, F.lit(".0")))
        .when(turn == 3, F.lit("   "))
        .otherwise(F.concat(key, F.lit(".05")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.normalize_identifier(raw).alias("source_id"))


@query
def parse_duration(spark, sf_dir):
    hours, minutes = (F.col("o_orderkey") % 3).cast("string"), (F.col("o_orderkey") % 60).cast("string")
    turn = F.col("o_orderkey") % 4
    raw = (
        F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("99999999"), hours, F.lit("h:5min")))
        .when(turn == 0, F.concat(hours, F.lit("h:"), minutes, F.lit("min")))
        .when(turn == 1, F.concat(F.lit(" "), minutes, F.lit("min ")))
        .when(turn == 2, F.concat(hours, F.lit("h")))
        .otherwise(F.concat(minutes, F.lit(" min")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.parse_duration_minutes(raw).alias("minutes"))


@query
def numeric_coercion(spark, sf_dir):
    price, turn = F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.col("o_orderkey") % 7
    raw = (
        F.when(F.col("o_orderkey") % 11 == 0, F.concat(price, F.lit("e400")))
        .when(turn == 0, F.concat(F.lit("$"), price))
        .when(turn == 1, F.concat(price, F.lit("d")))
        .when(turn == 2, F.concat(F.lit(" -"), price, F.lit(" ")))
        .when(turn == 3, F.lit("NaN"))
        .when(turn == 4, F.lit("1,000"))
        .when(turn == 5, F.concat(F.col("o_orderkey").cast("string"), F.lit("e2")))
        .otherwise(price)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.parse_number(raw).alias("amount"))


@query
def event_datetime(spark, sf_dir):
    hour = F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"), mins=(F.col("o_orderkey") % 60).cast("int"))
    moment = (F.col("o_orderdate") + hour).cast("timestamp")
    turn = F.col("o_orderkey") % 7
    raw = (
        F.when(turn == 0, F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
        .when(turn == 1, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(turn == 2, F.date_format(moment, "yyyy-MM-dd"))
        .when(turn == 3, F.date_format(moment, "M/d/yyyy"))
        .when(turn == 4, F.date_format(moment, "MM/dd/yyyy h:mm a"))
        .when(turn == 5, F.date_format(moment, "M/d/yy H:mm"))
        .otherwise(F.concat(F.lit("13/45/"), F.date_format(moment, "yyyy")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", calendar.parse_datetime(raw).alias("event_time"))


@query
def case_folded_names(spark, sf_dir):
    return inputs.named_clients(spark, sf_dir).select(
        "c_custkey", text.casefold(F.col("client_name")).alias("client_name_casefold")
    )


@query
def snake_case_headers(spark, sf_dir):
    raw = F.concat(F.lit(" "), F.col("p_type"), F.lit(" & "), F.col("p_brand"), F.lit("/"), F.col("p_name"), F.lit(" (net) "))
    return table(spark, sf_dir, "part").select("p_partkey", text.snake_case(raw).alias("header"))


# --------------------------------------------------------------------- identity


@query
def identity_resolution(spark, sf_dir):
    reference = identity.matching_reference(inputs.named_clients(spark, sf_dir))
    events = inputs.named_events(spark, sf_dir)
    return identity.resolve_clients(events, reference, "client", F.col("event_time"), ["o_orderkey"]).select(
        "o_orderkey", "client_key", "client_match_status"
    )


@query
def identity_status_counts(spark, sf_dir):
    return quality.value_counts(identity_resolution(spark, sf_dir), "client_match_status")


# ---------------------------------------------------------------------- quality


@query
def status_counts(spark, sf_dir):
    return quality.value_counts(inputs.appointments(spark, sf_dir), "status").orderBy("status")


@query
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_rows(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query
def excess_keys(spark, sf_dir):
    return quality.key_profile(inputs.appointments(spark, sf_dir), "client_key")


@query
def distinct_transactions(spark, sf_dir):
    return quality.key_profile(inputs.sales(spark, sf_dir), "transaction_id").select(
        F.col("distinct_keys").alias("unique_transactions")
    )


@query
def fk_violations(spark, sf_dir):
    """Clients of any appointment that are missing among clients with a completed visit."""
    served = visits.visit_days(_analysis(spark, sf_dir), SETTINGS).select("client_key").distinct()
    return quality.foreign_key_violations(inputs.appointments(spark, sf_dir), served)


@query
def constraint_violations(spark, sf_dir):
    """Store rules on tables that break several of them."""
    broken = {
        "clients": inputs.clients(spark, sf_dir).select(
            F.floor("total_revenue").alias("bookings_count"),
            F.when(F.col("no_shows_count") > 0, F.col("no_shows_count")).alias("no_shows_count"),
        ),
        "appointments": inputs.appointments(spark, sf_dir).withColumns(
            {
                "appointment_datetime": F.when(F.col("client_key").isNotNull(), F.col("appointment_datetime")),
                "service": F.when(F.col("service") != "1-URGENT", F.col("service")),
                "status": F.when(F.col("status") != "No-show", F.col("status")),
                "service_length_minutes": F.col("service_length_minutes") - 15,
            }
        ),
        "sales": inputs.sales(spark, sf_dir).select(
            F.when(F.col("type") == "O", F.col("checkout_date")).alias("checkout_date"),
            F.when(F.col("category") != "R", F.col("transaction_id")).alias("transaction_id"),
            F.col("category").alias("client_match_status"),
        ),
    }
    return quality.constraint_violations(broken, SETTINGS)


@query
def row_reconciliation(spark, sf_dir):
    """Rows of the sources against the rows that analysis keeps."""
    return quality.row_reconciliation(
        {"appointments": table(spark, sf_dir, "orders"), "sales": table(spark, sf_dir, "lineitem")},
        {"appointments": _analysis(spark, sf_dir), "sales": inputs.sales(spark, sf_dir)},
    )


@query
def load_summary(spark, sf_dir):
    return quality.load_summary(
        {
            "clients": inputs.clients(spark, sf_dir),
            "appointments": inputs.appointments(spark, sf_dir),
            "sales": inputs.sales(spark, sf_dir),
        }
    )


def _shared_name_clients(spark, sf_dir):
    """Clients keyed by customer tens: several rows share a key, and dates may be reversed."""
    tens = F.floor(F.col("c_custkey") / 10)
    return inputs.named_clients(spark, sf_dir).select(
        F.when(tens % 7 != 0, F.concat(F.lit("client_"), tens.cast("string"))).alias("client_key"),
        "first_visit",
        F.make_timestamp_ntz(F.lit(1996), F.lit(6), F.lit(1), F.lit(0), F.lit(0), F.lit(0.0)).alias("last_visit"),
    )


@query
def validation_clients(spark, sf_dir):
    return quality.validate_clients(_shared_name_clients(spark, sf_dir))


@query
def validation_appointments(spark, sf_dir):
    """Appointments with the raw status letter, so that statuses are unexpected, and shared ids."""
    shared_dir(spark)
    # Several checks read the result; it is written once instead of resolved for each.
    resolved = identity_resolution(spark, sf_dir).checkpoint()
    orders = table(spark, sf_dir, "orders")
    events = orders.join(resolved, "o_orderkey").select(
        F.when(F.col("o_orderkey") % 100 != 0, F.floor(F.col("o_orderkey") / 2).cast("string")).alias("booking_id"),
        F.when(F.col("o_orderkey") % 30 != 0, F.col("o_orderdate")).alias("appointment_datetime"),
        F.col("o_orderpriority").alias("service"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Completed")).otherwise(F.col("o_orderstatus")).alias("status"),
        "client_key",
        "client_match_status",
    )
    return quality.validate_appointments(events, SETTINGS)


@query
def validation_sales(spark, sf_dir):
    sales = inputs.sales(spark, sf_dir)
    broken = sales.withColumns(
        {
            "checkout_date": F.when(F.col("category") != "R", F.col("checkout_date")),
            "transaction_id": F.when(F.col("type") == "O", F.col("transaction_id")),
        }
    )
    return quality.validate_sales(broken.drop("type"))


# ---------------------------------------------------------------------- reports

RAW_APPOINTMENT = [
    "date_and_time", "booking_id", "client", "main_category", "service", "service_value", "status", "service_length",
]


@query
def report_rows(spark, sf_dir):
    lines = reports.stage_lines(reports.read_lines(spark, dumps.appointment_dump(spark, sf_dir)))
    return reports.pick(reports.report_rows(lines), RAW_APPOINTMENT)


@query
def report_metadata(spark, sf_dir):
    lines = reports.read_lines(spark, dumps.appointment_dump(spark, sf_dir))
    return reports.report_metadata(lines).select("report_period_start", "report_period_end")


@query
def report_column_counts(spark, sf_dir):
    """Values per report column over all files, the total row included."""
    lines = reports.stage_lines(reports.read_lines(spark, dumps.appointment_dump(spark, sf_dir)))
    raw = reports.pick(reports.data_rows(lines), RAW_APPOINTMENT + ["payment_type"], ["source_file"])
    counts = reports.column_counts(raw, RAW_APPOINTMENT + ["payment_type"])
    return counts.groupBy("column").agg(F.sum("n_values").alias("n_values"))


def _landed(spark, dump: str, dataset: str) -> DataFrame:
    """The rows of a dump, as written. What they were made from goes as soon as it is read: the dump, then its staged lines."""
    path, staged = (dump.replace("/reports/", f"/{folder}/") for folder in ("landed", "staged"))
    lines = records.stage(reports.read_lines(spark, dump), folder=staged).lines
    remove_dir(spark, dump)
    raw = reports.land(lines, schemas.report_columns(dataset), path)
    remove_dir(spark, staged)
    return raw.rows.where(~F.col("is_total"))


def _client_report(spark, sf_dir):
    return cleaning.prepare_clients(_landed(spark, dumps.client_dump(spark, sf_dir), "clients"))


@query
def clean_clients(spark, sf_dir):
    return _client_report(spark, sf_dir)[0]


@query
def clean_appointments(spark, sf_dir):
    _, reference = _client_report(spark, sf_dir)
    raw = _landed(spark, dumps.appointment_dump(spark, sf_dir), "appointments")
    return cleaning.clean_appointments(raw, reference)


@query
def clean_sales(spark, sf_dir):
    _, reference = _client_report(spark, sf_dir)
    raw = _landed(spark, dumps.sales_dump(spark, sf_dir), "sales")
    return cleaning.clean_sales(raw, reference)


@query
def sales_line_ids(spark, sf_dir):
    """Dense numbers of sales lines in load order."""
    raw = cleaning.numbered_sales(_landed(spark, dumps.sales_dump(spark, sf_dir), "sales"))
    return raw.select("sales_line_id", "transaction_id")


@query
def report_records(spark, sf_dir):
    """Report rows whose cells hold line breaks, quotes and delimiters."""
    lines = reports.stage_lines(reports.read_lines(spark, dumps.record_dump(spark, sf_dir)))
    return reports.pick(reports.report_rows(lines), RAW_APPOINTMENT + ["total_revenue"])


@query
def rejected_cells(spark, sf_dir):
    """Cells of dirty reports that could not be read, by column."""
    dump = dumps.dirty_dump(spark, sf_dir)
    lines, path = reports.stage_lines(reports.read_lines(spark, dump)), dump.replace("/reports/", "/landed/")
    landed = reports.land(lines, schemas.report_columns("appointments"), path, counters=cleaning.reject_counters("appointments"))
    return cleaning.rejected_cells(spark, {"appointments": landed.counts})


# --------------------------------------------------------------------- exchange


def _scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/exchange/{name}-{uuid.uuid4().hex}"


def _hard_text(key) -> Column:
    text_key = key.cast("string")
    return (
        F.when(key % 6 == 0, F.concat(F.lit('say "'), text_key, F.lit('", ok')))
        .when(key % 6 == 1, F.concat(F.lit('two\n,"'), text_key, F.lit('"\nlines\n')))
        .when(key % 6 == 2, F.lit(""))
        .when(key % 6 == 3, F.concat(F.lit("  "), text_key, F.lit(" ")))
        .when(key % 6 == 4, F.lit("NA"))
    )


def _exchanged(spark, sf_dir) -> files.CleanCsv:
    """Clients written as text, some cells of which are no numbers or times, and scanned."""
    key = F.col("c_custkey")
    count = (
        F.when(key % 10 == 0, F.lit("abc")).when(key % 10 == 1, F.lit("9007199254740993")).when(key % 10 == 2, F.lit("3.5"))
        .when(key % 10 == 3, F.concat(key.cast("string"), F.lit(".0"))).when(key % 10 == 4, F.lit("")).otherwise(key.cast("string"))
    )
    day = F.when(key % 4 == 0, F.lit("2026-02-30")).when(key % 4 == 1, F.lit("2026-02-03")).otherwise("2026-02-03 04:05:06")
    text = {f.name: F.lit(None).cast("string") for f in schemas.CLIENTS}
    text |= {
        "client_key": F.concat(F.lit("client_"), key.cast("string")), "groups": _hard_text(key), "bookings_count": count,
        "no_shows_count": (key % 3).cast("string"), "first_visit": day, "total_revenue": F.col("c_acctbal").cast("string"),
        "tax": F.when(key % 5 == 0, F.lit("1,5")).otherwise("0.25"),
    }
    path = _scratch(spark, "clients")
    files.write_clean_csv(table(spark, sf_dir, "customer").select(*[c.alias(n) for n, c in reversed(text.items())]), path)
    return files.scan_clean_csv(spark, path, "clients")


@query
def clean_csv_round_trip(spark, sf_dir):
    return _exchanged(spark, sf_dir).rows


@query
def clean_csv_rejects(spark, sf_dir):
    return _exchanged(spark, sf_dir).rejects.where("n_cells > 0")


@query
def gate_findings(spark, sf_dir):
    """The errors that close the gate, on rows that break several rules."""
    found = validation_clients(spark, sf_dir).unionByName(validation_appointments(spark, sf_dir)).unionByName(validation_sales(spark, sf_dir))
    return quality.failed(found)


def _stored_views(spark, sf_dir) -> str:
    """All views over the given tables, under a prefix of their own."""
    prefix = "workload_"
    gold.register_views(inputs.appointments(spark, sf_dir), inputs.clients(spark, sf_dir), SETTINGS, prefix=prefix)
    return prefix


@query
def view_rows(spark, sf_dir):
    """Rows of each of the ten views, by SQL."""
    prefix = _stored_views(spark, sf_dir)
    return spark.sql(" UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n_rows FROM {prefix}{name}" for name in gold.VIEWS))


@query
def view_join(spark, sf_dir):
    """Monthly figures of two views, joined by SQL."""
    prefix = _stored_views(spark, sf_dir)
    return spark.sql(
        f"""SELECT p.month, booked_service_appointments, returning_clients, active_clients_42d, coalesce(n_visits, 0) AS n_visits
        FROM {prefix}monthly_performance p JOIN {prefix}monthly_active_clients a ON a.month = p.month
        LEFT JOIN (SELECT appointment_month, count(*) AS n_visits FROM {prefix}client_completed_visits
                   WHERE is_first_observed_completed_visit = 1 GROUP BY appointment_month) v ON appointment_month = p.month"""
    )


@query
def gold_export(spark, sf_dir):
    """The published extracts and their dictionary, written as CSV and read back: one row a figure."""
    tables = gold.gold_tables(inputs.appointments(spark, sf_dir), inputs.clients(spark, sf_dir), SETTINGS)
    out = []
    for name, df in tables.items():
        path = _scratch(spark, name)
        files.write_gold_csv(df.orderBy(df.columns[0]), path)
        back, item = files.read_gold_csv(spark, path, name, SETTINGS), df.columns[0]
        figures = [
            F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("number"), F.lit(None).cast("string").alias("text"))
            if kind in ("bigint", "int", "double")
            else F.struct(F.lit(c).alias("field"), F.lit(None).cast("double").alias("number"), F.col(c).cast("string").alias("text"))
            for c, kind in df.dtypes[1:]
        ]
        out.append(back.select(F.lit(name).alias("dataset"), F.col(item).alias("item"), F.inline(F.array(*figures))))
    path = _scratch(spark, "data_dictionary")
    files.write_gold_csv(files.data_dictionary(spark, SETTINGS), path)
    listed = spark.read.csv(path, header=True).groupBy("dataset").agg(F.count("definition").cast("double").alias("number"))
    out.append(listed.select("dataset", F.lit(None).cast("string").alias("item"), F.lit("definitions").alias("field"), "number", F.lit(None).cast("string").alias("text")))
    return functools.reduce(DataFrame.unionByName, out)
