"""Each check with a passing and a failing row."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from revisit.config import Settings
from revisit.operators import quality

DAY = dt.datetime
CLIENT = "client_key string, first_visit timestamp_ntz, last_visit timestamp_ntz"
EVENT = (
    "booking_id string, appointment_datetime timestamp_ntz, service string, status string, client_key string, "
    "client_match_status string"
)
SALE = "checkout_date timestamp_ntz, transaction_id string, type string, client_key string, client_match_status string"


def found(findings):
    return {(r.kind, r.name) if r.detail is None or r.kind == "error" else (r.kind, r.name, r.detail): r.findings for r in findings.collect()}


def test_clients(spark):
    good = [("a", DAY(2025, 1, 1), DAY(2025, 2, 1)), ("b", DAY(2025, 1, 1), None)]
    out = found(quality.validate_clients(spark.createDataFrame(good, CLIENT)))
    assert out[("rows", "rows")] == 2 and out[("metric", "unique_client_keys")] == 2
    assert ("metric", "first_visit_min", "2025-01-01T00:00:00") in out
    assert ("metric", "last_visit_max", "2025-02-01T00:00:00") in out
    assert all(n == 0 for k, n in out.items() if k[0] == "error")

    bad = good + [("a", DAY(2025, 3, 1), DAY(2025, 2, 1)), (None, None, None), (None, None, None)]
    out = found(quality.validate_clients(spark.createDataFrame(bad, CLIENT)))
    assert out[("error", "rows_without_client_key")] == 2
    assert out[("error", "rows_sharing_client_key")] == 4
    assert out[("error", "first_visit_after_last_visit")] == 1


def test_appointments(spark):
    rows = [("1", DAY(2025, 1, 1), "Cut", "Completed", "a", "exact_name"),
            ("1", None, "Cut", "Lost", None, "ambiguous"), (None, DAY(2025, 1, 2), "Cut", None, "a", "unmatched")]
    out = found(quality.validate_appointments(spark.createDataFrame(rows, EVENT)))
    assert out[("error", "missing_booking_id")] == 1 and out[("error", "rows_sharing_booking_id")] == 2
    assert out[("error", "invalid_appointment_datetime")] == 1
    assert out[("warning", "unexpected_status", "Lost")] == 1 and out[("warning", "ambiguous_clients")] == 1
    assert out[("metric", "status_counts", "Completed")] == 1 and out[("metric", "status_counts")] == 1
    assert out[("metric", "linked_clients")] == 1 and out[("metric", "unique_booking_ids")] == 1
    assert out[("metric", "client_match_counts", "ambiguous")] == 1
    assert ("metric", "date_max", "2025-01-02T00:00:00") in out


def test_sales(spark):
    rows = [(DAY(2025, 1, 1), "t", "x", "a", "exact_name"), (None, None, "x", None, "unmatched")]
    out = found(quality.validate_sales(spark.createDataFrame(rows, SALE)))
    assert out[("error", "invalid_checkout_date")] == 1 and out[("error", "missing_transaction_id")] == 1
    assert out[("warning", "unmatched_clients")] == 1 and out[("warning", "ambiguous_clients")] == 0
    assert out[("metric", "unique_transactions")] == 1


@pytest.mark.parametrize("rows", [[], [("1", None, "Cut", "Completed", "a", "exact_name")]])
def test_missing_columns_close_the_gate_also_without_rows(spark, rows):
    df = spark.createDataFrame(rows, EVENT).drop("service", "booking_id")
    failed = quality.failed(quality.validate_appointments(df)).where("name = 'missing_columns'").first()
    assert (failed.findings, failed.detail) == (2, "booking_id, service")
    assert "appointments: missing_columns = 2 (booking_id, service)" in quality.findings_text(
        quality.failed(quality.validate_appointments(df))
    )


def test_empty_frame_passes(spark):
    out = found(quality.validate_clients(spark.createDataFrame([], CLIENT)))
    assert out[("rows", "rows")] == 0 and all(n == 0 for k, n in out.items() if k[0] == "error")


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",)], "k string")
    assert quality.key_profile(df, "k").first().asDict() == {
        "rows": 4, "distinct_keys": 2, "missing_rows": 2, "duplicate_rows": 2, "excess_rows": 2,
    }
    assert [tuple(r) for r in quality.duplicate_rows(df, "k").collect()] == [(None, 2)]
    assert [tuple(r) for r in quality.value_counts(df, "k").collect()] == [(None, 2), ("a", 1), ("b", 1)]


def tables(spark):
    return {
        "clients": spark.createDataFrame([("a", 1, 0)], "client_key string, bookings_count long, no_shows_count long"),
        "appointments": spark.createDataFrame(
            [("1", DAY(2025, 1, 1), "Cut", "Completed", None, "a", "exact_name")],
            "booking_id string, appointment_datetime timestamp_ntz, service string, status string, "
            "service_length_minutes int, client_key string, client_match_status string",
        ),
        "sales": spark.createDataFrame(
            [(DAY(2025, 1, 1), "t", None, "unmatched")],
            "checkout_date timestamp_ntz, transaction_id string, client_key string, client_match_status string",
        ),
    }


def broken(stored, expected):
    rows = quality.load_checks(stored, expected, Settings()).where("violations > 0").collect()
    return {(r.table_name, r.rule): r.violations for r in rows}


def test_load_checks_pass(spark):
    good = tables(spark)
    assert broken(good, good) == {}


@pytest.mark.parametrize(
    ("table", "column", "value", "rule"),
    [
        ("clients", "bookings_count", "-1", "bookings_count_not_negative"),
        ("clients", "no_shows_count", "null", "no_shows_count_not_negative"),
        ("appointments", "appointment_datetime", "null", "appointment_datetime_present"),
        ("appointments", "service", "null", "service_present"),
        ("appointments", "status", "'Lost'", "status_allowed"),
        ("appointments", "status", "null", "status_allowed"),
        ("appointments", "service_length_minutes", "0", "service_length_positive"),
        ("appointments", "client_match_status", "'maybe'", "match_status_allowed"),
        ("appointments", "client_key", "'orphan'", "client_key_known"),
        ("appointments", "booking_id", "null", "booking_id_unique"),
        ("sales", "checkout_date", "null", "checkout_date_present"),
        ("sales", "transaction_id", "null", "transaction_id_present"),
        ("sales", "client_key", "'orphan'", "client_key_known"),
        ("sales", "client_match_status", "null", "match_status_allowed"),
    ],
)
def test_each_load_rule(spark, table, column, value, rule):
    good = tables(spark)
    bad = good[table].withColumn(column, F.expr(f"cast({value} as {dict(good[table].dtypes)[column]})"))
    assert broken({**good, table: bad}, good) == {(table, rule): 1}


def test_rows_must_reconcile_and_keys_be_unique(spark):
    good = tables(spark)
    doubled = {**good, "clients": good["clients"].union(good["clients"])}
    assert broken(doubled, {t: 1 for t in good}) == {("clients", "client_key_unique"): 1, ("clients", "row_count"): 1}


def test_findings_beyond_the_limit_are_counted(spark):
    rows = [("sales", "file_without_header", 1, f"f{i}") for i in range(105)] + [("visits", "late", 2, None)]
    found_ = spark.createDataFrame(rows, "dataset string, name string, findings long, detail string")
    lines = quality.findings_text(found_)
    assert len(lines) == 101 and lines[-1] == "6 more findings"
    assert len(quality.findings_text(found_, 106)) == 106
