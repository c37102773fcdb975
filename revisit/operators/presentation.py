"""The figures and tables a dashboard shows, derived from the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisit.config import Settings
from revisit.functions.text import month_label, percent_text, repeat_rate_text


def latest_month(performance: DataFrame) -> DataFrame:
    return performance.orderBy(F.desc("month")).limit(1)


def headline_latest(performance: DataFrame) -> DataFrame:
    """Completed appointments, new and returning clients of the latest month."""
    return latest_month(performance).select(
        "month",
        month_label(F.col("month")).alias("month_label"),
        F.col("completed_service_appointments").alias("completed_appointments"),
        F.col("observed_new_clients").alias("new_clients"),
        "returning_clients",
        "is_partial_month",
    )


def trend_series(performance: DataFrame) -> DataFrame:
    """Completed appointments, new and returning clients, and leakage rates in percent, by month."""
    return performance.select(
        "month",
        F.col("completed_service_appointments").alias("completed_appointments"),
        F.col("observed_new_clients").alias("new_clients"),
        "returning_clients",
        (F.col("cancellation_rate") * 100).alias("cancellation_rate_pct"),
        (F.col("no_show_rate") * 100).alias("no_show_rate_pct"),
    ).orderBy("month")


def leakage_latest(performance: DataFrame) -> DataFrame:
    """Booked appointments lost in the latest month, by cause, and the rates as text."""
    cancelled, no_show = F.col("cancelled_service_appointments"), F.col("no_show_service_appointments")
    return latest_month(performance).select(
        "month",
        (cancelled + no_show).alias("lost_bookings"),
        cancelled.alias("cancelled"),
        no_show.alias("no_show"),
        F.concat(cancelled.cast("string"), F.lit(" cancelled + "), no_show.cast("string"), F.lit(" no-show")).alias(
            "lost_bookings_text"
        ),
        percent_text(F.col("cancellation_rate")).alias("cancellation_rate_text"),
        percent_text(F.col("no_show_rate")).alias("no_show_rate_text"),
    )


def retention_table(cohorts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Cohorts with audited repeat rates, as shown to readers."""
    rates = [
        repeat_rate_text(
            F.col(f"repeat_rate_{w}d"), F.col(f"clients_repeated_{w}d"), F.col(f"clients_eligible_{w}d")
        ).alias(f"repeat_rate_{w}d_text")
        for w in settings.repeat_windows
    ]
    return cohorts.select(
        "cohort_month",
        month_label(F.col("cohort_month")).alias("acquisition_cohort"),
        "acquired_clients",
        *rates,
    ).orderBy("cohort_month")
