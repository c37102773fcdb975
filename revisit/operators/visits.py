"""Appointments ready for analysis, visit days and visit sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revisit.config import Settings
from revisit.functions.calendar import flag, month_of
from revisit.operators.ordering import number_rows
from revisit.schemas import APPOINTMENTS

PASSED_THROUGH = [c for c in APPOINTMENTS.fieldNames() if c not in ("booking_id", "appointment_datetime")]


def analysis_appointments(appointments: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Service appointments with time keys and status flags. Administrative ones are dropped."""
    day = F.to_date("appointment_datetime")
    return appointments.where(~F.col("service").isin(*settings.admin_services)).select(
        "booking_id",
        "appointment_datetime",
        day.alias("appointment_date"),
        month_of(day).alias("appointment_month"),
        *PASSED_THROUGH,
        flag(F.col("status") == settings.completed).alias("is_completed"),
        flag(F.col("status") == settings.cancelled).alias("is_cancelled"),
        flag(F.col("status") == settings.no_show).alias("is_no_show"),
    )


def linked_completed(analysis: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Completed appointments of known clients, filtered before any shuffle by client."""
    return analysis.where(
        (F.col("status") == settings.completed)
        & F.col("client_key").isNotNull()
        & F.col("appointment_datetime").isNotNull()
    )


def visit_days(analysis: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per client and day with a completed visit, and how many visits it had.

    The compact base of all client metrics. Counts combine before the shuffle, so a
    client with a huge share of the rows sends at most one row per day and task; after
    it no client has more rows than the calendar has days.
    """
    return (
        linked_completed(analysis, settings)
        .groupBy("client_key", "appointment_date")
        .agg(F.count(F.lit(1)).alias("visits"))
    )


def client_completed_visits(
    analysis: DataFrame, clients: DataFrame, settings: Settings = Settings(), days: DataFrame | None = None
) -> DataFrame:
    """Completed visits in sequence per client, with first, repeat and acquisition flags.

    `days` may be stored visit days, from which the visits per client are summed.
    """
    visits = linked_completed(analysis, settings).select(
        "booking_id", "appointment_datetime", "appointment_date", "appointment_month", "service",
        "service_value", "total_revenue", "client_key", "client_match_status",
    )
    numbered = number_rows(
        visits,
        key="client_key",
        moment="appointment_datetime",
        tie_break="booking_id",
        number="observed_visit_number",
        first="observed_first_completed_visit",
        key_attributes=clients.select("client_key", F.col("first_visit").alias("source_first_visit")),
        settings=settings,
        counted=None if days is None else days.groupBy("client_key").agg(F.sum("visits").alias("_rows")),
    )
    is_first = F.col("observed_visit_number") == 1
    known_before = F.to_date("source_first_visit") < F.lit(settings.reporting_start).cast("date")
    return numbered.withColumns(
        {
            "is_first_observed_completed_visit": flag(is_first),
            "is_repeat_completed_visit": flag(~is_first),
            "source_indicates_pre_reporting_client": flag(known_before),
            "is_observed_new_client": flag(is_first & ~known_before),
        }
    )


def visit_intervals(days: DataFrame) -> DataFrame:
    """Days between consecutive visit days of a client. `days` is the result of `visit_days`."""
    in_order = Window.partitionBy("client_key").orderBy("appointment_date")
    return (
        days.select("client_key", "appointment_date")
        .withColumn("prior_visit_date", F.lag("appointment_date").over(in_order))
        .where(F.col("prior_visit_date").isNotNull())
        .select(
            "client_key",
            "prior_visit_date",
            F.col("appointment_date").alias("return_visit_date"),
            F.datediff("appointment_date", "prior_visit_date").alias("days_between_visits"),
        )
    )
