"""Metrics per calendar month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revisit.config import Settings
from revisit.functions.calendar import flag, money, month_of, partial_month_flag, period_label, ratio
from revisit.operators.visits import visit_days


def monthly_volume(analysis: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Bookings by outcome, service minutes and service value per month."""
    completed = F.col("is_completed") == 1
    return (
        analysis.where(F.col("appointment_month").isNotNull())
        .groupBy(F.col("appointment_month").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("booked_service_appointments"),
            F.sum("is_completed").alias("completed_service_appointments"),
            F.sum("is_cancelled").alias("cancelled_service_appointments"),
            F.sum("is_no_show").alias("no_show_service_appointments"),
            F.sum(F.when(completed, F.col("service_length_minutes")).otherwise(0)).alias(
                "completed_service_minutes"
            ),
            F.sum(F.when(completed, money(F.col("service_value"), settings)).otherwise(0))
            .cast("double")
            .alias("completed_service_value"),
        )
    )


def monthly_clients(days: DataFrame, clients: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Unique, new and returning clients per month, from visit days.

    A client is new in the month of the first visit when the source does not know it
    from before reporting started, and returning in a month with any later visit: every
    month after the first, or a first month with two or more visits. This replaces
    numbering all visits by one aggregate per (client, month).
    """
    first_month = F.min("month").over(Window.partitionBy("client_key"))
    client_months = (
        days.groupBy("client_key", month_of(F.col("appointment_date")).alias("month"))
        .agg(F.sum("visits").alias("visits"))
        .withColumn("first_month", first_month)
    )
    known = clients.select("client_key", "first_visit", F.lit(True).alias("is_known"))
    is_first_month = F.col("month") == F.col("first_month")
    known_since_start = F.to_date("first_visit") >= F.lit(settings.reporting_start).cast("date")
    returning = F.col("is_known") & (~is_first_month | (F.col("visits") > 1))
    return (
        client_months.join(known, "client_key", "left")
        .groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("unique_completed_clients"),
            F.sum(flag(is_first_month & known_since_start)).alias("observed_new_clients"),
            F.sum(flag(returning)).alias("returning_clients"),
        )
    )


def monthly_performance(
    analysis: DataFrame,
    clients: DataFrame,
    settings: Settings = Settings(),
    days: DataFrame | None = None,
) -> DataFrame:
    """Volume, outcome rates and client counts per month. Pass `days` to reuse stored visit days."""
    days = visit_days(analysis, settings) if days is None else days
    booked = F.col("booked_service_appointments")
    month = F.col("month")

    def count_or_zero(name: str):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return (
        monthly_volume(analysis, settings)
        .join(monthly_clients(days, clients, settings), "month", "left")
        .select(
            "month",
            "booked_service_appointments",
            "completed_service_appointments",
            "cancelled_service_appointments",
            "no_show_service_appointments",
            count_or_zero("unique_completed_clients"),
            count_or_zero("observed_new_clients"),
            count_or_zero("returning_clients"),
            ratio(F.col("completed_service_appointments"), booked).alias("completion_rate"),
            ratio(F.col("cancelled_service_appointments"), booked).alias("cancellation_rate"),
            ratio(F.col("no_show_service_appointments"), booked).alias("no_show_rate"),
            "completed_service_minutes",
            "completed_service_value",
            period_label(month, settings).alias("intervention_period"),
            partial_month_flag(month, settings).alias("is_partial_month"),
        )
        .orderBy("month")
    )


def month_spine(analysis: DataFrame) -> DataFrame:
    """Every month from the first to the last appointment of any status, with its last day."""
    one_month = F.expr("INTERVAL 1 MONTH")
    span = analysis.agg(F.min("appointment_date").alias("first"), F.max("appointment_date").alias("last"))
    starts = span.select(
        F.explode(F.sequence(F.trunc("first", "month"), F.trunc("last", "month"), one_month)).alias("start")
    )
    return starts.select(month_of(F.col("start")).alias("month"), F.last_day("start").alias("month_end"))


def active_clients(
    analysis: DataFrame, settings: Settings = Settings(), days: DataFrame | None = None
) -> DataFrame:
    """Distinct clients with a completed visit in the days up to each month end.

    At a month end only a client's latest visit so far matters. So each (client, month)
    keeps its last day and is counted at the month ends from there to the client's next
    month with a visit, as far as the widest window reaches. No range join is needed.
    """
    days = visit_days(analysis, settings) if days is None else days
    widest = max(settings.active_windows)
    by_month = Window.partitionBy("client_key").orderBy("start")
    last_in_month = days.groupBy("client_key", F.trunc("appointment_date", "month").alias("start")).agg(
        F.max("appointment_date").alias("last_visit")
    )
    reach = F.trunc(F.date_add("last_visit", widest - 1), "month")
    until_next = F.add_months(F.lead("start").over(by_month), -1)
    standing = last_in_month.withColumn("stop", F.least(reach, until_next)).select(
        "last_visit",
        F.explode(F.sequence("start", "stop", F.expr("INTERVAL 1 MONTH"))).alias("start"),
    )
    names = {w: f"active_clients_{w}d" for w in settings.active_windows}
    month_end = F.last_day("start")
    counts = standing.groupBy(month_end.alias("month_end")).agg(
        *[
            F.sum(flag(F.col("last_visit") >= F.date_sub(month_end, w - 1))).alias(name)
            for w, name in names.items()
        ]
    )
    month = F.col("month")
    return (
        month_spine(analysis)
        .join(counts, "month_end", "left")
        .select(
            "month",
            "month_end",
            *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in names.values()],
            period_label(month, settings).alias("intervention_period"),
            partial_month_flag(month, settings).alias("is_partial_month"),
        )
        .orderBy("month")
    )


def service_monthly(analysis: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Service mix per month: volume, average value and length of completed appointments."""
    completed = F.col("is_completed") == 1
    value = F.when(completed, money(F.col("service_value"), settings))
    minutes = F.when(completed, F.col("service_length_minutes"))
    day = F.when(completed, F.col("appointment_date"))
    value_count = F.nullif(F.count(value), F.lit(0)).cast("decimal(20,0)")
    return (
        analysis.groupBy(F.col("appointment_month").alias("month"), "service")
        .agg(
            F.count(F.lit(1)).alias("booked_appointments"),
            F.sum("is_completed").alias("completed_appointments"),
            F.round(F.sum(value) / value_count, 2).cast("double").alias("avg_completed_service_value"),
            F.round(F.avg(minutes), 1).alias("avg_completed_service_minutes"),
            F.min(day).alias("first_completed_date_in_month"),
            F.max(day).alias("last_completed_date_in_month"),
        )
        .orderBy("month", F.desc("completed_appointments"), "service")
    )
