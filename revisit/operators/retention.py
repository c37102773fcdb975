"""Client retention, acquisition cohorts and the rhythm of return visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revisit.config import Settings
from revisit.functions.calendar import flag, month_of, partial_month_flag, period_label, ratio
from revisit.operators.visits import visit_days, visit_intervals


def observation_end(analysis: DataFrame, settings: Settings = Settings()) -> Column:
    """Last day with a completed appointment, linked to a client or not, as a scalar subquery."""
    completed = analysis.where(F.col("status") == settings.completed)
    return completed.agg(F.max("appointment_date")).scalar()


def client_retention(
    analysis: DataFrame,
    clients: DataFrame,
    settings: Settings = Settings(),
    days: DataFrame | None = None,
) -> DataFrame:
    """First, second and latest visit day per client and repeats within the windows.

    A client is eligible for a window only if the window ended by the observation end;
    otherwise it is too early to say whether the client comes back in time.
    """
    days = visit_days(analysis, settings) if days is None else days
    in_order = Window.partitionBy("client_key").orderBy("appointment_date")
    per_client = (
        days.withColumn("day_number", F.row_number().over(in_order))
        .groupBy("client_key")
        .agg(
            F.min("appointment_date").alias("first_completed_visit"),
            F.max(F.when(F.col("day_number") == 2, F.col("appointment_date"))).alias(
                "second_completed_visit"
            ),
            F.max("appointment_date").alias("latest_completed_visit"),
            F.count(F.lit(1)).alias("completed_visit_days"),
        )
        .join(clients.select("client_key"), "client_key", "left_semi")
        .withColumn("observation_end_date", observation_end(analysis, settings))
    )
    first = F.col("first_completed_visit")
    gap = F.datediff("second_completed_visit", first)
    columns = [
        "client_key",
        "first_completed_visit",
        month_of(first).alias("acquisition_cohort_month"),
        "second_completed_visit",
        "latest_completed_visit",
        "completed_visit_days",
        gap.alias("days_to_second_visit"),
        flag(F.col("second_completed_visit").isNotNull()).alias("ever_repeated_observed"),
    ]
    for window in settings.repeat_windows:
        eligible = F.date_add(first, window) <= F.col("observation_end_date")
        columns.append(flag(eligible).alias(f"eligible_for_{window}d_repeat"))
        columns.append(flag(eligible & (gap <= window)).alias(f"repeated_within_{window}d"))
    return per_client.select(*columns, "observation_end_date")


def client_cohorts(retention: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Repeat rates by month of the first visit. `retention` is the result of `client_retention`."""
    cohort = F.col("cohort_month")
    sums = []
    for window in settings.repeat_windows:
        # `repeated_within` is only ever set for eligible clients.
        sums.append(F.sum(f"eligible_for_{window}d_repeat").alias(f"clients_eligible_{window}d"))
        sums.append(F.sum(f"repeated_within_{window}d").alias(f"clients_repeated_{window}d"))
    grouped = retention.groupBy(F.col("acquisition_cohort_month").alias("cohort_month")).agg(
        F.count(F.lit(1)).alias("acquired_clients"),
        F.sum("ever_repeated_observed").alias("clients_ever_repeated_observed"),
        F.round(F.avg("days_to_second_visit"), 1).alias("avg_days_to_second_visit"),
        *sums,
    )
    windows = []
    for window in settings.repeat_windows:
        eligible, repeated = f"clients_eligible_{window}d", f"clients_repeated_{window}d"
        windows += [eligible, repeated, ratio(F.col(repeated), F.col(eligible)).alias(f"repeat_rate_{window}d")]
    return grouped.select(
        "cohort_month",
        "acquired_clients",
        "clients_ever_repeated_observed",
        ratio(F.col("clients_ever_repeated_observed"), F.col("acquired_clients")).alias("observed_repeat_rate"),
        *windows,
        "avg_days_to_second_visit",
        period_label(cohort, settings).alias("intervention_period"),
        partial_month_flag(cohort, settings).alias("is_partial_month"),
    ).orderBy("cohort_month")


def cadence_band(days_between: Column, settings: Settings = Settings()) -> Column:
    """Label of the band a return interval falls in, such as `02_15_21_days`."""
    bounds = settings.cadence_bounds
    lows = (0, *[b + 1 for b in bounds])
    band = F.lit(f"{len(lows):02d}_{lows[-1]}_plus_days")
    for i in reversed(range(len(bounds))):
        label = F.lit(f"{i + 1:02d}_{lows[i]}_{bounds[i]}_days")
        band = F.when(days_between <= bounds[i], label).otherwise(band)
    return band


def repeat_cadence(intervals: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """How many return intervals fall in each band, and their share of all."""
    counted = intervals.groupBy(
        cadence_band(F.col("days_between_visits"), settings).alias("cadence_band")
    ).agg(F.count(F.lit(1)).alias("return_intervals"))
    # One row per band is left here, so the window over all of them is tiny.
    total = F.sum("return_intervals").over(Window.partitionBy())
    return counted.withColumn(
        "pct_of_return_intervals", F.round(F.lit(100.0) * F.col("return_intervals") / total, 1)
    ).orderBy("cadence_band")


def repeat_cadence_of(
    analysis: DataFrame, settings: Settings = Settings(), days: DataFrame | None = None
) -> DataFrame:
    """`repeat_cadence` straight from appointments or stored visit days."""
    days = visit_days(analysis, settings) if days is None else days
    return repeat_cadence(visit_intervals(days), settings)
