"""The gold tables and the named views over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisit import schemas
from revisit.config import Settings
from revisit.operators import monthly, presentation, retention, visits

#: Session setting with the names of the views that were registered here.
OWN_VIEWS = "revisit.views"
VIEWS = (
    "analysis_appointments", "visit_days", "client_completed_visits", "monthly_performance", "monthly_active_clients",
    "client_retention", "client_cohorts", "client_visit_intervals", "repeat_cadence_summary", "service_monthly",
)
GOLD_VIEWS = ("monthly_performance", "monthly_active_clients", "client_cohorts", "repeat_cadence_summary")


def views(
    appointments: DataFrame,
    clients: DataFrame,
    settings: Settings = Settings(),
    days: DataFrame | None = None,
    names: tuple[str, ...] | None = None,
) -> dict[str, DataFrame]:
    """The analytical views by name. `days` may be stored visit days; `names` picks some views."""
    analysis = visits.analysis_appointments(appointments, settings)
    days = visits.visit_days(analysis, settings) if days is None else days
    intervals = visits.visit_intervals(days)
    kept = retention.client_retention(analysis, clients, settings, days)
    definitions = {
        "analysis_appointments": lambda: analysis,
        "visit_days": lambda: days,
        "client_completed_visits": lambda: visits.client_completed_visits(analysis, clients, settings, days),
        "monthly_performance": lambda: monthly.monthly_performance(analysis, clients, settings, days),
        "monthly_active_clients": lambda: monthly.active_clients(analysis, settings, days),
        "client_retention": lambda: kept,
        "client_cohorts": lambda: retention.client_cohorts(kept, settings),
        "client_visit_intervals": lambda: intervals,
        "repeat_cadence_summary": lambda: retention.repeat_cadence(intervals, settings),
        "service_monthly": lambda: monthly.service_monthly(analysis, settings),
    }
    return {name: definitions[name]() for name in names or VIEWS}


class ViewExists(RuntimeError):
    """A name is taken by a view that this module did not register; nothing was registered."""


def register_views(
    appointments: DataFrame,
    clients: DataFrame,
    settings: Settings = Settings(),
    days: DataFrame | None = None,
    names: tuple[str, ...] | None = None,
    prefix: str = "",
) -> list[str]:
    """Make the views, by default all ten, available to SQL under their names after `prefix`.

    Views are plans: nothing is computed until SQL asks for it. A view registered here before is replaced, any
    other is not: then `ViewExists` names all names that are taken.
    """
    spark = appointments.sparkSession
    named = {prefix + name: df for name, df in views(appointments, clients, settings, days, names).items()}
    own = set(filter(None, spark.conf.get(OWN_VIEWS, "").split(",")))
    taken = sorted(name for name in named if name not in own and spark.catalog.tableExists(name))
    if taken:
        raise ViewExists(f"not replaced: {', '.join(taken)}")
    for name, df in named.items():
        df.createOrReplaceTempView(name)
    spark.conf.set(OWN_VIEWS, ",".join(sorted(own | set(named))))
    return list(named)


def require_views(spark: SparkSession, names: tuple[str, ...] = GOLD_VIEWS, prefix: str = "") -> None:
    missing = sorted(prefix + n for n in names if not spark.catalog.tableExists(prefix + n))
    if missing:
        raise RuntimeError(f"required views are missing: {missing}")


def gold_tables(
    appointments: DataFrame, clients: DataFrame, settings: Settings = Settings(), days: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The four published tables with their published columns and comments."""
    analysis = visits.analysis_appointments(appointments, settings)
    days = visits.visit_days(analysis, settings) if days is None else days
    frames = {
        "business_growth": monthly.monthly_performance(analysis, clients, settings, days),
        "active_clients": monthly.active_clients(analysis, settings, days),
        "client_cohorts": retention.client_cohorts(
            retention.client_retention(analysis, clients, settings, days), settings
        ),
        "repeat_cadence": retention.repeat_cadence(visits.visit_intervals(days), settings),
    }
    described = schemas.gold_schemas(settings)
    return {
        name: df.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in described[name]]
        )
        for name, df in frames.items()
    }


def dashboard_tables(gold: dict[str, DataFrame], settings: Settings = Settings()) -> dict[str, DataFrame]:
    """What the dashboard shows, from the gold tables."""
    growth, cohorts = gold["business_growth"], gold["client_cohorts"]
    return {
        "headline_latest": presentation.headline_latest(growth),
        "trend_series": presentation.trend_series(growth),
        "leakage_latest": presentation.leakage_latest(growth),
        "retention_table": presentation.retention_table(cohorts, settings),
    }
