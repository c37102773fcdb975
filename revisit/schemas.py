"""Schemas of the stored tables, report column names and the described gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

from revisit.config import Settings

TEXT, DOUBLE, LONG, INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
MOMENT, DAY = T.TimestampNTZType(), T.DateType()


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# --- Fixed values: column contract of the three stored tables. ---------------
CLIENTS = _schema(
    ("client_key", TEXT), ("groups", TEXT), ("bookings_count", LONG), ("no_shows_count", LONG),
    ("first_visit", MOMENT), ("last_visit", MOMENT), ("bookings_value", DOUBLE), ("revenue_net", DOUBLE),
    ("discount", DOUBLE), ("tax", DOUBLE), ("tip_amount", DOUBLE), ("total_revenue", DOUBLE),
)
APPOINTMENTS = _schema(
    ("booking_id", TEXT), ("appointment_datetime", MOMENT), ("main_category", TEXT), ("service", TEXT),
    ("staffer", TEXT), ("service_value", DOUBLE), ("addons_value", DOUBLE), ("revenue_net", DOUBLE),
    ("discount", DOUBLE), ("tax", DOUBLE), ("tip_amount", DOUBLE), ("total_revenue", DOUBLE),
    ("status", TEXT), ("service_length_minutes", INT), ("client_key", TEXT), ("client_match_status", TEXT),
)
SALES = _schema(
    ("checkout_date", MOMENT), ("transaction_id", TEXT), ("type", TEXT), ("category", TEXT), ("item", TEXT),
    ("staffer", TEXT), ("quantity", DOUBLE), ("booking_date", MOMENT), ("service_value", DOUBLE),
    ("addons_value", DOUBLE), ("revenue_net", DOUBLE), ("discount", DOUBLE), ("tax", DOUBLE),
    ("tip_amount", DOUBLE), ("total_revenue", DOUBLE), ("payment_type", TEXT), ("client_key", TEXT),
    ("client_match_status", TEXT),
)

# Report header (in snake case) -> column name, where the two differ.
RENAMES = {
    "clients": {
        "first_and_last_name": "client_name",
        "no_of_bookings": "bookings_count",
        "no_of_no_shows": "no_shows_count",
    },
    "appointments": {"date_and_time": "appointment_datetime", "add_ons_value": "addons_value"},
    "sales": {"service_product_add_on": "item", "add_on_value": "addons_value"},
}
# -----------------------------------------------------------------------------

STORED = {"clients": CLIENTS, "appointments": APPOINTMENTS, "sales": SALES}
IDENTITY_COLUMNS = ("client_key", "client_match_status")


def report_columns(dataset: str) -> list[str]:
    """Report headers (snake case) a dataset is read from."""
    back = {new: old for old, new in RENAMES[dataset].items()}
    names = [f.name for f in STORED[dataset] if f.name not in IDENTITY_COLUMNS]
    extra = {
        "clients": ["client_name"],
        "appointments": ["client", "service_length"],
        "sales": ["client"],
    }[dataset]
    derived = {"service_length_minutes"}
    return [back.get(n, n) for n in extra + names if n not in derived]


def missing_columns(columns: list[str], dataset: str) -> list[str]:
    """Contract columns that a frame lacks."""
    return sorted(set(STORED[dataset].fieldNames()) - set(columns))


def gold_schemas(settings: Settings = Settings()) -> dict[str, T.StructType]:
    """The published tables; a described column carries its definition as comment."""
    active = [
        (f"active_clients_{w}d", LONG, f"Clients with at least one completed service in the {w} days that end with the month.")
        for w in settings.active_windows
    ]
    cohort_windows = []
    for w in settings.repeat_windows:
        cohort_windows += [
            (f"clients_eligible_{w}d", LONG),
            (f"clients_repeated_{w}d", LONG),
            (f"repeat_rate_{w}d", DOUBLE, f"Share of eligible acquired clients whose second visit day came within {w} days."),
        ]
    before, during, after = settings.period_labels
    period = ("intervention_period", TEXT)
    partial = ("is_partial_month", INT)
    tables = {
        "business_growth": [
            ("month", TEXT),
            ("booked_service_appointments", LONG),
            ("completed_service_appointments", LONG, "Main growth figure: completed appointments, administrative ones left out."),
            ("cancelled_service_appointments", LONG, "Service appointments booked for the month and cancelled."),
            ("no_show_service_appointments", LONG, "Service appointments booked for the month where nobody came."),
            ("unique_completed_clients", LONG, "Different linked clients with a completed service in the month."),
            ("observed_new_clients", LONG, "Clients whose first completed visit on record is in the month and who were not known before reporting began."),
            ("returning_clients", LONG, "Clients served in the month who had an earlier completed visit on record."),
            ("completion_rate", DOUBLE),
            ("cancellation_rate", DOUBLE, "Cancelled as a share of booked service appointments."),
            ("no_show_rate", DOUBLE, "No-shows as a share of booked service appointments."),
            ("completed_service_minutes", LONG),
            ("completed_service_value", DOUBLE),
            (*period, f"Position of the month: {before}, {during} or {after}."),
            (*partial, "1 where reporting does not cover the whole month."),
        ],
        "active_clients": [("month", TEXT), ("month_end", DAY), *active, period, partial],
        "client_cohorts": [
            ("cohort_month", TEXT),
            ("acquired_clients", LONG),
            ("clients_ever_repeated_observed", LONG),
            ("observed_repeat_rate", DOUBLE),
            *cohort_windows,
            ("avg_days_to_second_visit", DOUBLE),
            period,
            partial,
        ],
        "repeat_cadence": [
            ("cadence_band", TEXT),
            ("return_intervals", LONG),
            ("pct_of_return_intervals", DOUBLE, "Percentage of all intervals between a client's consecutive visit days."),
        ],
    }
    return {
        name: T.StructType(
            [T.StructField(f[0], f[1], True, {"comment": f[2]} if len(f) > 2 else {}) for f in fields]
        )
        for name, fields in tables.items()
    }


def data_dictionary(settings: Settings = Settings()) -> list[tuple[str, str, str]]:
    """(dataset, field, definition) of every described gold column."""
    return [
        (name, field.name, field.metadata["comment"])
        for name, schema in gold_schemas(settings).items()
        for field in schema
        if "comment" in field.metadata
    ]
