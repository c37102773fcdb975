"""Business constants of the analytics, as one immutable parameter object."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: they must be equal to the published results' constants. ---
APPOINTMENT_STATUSES = ("Completed", "Cancelled", "No-show")
MATCH_STATUSES = ("exact_name", "casefold_unique", "event_date", "ambiguous", "unmatched")
WALK_IN_SPELLINGS = ("walk-in", "walk in", "walkin")
WALK_IN_TOKEN = "WALK_IN"
CLIENT_KEY_PREFIX = "client_"
CLIENT_KEY_HEX_DIGITS = 16
CADENCE_UPPER_BOUNDS = (14, 21, 28, 35, 42, 60, 90)
REPEAT_WINDOWS_DAYS = (42, 90)
ACTIVE_WINDOWS_DAYS = (42, 90)
PERIOD_LABELS = ("pre_gbp", "gbp_creation_month", "post_gbp")
REPORT_HEADER_ROW = 7
TOTAL_ROW_MARKER = "total"
# -----------------------------------------------------------------------------

# Shapes a report cell may have, with the pattern that reads each one. The shape is
# tested first, so a value is parsed at most once. Slash dates are month first.
ISO_8601 = "ISO"
DATETIME_FORMATS = (
    (r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$", ISO_8601),
    (r"^\d{1,2}/\d{1,2}/\d{4}(,? \d{1,2}:\d{2}(:\d{2})?)?$", "M/d/yyyy[,][ H:mm[:ss]]"),
    (r"^\d{1,2}/\d{1,2}/\d{2}(,? \d{1,2}:\d{2}(:\d{2})?)?$", "M/d/yy[,][ H:mm[:ss]]"),
    (r"^\d{1,2}/\d{1,2}/\d{4},? \d{1,2}:\d{2}(:\d{2})? [AP]M$", "M/d/yyyy[,] h:mm[:ss] a"),
    (r"^\d{1,2}/\d{1,2}/\d{2},? \d{1,2}:\d{2}(:\d{2})? [AP]M$", "M/d/yy[,] h:mm[:ss] a"),
)


@dataclass(frozen=True)
class Settings:
    """Everything a business may want to change; the defaults are the published run."""

    admin_services: tuple[str, ...] = ("LEAVE A REVIEW",)
    statuses: tuple[str, ...] = APPOINTMENT_STATUSES
    reporting_start: str = "2025-07-25"
    intervention_month: str = "2026-03"
    period_labels: tuple[str, str, str] = PERIOD_LABELS
    partial_months: tuple[str, ...] = ("2025-07",)
    repeat_windows: tuple[int, ...] = REPEAT_WINDOWS_DAYS
    active_windows: tuple[int, ...] = ACTIVE_WINDOWS_DAYS
    cadence_bounds: tuple[int, ...] = CADENCE_UPPER_BOUNDS
    walk_in_spellings: tuple[str, ...] = WALK_IN_SPELLINGS
    header_row: int = REPORT_HEADER_ROW
    datetime_formats: tuple[tuple[str, str], ...] = DATETIME_FORMATS
    # Decimal places kept when money is summed. Sums run on decimals, so they do
    # not depend on the order in which partitions arrive.
    money_scale: int = 9
    # Fold names as Unicode full case folding; False uses plain `lower`.
    exact_casefold: bool = True
    # A single join key, or a single (client, hour), above this many rows is split.
    hot_rows: int = 1_000_000

    @property
    def completed(self) -> str:
        return self.statuses[0]

    @property
    def cancelled(self) -> str:
        return self.statuses[1]

    @property
    def no_show(self) -> str:
        return self.statuses[2]
