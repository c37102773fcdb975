"""Column functions against hand-made rows and against Python where it defines the result."""

from __future__ import annotations

import datetime as dt
import sys

import pytest
from pyspark.sql import functions as F

from revisit.config import Settings
from revisit.functions import calendar, text
from revisit.operators.retention import cadence_band


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_client_names(spark):
    given = ["  Ann   Lee ", "walk in", "WALK-IN", "walkIn", "  ", None, "a  b\x1cc", "Walk\t in", "Ann"]
    assert apply(spark, text.normalize_client_name, given) == [
        "Ann Lee", "WALK_IN", "WALK_IN", "WALK_IN", None, None, "a b c", "WALK_IN", "Ann",
    ]


def test_whitespace_agrees_with_python(spark):
    given = [f"x{chr(c)}y" for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    expected = [" ".join(v.split()) for v in given]
    assert apply(spark, text.normalize_client_name, given) == expected
    assert apply(spark, text.strip, [v[1] for v in given]) == [v[1].strip() for v in given]


def test_casefold_agrees_with_python_on_every_letter(spark):
    given = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    given += ["Straße ÀÉ", "ΣΑΣ", "İstanbul", "ŉ ﬃ", "plain ASCII", ""]
    assert apply(spark, text.casefold, given) == [v.casefold() for v in given]


def test_client_keys(spark):
    rows = [("Ann Lee", dt.datetime(2025, 7, 25, 9)), ("Ann Lee", None), (None, dt.datetime(2025, 7, 25))]
    df = spark.createDataFrame(rows, "n string, v timestamp_ntz")
    keys = [r[0] for r in df.select(text.make_client_key(F.col("n"), F.col("v"))).collect()]
    assert keys == ["client_dd229918a80debbb", None, None]


def test_identifiers(spark):
    given = ["25.0", "a1.0", " 7 ", "25.00", "  ", None, "0012"]
    assert apply(spark, text.normalize_identifier, given) == ["25", "a1.0", "7", "25.00", None, None, "0012"]


def test_durations(spark):
    given = ["1h:30min", "45min", "0min", "1h", " 2h:5min ", "x45min", None, "90 min", "99999999h:5min", "9" * 40 + "min", "35791394h:7min", "35791394h:8min"]
    assert apply(spark, text.parse_duration_minutes, given) == [90, 45, 0, None, 125, None, None, None, None, None, 2147483647, None]


def test_numbers_out_of_range(spark):
    assert apply(spark, text.parse_number, ["1e400", "-1e400", "1e18", "-9e17"]) == [None, None, None, -9e17]


def test_money_is_not_rounded_row_by_row(spark):
    from revisit.config import Settings
    from revisit.functions.calendar import money

    rows = spark.range(1000).select(F.lit(0.004).alias("v"))
    assert float(rows.agg(F.sum(money(F.col("v"), Settings()))).first()[0]) == 4.0
    large = spark.createDataFrame([(1e17,), (float("inf"),), (1e30,)], "v double")
    assert float(large.agg(F.sum(money(F.col("v"), Settings()))).first()[0]) == 1e17


def test_numbers(spark):
    given = ["12.5", "$5", "1,000", "1d", "1f", "NaN", "inf", " -3 ", "1e3", ".5", "5.", "", None]
    assert apply(spark, text.parse_number, given) == [
        12.5, None, None, None, None, None, None, -3.0, 1000.0, 0.5, 5.0, None, None,
    ]
    assert apply(spark, text.parse_whole_number, ["3", "3.0", "3.5", "x"]) == [3, 3, None, None]


def test_headers(spark):
    given = ["No. of bookings", "Service/product/add-on", "A & B", "  Tip amount ", "First and last name", "Revenue (net)"]
    assert apply(spark, text.snake_case, given) == [
        "no_of_bookings", "service_product_add_on", "a_and_b", "tip_amount", "first_and_last_name", "revenue_net",
    ]


def test_datetimes(spark):
    given = [
        "2025-07-25", "2025-07-25 09:30", "2025-07-25T09:30:15", "2025-07-25 09:30:15.250", "7/25/2025", "7/5/25",
        "07/25/2025 14:05", "7/25/2025 2:05 pm", "7/25/25, 12:00 AM", "25/07/2025", "2/30/2025", "9:30", "", None,
        "1/2/95", "2025-13-01",
    ]
    at = dt.datetime
    assert apply(spark, calendar.parse_datetime, given) == [
        at(2025, 7, 25), at(2025, 7, 25, 9, 30), at(2025, 7, 25, 9, 30, 15), at(2025, 7, 25, 9, 30, 15, 250000),
        at(2025, 7, 25), at(2025, 7, 5), at(2025, 7, 25, 14, 5), at(2025, 7, 25, 14, 5), at(2025, 7, 25), None, None,
        None, None, None, at(1995, 1, 2), None,
    ]


def test_percent_text_agrees_with_python_on_every_rate(spark):
    given = [round(i / 10000, 4) for i in range(10001)]
    assert apply(spark, text.percent_text, given, "double") == [f"{v:.1%}" for v in given]


def test_repeat_rate_text(spark):
    df = spark.createDataFrame([(None, 0, 0), (0.2917, 7, 24), (None, 1, 3)], "r double, n int, b int")
    shown = [r[0] for r in df.select(text.repeat_rate_text(F.col("r"), F.col("n"), F.col("b"))).collect()]
    assert shown == ["Not yet eligible", "29.2% (7 of 24 eligible)", "—"]


def test_month_label(spark):
    assert apply(spark, text.month_label, ["2025-07", "2026-12"]) == ["July 2025", "December 2026"]


def test_period_and_partial(spark):
    settings = Settings()
    months = ["2026-02", "2026-03", "2026-04", "2025-07"]
    assert apply(spark, lambda c: calendar.period_label(c, settings), months) == [
        "pre_gbp", "gbp_creation_month", "post_gbp", "pre_gbp",
    ]
    assert apply(spark, lambda c: calendar.partial_month_flag(c, settings), months) == [0, 0, 0, 1]


@pytest.mark.parametrize(
    ("days", "band"),
    [(1, "01_0_14_days"), (14, "01_0_14_days"), (15, "02_15_21_days"), (28, "03_22_28_days"), (35, "04_29_35_days"),
     (42, "05_36_42_days"), (60, "06_43_60_days"), (90, "07_61_90_days"), (91, "08_91_plus_days")],
)
def test_cadence_bands(spark, days, band):
    assert apply(spark, cadence_band, [days], "int") == [band]


def test_published_rates_follow_from_their_counts(spark):
    """Numerator, base and rate pairs of the published run."""
    pairs = [(8, 12, 0.6667), (4, 12, 0.3333), (28, 30, 0.9333), (38, 48, 0.7917), (3, 48, 0.0625), (9, 48, 0.1875),
             (7, 24, 0.2917), (5, 78, 0.0641), (64, 78, 0.8205), (61, 180, 0.3389)]
    df = spark.createDataFrame([p[:2] for p in pairs], "k long, n long")
    rates = [r[0] for r in df.select(calendar.ratio(F.col("k"), F.col("n"))).collect()]
    assert rates == [p[2] for p in pairs]
    assert spark.range(1).select(calendar.ratio(F.lit(1), F.lit(0))).first()[0] is None
