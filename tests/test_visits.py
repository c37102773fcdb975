"""Visit sequences, retention, active clients and cadence on hand-made and random rows."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from revisit.config import Settings
from revisit.operators import monthly, retention, visits
from revisit.schemas import APPOINTMENTS, CLIENTS

S = Settings()
DAY = dt.datetime


def appointments(spark, rows):
    """rows: (id, time, client, status, service, value, minutes), the last ones optional."""
    full = []
    for row in rows:
        booking, moment, client, status, service, value, minutes = (*row, *("Completed", "Cut", 10.0, 30)[len(row) - 3:])
        record = dict.fromkeys(APPOINTMENTS.fieldNames())
        record.update(
            booking_id=booking, appointment_datetime=moment, client_key=client, status=status, service=service,
            service_value=value, service_length_minutes=minutes, client_match_status="exact_name",
        )
        full.append(tuple(record.values()))
    return spark.createDataFrame(full, APPOINTMENTS)


def clients(spark, firsts):
    rows = []
    for key, first in firsts.items():
        record = dict.fromkeys(CLIENTS.fieldNames())
        record.update(client_key=key, first_visit=first, bookings_count=0, no_shows_count=0)
        rows.append(tuple(record.values()))
    return spark.createDataFrame(rows, CLIENTS)


def analysis(spark, rows, settings=S):
    return visits.analysis_appointments(appointments(spark, rows), settings)


def test_administrative_and_null_services_fall_out(spark):
    rows = [("1", DAY(2025, 8, 1), "a"), ("2", DAY(2025, 8, 1), "a", "Completed", "LEAVE A REVIEW"),
            ("3", DAY(2025, 8, 1), "a", "Completed", None), ("4", DAY(2025, 8, 31, 23, 59), None, "Other")]
    out = {r.booking_id: r for r in analysis(spark, rows).collect()}
    assert set(out) == {"1", "4"}
    assert out["4"].appointment_month == "2025-08" and out["4"].appointment_date == dt.date(2025, 8, 31)
    assert (out["4"].is_completed, out["4"].is_cancelled, out["4"].is_no_show) == (0, 0, 0)


def test_visit_order_and_flags(spark):
    moment = DAY(2025, 8, 1, 10)
    rows = [("9", moment, "a"), ("10", moment, "a"), ("11", DAY(2025, 8, 1, 9), "a", "Cancelled"),
            ("12", DAY(2025, 9, 1), "b"), ("13", DAY(2025, 9, 1), "ghost"), ("14", DAY(2025, 9, 2), None)]
    known = clients(spark, {"a": DAY(2025, 7, 25), "b": DAY(2025, 7, 24, 23)})
    out = {r.booking_id: r for r in visits.client_completed_visits(analysis(spark, rows), known).collect()}
    assert set(out) == {"9", "10", "12"}
    assert (out["10"].observed_visit_number, out["9"].observed_visit_number) == (1, 2)
    assert out["10"].is_observed_new_client == 1 and out["9"].is_repeat_completed_visit == 1
    assert out["12"].source_indicates_pre_reporting_client == 1 and out["12"].is_observed_new_client == 0


@pytest.mark.parametrize("hot_rows", [1_000_000, 40, 7, 1])
def test_numbering_equals_a_plain_window_also_when_hours_are_split(spark, hot_rows):
    rng = random.Random(hot_rows)
    rows = []
    for i in range(600):
        client = "hot" if rng.random() < 0.5 else rng.choice("abc")
        # Half of the hot client's visits share one instant.
        moment = DAY(2025, 8, 1, 9) if rng.random() < 0.5 else DAY(2025, 8, rng.randint(1, 28), rng.randint(0, 23), rng.randint(0, 59))
        rows.append((str(i), moment, client))
    base = analysis(spark, rows)
    known = clients(spark, {k: DAY(2025, 8, 1) for k in ("hot", "a", "b")})
    out = visits.client_completed_visits(base, known, Settings(hot_rows=hot_rows))
    plain = base.where("client_key <> 'c'").select(
        "booking_id",
        F.row_number().over(Window.partitionBy("client_key").orderBy("appointment_datetime", "booking_id")).alias("n"),
        F.min("appointment_datetime").over(Window.partitionBy("client_key")).alias("first"),
    )
    got = out.select("booking_id", "observed_visit_number", "observed_first_completed_visit").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain.collect()))


def test_same_day_bookings_repeat_rows_but_not_days(spark):
    rows = [("1", DAY(2025, 8, 1, 9), "a"), ("2", DAY(2025, 8, 1, 15), "a")]
    base, known = analysis(spark, rows), clients(spark, {"a": DAY(2025, 8, 1)})
    performance = monthly.monthly_performance(base, known).first()
    assert (performance.observed_new_clients, performance.returning_clients) == (1, 1)
    kept = retention.client_retention(base, known).first()
    assert (kept.completed_visit_days, kept.ever_repeated_observed, kept.days_to_second_visit) == (1, 0, None)


@pytest.mark.parametrize(("gap", "within"), [(42, 1), (43, 0)])
def test_repeat_window_edge(spark, gap, within):
    first = DAY(2025, 8, 1)
    rows = [("1", first, "a"), ("2", first + dt.timedelta(days=gap), "a"), ("3", first + dt.timedelta(days=200), None)]
    kept = retention.client_retention(analysis(spark, rows), clients(spark, {"a": first})).first()
    assert (kept.repeated_within_42d, kept.repeated_within_90d, kept.eligible_for_42d_repeat) == (within, 1, 1)
    # An unlinked visit sets the observation end.
    assert kept.observation_end_date == (first + dt.timedelta(days=200)).date()


@pytest.mark.parametrize(("end", "eligible"), [(42, 1), (41, 0)])
def test_eligibility_edge_and_censored_rate(spark, end, eligible):
    first = DAY(2025, 8, 1)
    rows = [("1", first, "a"), ("2", first + dt.timedelta(days=end), None)]
    kept = retention.client_retention(analysis(spark, rows), clients(spark, {"a": first}))
    assert kept.first().eligible_for_42d_repeat == eligible
    cohort = retention.client_cohorts(kept).first()
    assert cohort.repeat_rate_42d == (0.0 if eligible else None) and cohort.repeat_rate_90d is None
    assert cohort.avg_days_to_second_visit is None


def test_active_window_edges_and_gap_months(spark):
    end = dt.date(2025, 10, 31)
    back = lambda n: DAY.combine(end - dt.timedelta(days=n), dt.time(12))
    rows = [("1", back(41), "a"), ("2", back(42), "b"), ("3", back(89), "c"), ("4", back(90), "d"),
            ("5", DAY(2025, 12, 1), None, "Cancelled")]
    out = {r.month: (r.active_clients_42d, r.active_clients_90d) for r in monthly.active_clients(analysis(spark, rows)).collect()}
    assert list(out) == ["2025-08", "2025-09", "2025-10", "2025-11", "2025-12"]
    assert out["2025-10"] == (1, 3)
    assert out["2025-11"] == (0, 2) and out["2025-12"] == (0, 0)


def test_empty_input(spark):
    base, none = analysis(spark, []), clients(spark, {})
    assert monthly.active_clients(base).isEmpty()
    assert monthly.monthly_performance(base, none).isEmpty()
    assert retention.client_cohorts(retention.client_retention(base, none)).isEmpty()
    assert retention.repeat_cadence_of(base).isEmpty()


def random_rows(seed, n=500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        client = rng.choice(["hot", "hot", "a", "b", "c", "d", "e", "ghost", None])
        moment = DAY(2025, 6, 20) + dt.timedelta(days=int(rng.triangular(0, 420, 60)), hours=rng.randint(8, 18))
        status = rng.choice(["Completed", "Completed", "Completed", "Cancelled", "No-show"])
        service = rng.choice(["Cut", "Shave", "LEAVE A REVIEW"])
        rows.append((str(i), moment, client, status, service, round(rng.uniform(5, 90), 2), rng.choice([None, 15, 30])))
    return rows


FIRSTS = {"hot": DAY(2025, 8, 1), "a": DAY(2025, 1, 1), "b": DAY(2025, 7, 25), "c": None, "d": DAY(2025, 9, 9), "e": DAY(2025, 7, 24)}


@pytest.mark.parametrize("seed", [11, 12])
def test_metrics_against_plain_python(spark, seed):
    rows = random_rows(seed)
    base, known = analysis(spark, rows), clients(spark, FIRSTS)
    kept = [r for r in rows if r[4] != "LEAVE A REVIEW"]
    done = sorted((r[2], r[1], r[0]) for r in kept if r[3] == "Completed" and r[2])
    fresh, again, people = defaultdict(set), defaultdict(set), defaultdict(set)
    seen, days = set(), defaultdict(set)
    for client, moment, _ in done:
        month = f"{moment:%Y-%m}"
        people[month].add(client)
        days[client].add(moment.date())
        if client in FIRSTS:
            if client in seen:
                again[month].add(client)
            elif FIRSTS[client] and FIRSTS[client] >= DAY(2025, 7, 25):
                fresh[month].add(client)
            seen.add(client)
    out = {r.month: r for r in monthly.monthly_performance(base, known).collect()}
    for month, r in out.items():
        mine = [x for x in kept if f"{x[1]:%Y-%m}" == month]
        finished = [x for x in mine if x[3] == "Completed"]
        assert r.booked_service_appointments == len(mine)
        assert r.unique_completed_clients == len(people[month])
        assert (r.observed_new_clients, r.returning_clients) == (len(fresh[month]), len(again[month]))
        # As in SQL, a sum over nothing but nulls is null.
        minutes = [0 if x[3] != "Completed" else x[6] for x in mine if x[3] != "Completed" or x[6] is not None]
        assert r.completed_service_minutes == (sum(minutes) if minutes else None)
        assert r.completed_service_value == pytest.approx(sum(x[5] for x in finished), abs=0.001)

    for r in monthly.active_clients(base).collect():
        for window, got in ((42, r.active_clients_42d), (90, r.active_clients_90d)):
            start = r.month_end - dt.timedelta(days=window - 1)
            assert got == sum(any(start <= d <= r.month_end for d in ds) for ds in days.values())

    gaps = sorted((b - a).days for ds in days.values() for a, b in zip(sorted(ds), sorted(ds)[1:]))
    intervals = visits.visit_intervals(visits.visit_days(base))
    assert sorted(r.days_between_visits for r in intervals.collect()) == gaps
    cadence = retention.repeat_cadence(intervals).collect()
    assert sum(r.return_intervals for r in cadence) == len(gaps)
    assert [r.cadence_band for r in cadence] == sorted(r.cadence_band for r in cadence)


def test_stored_visit_days_give_the_same_metrics(spark, tmp_path):
    base, known = analysis(spark, random_rows(13)), clients(spark, FIRSTS)
    visits.visit_days(base).write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    assert monthly.monthly_performance(base, known, S, days).collect() == monthly.monthly_performance(base, known).collect()
    assert monthly.active_clients(base, S, days).collect() == monthly.active_clients(base).collect()
    a = retention.client_retention(base, known, S, days).orderBy("client_key").collect()
    assert a == retention.client_retention(base, known).orderBy("client_key").collect()
