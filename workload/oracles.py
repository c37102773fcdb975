"""The same results as SQL over the given tables, written independently of the library.

Rates are rounded in whole numbers: round(k/n, 4) is floor((20000 k + n) / 2n) / 10000.
"""

from __future__ import annotations

APPT = """
appt AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS booking_id,
         CAST((CASE WHEN o_orderkey % 4 = 0 THEN CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP)
                    ELSE o_orderdate END) + to_hours(CAST(o_orderkey % 10 AS INTEGER)) AS TIMESTAMP) AS moment,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'LEAVE A REVIEW' ELSE o_orderpriority END AS service,
         o_totalprice AS value,
         CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Cancelled' WHEN 'P' THEN 'No-show' END AS status,
         CASE WHEN o_orderkey % 50 <> 0 THEN CAST(15 * (1 + o_orderkey % 8) AS INTEGER) END AS minutes,
         CASE WHEN o_orderkey % 20 <> 0 THEN 'client_' || o_custkey END AS client_key
  FROM orders
),
svc AS (
  SELECT *, CAST(moment AS DATE) AS d, strftime(moment, '%Y-%m') AS month FROM appt WHERE service <> 'LEAVE A REVIEW'
),
linked AS (SELECT * FROM svc WHERE status = 'Completed' AND client_key IS NOT NULL)
"""

CLIENTS = """
cl AS (
  SELECT 'client_' || c_custkey AS client_key, c_mktsegment AS groups, coalesce(n, 0) AS bookings_count,
         coalesce(p, 0) AS no_shows_count,
         CASE WHEN c_custkey % 4 = 0 THEN lo - INTERVAL 400 DAY ELSE lo END AS first_visit, hi AS last_visit,
         c_acctbal AS total_revenue
  FROM customer LEFT JOIN (
    SELECT o_custkey, min(o_orderdate) AS lo, max(o_orderdate) AS hi, count(*) AS n,
           count(*) FILTER (o_orderstatus = 'P') AS p
    FROM orders GROUP BY ALL) ON o_custkey = c_custkey
)
"""

SALES = """
sale AS (
  SELECT l_shipdate AS checkout_date, CAST(l_orderkey AS VARCHAR) AS transaction_id, l_linestatus AS type,
         l_returnflag AS category, p_name AS item, l_quantity AS quantity,
         CASE WHEN l_linenumber % 5 <> 0 THEN o_orderdate END AS booking_date, l_extendedprice AS service_value,
         CASE WHEN o_orderkey % 20 <> 0 THEN 'client_' || o_custkey END AS client_key,
         CASE WHEN o_orderkey % 20 <> 0 THEN 'exact_name' ELSE 'unmatched' END AS match_status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
)
"""

NAMED = """
person AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 10 IN (0, 1) THEN 'Client ' || (c_custkey // 10)
              WHEN c_custkey % 10 = 2 THEN 'Guest ' || (c_custkey // 10)
              WHEN c_custkey % 10 = 3 THEN upper('Guest ' || (c_custkey // 10))
              ELSE c_name END AS name
  FROM customer
),
named AS (
  SELECT p.c_custkey, p.name, f.first_visit FROM person p
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_visit FROM orders GROUP BY o_custkey) f
    ON f.o_custkey = p.c_custkey
),
ref AS (
  SELECT name, lower(name) AS folded, CAST(first_visit AS DATE) AS day,
         'client_' || left(sha256(name || '|' || strftime(first_visit, '%Y-%m-%d')), 16) AS k
  FROM named
),
said AS (
  SELECT o_orderkey, o_orderdate,
         CASE o_orderkey % 8 WHEN 0 THEN upper(name) WHEN 1 THEN lower(name) WHEN 2 THEN 'Walk-In' WHEN 3 THEN NULL
              WHEN 4 THEN name || '?' ELSE name END AS client
  FROM orders JOIN person ON c_custkey = o_custkey
)
"""


def resolve(source: str) -> str:
    """CTEs ending in `linked_events(id, k, match_status)` for events (id, client, day) of `source`.

    Counts joined candidates per event, where the library counts per name and day.
    """

    def tally(name: str, column: str, event_column: str) -> str:
        return f"""{name} AS (
  SELECT e.id, count(*) AS n, max(r.k) AS k,
         count(*) FILTER (r.day = e.day) AS n_same, max(r.k) FILTER (r.day = e.day) AS k_same,
         count(*) FILTER (r.day <= e.day) AS n_by, max(r.k) FILTER (r.day <= e.day) AS k_by
  FROM ev e JOIN ref r ON r.{column} = e.{event_column} GROUP BY e.id)"""

    def dated(t: str) -> str:
        return f"CASE WHEN {t}.n_same = 1 THEN {t}.k_same WHEN {t}.n_by = 1 THEN {t}.k_by END"

    return f"""
ev AS (SELECT id, client, lower(client) AS folded, day FROM ({source}) WHERE client <> 'Walk-In'),
{tally("ex", "name", "client")},
{tally("fo", "folded", "folded")},
linked_events AS (
  SELECT s.id,
         CASE WHEN ex.n = 1 THEN ex.k WHEN ex.n > 1 THEN {dated("ex")}
              WHEN fo.n = 1 THEN fo.k WHEN fo.n > 1 THEN {dated("fo")} END AS k,
         CASE WHEN ex.n = 1 THEN 'exact_name'
              WHEN ex.n > 1 THEN CASE WHEN {dated("ex")} IS NULL THEN 'ambiguous' ELSE 'event_date' END
              WHEN fo.n = 1 THEN 'casefold_unique'
              WHEN fo.n > 1 THEN CASE WHEN {dated("fo")} IS NULL THEN 'ambiguous' ELSE 'event_date' END
              ELSE 'unmatched' END AS match_status
  FROM ({source}) s LEFT JOIN ex ON ex.id = s.id LEFT JOIN fo ON fo.id = s.id
)"""


def rate(part: str, whole: str) -> str:
    return f"(CASE WHEN {whole} > 0 THEN ((20000 * ({part}) + {whole}) // (2 * {whole})) / 10000.0 END)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def period(month: str) -> str:
    return (
        f"CASE WHEN {month} < '1998-03' THEN 'pre_gbp' WHEN {month} = '1998-03' THEN 'gbp_creation_month' "
        f"ELSE 'post_gbp' END AS intervention_period, CASE WHEN {month} = '1995-01' THEN 1 ELSE 0 END AS is_partial_month"
    )


EVENT_SOURCE = "SELECT o_orderkey AS id, client, CAST(o_orderdate AS DATE) AS day FROM said"

SEQUENCED = """
seq AS (
  SELECT l.*, c.first_visit, row_number() OVER w AS visit_no, min(l.moment) OVER (PARTITION BY l.client_key) AS first_at
  FROM linked l JOIN cl c USING (client_key)
  WINDOW w AS (PARTITION BY l.client_key ORDER BY l.moment, l.booking_id)
)
"""

PERFORMANCE = f"""{APPT}, {CLIENTS}, {SEQUENCED},
volume AS (
  SELECT month, count(*) AS booked, count(*) FILTER (status = 'Completed') AS done,
         count(*) FILTER (status = 'Cancelled') AS lost, count(*) FILTER (status = 'No-show') AS absent,
         count(DISTINCT client_key) FILTER (status = 'Completed') AS people,
         {big("sum(CASE WHEN status = 'Completed' THEN minutes ELSE 0 END)")} AS minutes,
         CAST(CAST(sum(CASE WHEN status = 'Completed' THEN CAST(value AS DECIMAL(28,9)) ELSE 0 END) AS DECIMAL(38,2)) AS DOUBLE) AS value
  FROM svc GROUP BY month
),
people AS (
  SELECT month, count(DISTINCT client_key) FILTER (visit_no = 1 AND first_visit >= DATE '1995-01-01') AS fresh,
         count(DISTINCT client_key) FILTER (visit_no > 1) AS again
  FROM seq GROUP BY month
),
perf AS (
  SELECT v.month, booked AS booked_service_appointments, done AS completed_service_appointments,
         lost AS cancelled_service_appointments, absent AS no_show_service_appointments,
         v.people AS unique_completed_clients, coalesce(fresh, 0) AS observed_new_clients,
         coalesce(again, 0) AS returning_clients, {rate("done", "booked")} AS completion_rate,
         {rate("lost", "booked")} AS cancellation_rate, {rate("absent", "booked")} AS no_show_rate,
         minutes AS completed_service_minutes, value AS completed_service_value, {period("v.month")}
  FROM volume v LEFT JOIN people p ON p.month = v.month
)"""

RETENTION = f"""{APPT}, {CLIENTS},
days AS (SELECT DISTINCT client_key, d FROM linked SEMI JOIN cl USING (client_key)),
summary AS (SELECT client_key, list_sort(list(d)) AS ds FROM days GROUP BY client_key),
kept AS (
  SELECT client_key, ds[1] AS d1, ds[2] AS d2, ds[-1] AS dn, len(ds) AS n,
         CAST(ds[2] - ds[1] AS INTEGER) AS gap, (SELECT max(d) FROM svc WHERE status = 'Completed') AS end_day
  FROM summary
),
ret AS (
  SELECT client_key, d1 AS first_completed_visit, strftime(d1, '%Y-%m') AS acquisition_cohort_month,
         d2 AS second_completed_visit, dn AS latest_completed_visit, {big("n")} AS completed_visit_days,
         gap AS days_to_second_visit, CAST(d2 IS NOT NULL AS INTEGER) AS ever_repeated_observed,
         CAST(d1 + 42 <= end_day AS INTEGER) AS eligible_for_42d_repeat,
         CAST(d1 + 42 <= end_day AND coalesce(gap <= 42, false) AS INTEGER) AS repeated_within_42d,
         CAST(d1 + 90 <= end_day AS INTEGER) AS eligible_for_90d_repeat,
         CAST(d1 + 90 <= end_day AND coalesce(gap <= 90, false) AS INTEGER) AS repeated_within_90d,
         end_day AS observation_end_date
  FROM kept
),
coh AS (
  SELECT acquisition_cohort_month AS m, count(*) AS n, {big("sum(ever_repeated_observed)")} AS ever,
         {big("sum(eligible_for_42d_repeat)")} AS e42, {big("sum(repeated_within_42d)")} AS r42,
         {big("sum(eligible_for_90d_repeat)")} AS e90, {big("sum(repeated_within_90d)")} AS r90,
         {big("sum(days_to_second_visit)")} AS gaps, count(days_to_second_visit) AS n_gaps
  FROM ret GROUP BY m
),
cohorts AS (
  SELECT m AS cohort_month, n AS acquired_clients, ever AS clients_ever_repeated_observed,
         {rate("ever", "n")} AS observed_repeat_rate, e42 AS clients_eligible_42d, r42 AS clients_repeated_42d,
         {rate("r42", "e42")} AS repeat_rate_42d, e90 AS clients_eligible_90d, r90 AS clients_repeated_90d,
         {rate("r90", "e90")} AS repeat_rate_90d,
         CASE WHEN n_gaps > 0 THEN ((20 * gaps + n_gaps) // (2 * n_gaps)) / 10.0 END AS avg_days_to_second_visit,
         {period("m")}
  FROM coh
)"""

GAPS = f"""{APPT},
days AS (SELECT DISTINCT client_key, d FROM linked),
gaps AS (
  SELECT client_key, lag(d) OVER (PARTITION BY client_key ORDER BY d) AS d0, d FROM days
  QUALIFY d0 IS NOT NULL
)"""

TEXT_RATE = "format('{{:.1f}}%', {0} * 100)"


def rate_text(window: int) -> str:
    return (
        f"CASE WHEN clients_eligible_{window}d = 0 THEN 'Not yet eligible' ELSE "
        f"format('{{:.1f}}% ({{}} of {{}} eligible)', repeat_rate_{window}d * 100, clients_repeated_{window}d, "
        f"clients_eligible_{window}d) END AS repeat_rate_{window}d_text"
    )


def finding(dataset: str, kind: str, name: str, findings: str = "NULL", detail: str = "NULL") -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{kind}' AS kind, '{name}' AS name, "
        f"{big(findings)} AS findings, CAST({detail} AS VARCHAR) AS detail"
    )


def shared(key: str, source: str) -> str:
    """Rows that share a key, null keys being equal."""
    return f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {source} GROUP BY {key}) WHERE n > 1)"


ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"

MESSY_EVENTS = f"""{NAMED}, {resolve(EVENT_SOURCE)},
t AS (
  SELECT CASE WHEN o_orderkey % 100 <> 0 THEN CAST(o_orderkey // 2 AS VARCHAR) END AS booking_id,
         CASE WHEN o_orderkey % 30 <> 0 THEN o_orderdate END AS moment,
         CASE WHEN o_orderstatus = 'F' THEN 'Completed' ELSE o_orderstatus END AS status, k, match_status
  FROM orders JOIN linked_events ON id = o_orderkey
)"""

MESSY_CLIENTS = f"""{NAMED},
t AS (
  SELECT CASE WHEN (c_custkey // 10) % 7 <> 0 THEN 'client_' || (c_custkey // 10) END AS k, first_visit,
         TIMESTAMP '1996-06-01' AS last_visit
  FROM named
)"""

MESSY_SALES = f"""{SALES},
t AS (
  SELECT CASE WHEN category <> 'R' THEN checkout_date END AS moment,
         CASE WHEN type = 'O' THEN transaction_id END AS tid, client_key AS k, match_status
  FROM sale
)"""

MONTHS = """
bounds AS (SELECT min(d) AS lo, max(d) AS hi FROM svc),
ends AS (
  SELECT CAST(s AS DATE) AS start, last_day(CAST(s AS DATE)) AS month_end, strftime(s, '%Y-%m') AS month
  FROM (SELECT unnest(generate_series(date_trunc('month', CAST(lo AS TIMESTAMP)), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS s
        FROM bounds)
)"""

RAW_APPOINTMENTS = f"""{APPT}, {NAMED},
raw AS (
  SELECT o_orderkey, booking_id, s.client, o_orderdate, a.service, a.value, a.status, a.minutes
  FROM said s JOIN appt a ON a.booking_id = CAST(s.o_orderkey AS VARCHAR)
)"""



def cents(key: str, factor: int) -> str:
    return f"({key} * {factor} % 100000) / CAST(100 AS DOUBLE)"


ORACLES: dict[str, str] = {
    "analysis_appointments": f"""WITH {APPT}
SELECT booking_id, moment AS appointment_datetime, d AS appointment_date, month AS appointment_month,
       NULL::VARCHAR AS main_category, service, NULL::VARCHAR AS staffer, value AS service_value,
       NULL::DOUBLE AS addons_value, NULL::DOUBLE AS revenue_net, NULL::DOUBLE AS discount, NULL::DOUBLE AS tax,
       NULL::DOUBLE AS tip_amount, value AS total_revenue, status, minutes AS service_length_minutes, client_key,
       CASE WHEN client_key IS NULL THEN 'unmatched' ELSE 'exact_name' END AS client_match_status,
       CAST(status = 'Completed' AS INTEGER) AS is_completed, CAST(status = 'Cancelled' AS INTEGER) AS is_cancelled,
       CAST(status = 'No-show' AS INTEGER) AS is_no_show
FROM svc""",
    "visit_days": f"""WITH {APPT}
SELECT client_key, d AS appointment_date, count(*) AS visits FROM linked GROUP BY ALL""",
    "client_completed_visits": f"""WITH {APPT}, {CLIENTS}, {SEQUENCED}
SELECT booking_id, moment AS appointment_datetime, d AS appointment_date, month AS appointment_month, service,
       value AS service_value, value AS total_revenue, client_key, 'exact_name' AS client_match_status,
       first_visit AS source_first_visit, visit_no AS observed_visit_number,
       first_at AS observed_first_completed_visit,
       CAST(visit_no = 1 AS INTEGER) AS is_first_observed_completed_visit,
       CAST(visit_no > 1 AS INTEGER) AS is_repeat_completed_visit,
       CAST(first_visit < DATE '1995-01-01' AS INTEGER) AS source_indicates_pre_reporting_client,
       CAST(visit_no = 1 AND first_visit >= DATE '1995-01-01' AS INTEGER) AS is_observed_new_client
FROM seq""",
    "monthly_performance": f"WITH {PERFORMANCE} SELECT * FROM perf ORDER BY month",
    "month_spine": f"WITH {APPT}, {MONTHS} SELECT month, month_end FROM ends",
    "active_clients": f"""WITH {APPT}, {MONTHS}
SELECT ends.month, month_end, count(DISTINCT client_key) FILTER (month_end - d <= 41) AS active_clients_42d,
       count(DISTINCT client_key) AS active_clients_90d, {period("ends.month")}
FROM ends LEFT JOIN linked ON d <= month_end AND d >= month_end - 89
GROUP BY ends.month, month_end""",
    "client_retention": f"WITH {RETENTION} SELECT * FROM ret",
    "client_cohorts": f"WITH {RETENTION} SELECT * FROM cohorts",
    "visit_intervals": f"""WITH {GAPS}
SELECT client_key, d0 AS prior_visit_date, d AS return_visit_date, CAST(d - d0 AS INTEGER) AS days_between_visits
FROM gaps""",
    "repeat_cadence": f"""WITH {GAPS},
bands(lo, hi, cadence_band) AS (
  VALUES (0, 14, '01_0_14_days'), (15, 21, '02_15_21_days'), (22, 28, '03_22_28_days'), (29, 35, '04_29_35_days'),
         (36, 42, '05_36_42_days'), (43, 60, '06_43_60_days'), (61, 90, '07_61_90_days'),
         (91, 1000000, '08_91_plus_days')
),
counted AS (SELECT cadence_band, count(*) AS n FROM gaps JOIN bands ON d - d0 BETWEEN lo AND hi GROUP BY ALL),
total AS (SELECT {big("sum(n)")} AS t FROM counted)
SELECT cadence_band, n AS return_intervals, ((2000 * n + t) // (2 * t)) / 10.0 AS pct_of_return_intervals
FROM counted, total""",
    "service_monthly": f"""WITH {APPT},
c AS (
  SELECT month, service, count(*) AS booked, count(*) FILTER (status = 'Completed') AS done,
         {big("100 * (sum(CAST(value AS DECIMAL(28,9))) FILTER (status = 'Completed'))")} AS cents,
         {big("sum(minutes) FILTER (status = 'Completed')")} AS mins,
         count(minutes) FILTER (status = 'Completed') AS n_mins,
         min(d) FILTER (status = 'Completed') AS lo, max(d) FILTER (status = 'Completed') AS hi
  FROM svc GROUP BY month, service
)
SELECT month, service, booked AS booked_appointments, done AS completed_appointments,
       CASE WHEN done > 0 THEN ((2 * cents + done) // (2 * done)) / 100.0 END AS avg_completed_service_value,
       CASE WHEN n_mins > 0 THEN ((20 * mins + n_mins) // (2 * n_mins)) / 10.0 END AS avg_completed_service_minutes,
       lo AS first_completed_date_in_month, hi AS last_completed_date_in_month
FROM c""",
    "headline_latest": f"""WITH {PERFORMANCE}
SELECT month, strftime(CAST(month || '-01' AS DATE), '%B %Y') AS month_label,
       completed_service_appointments AS completed_appointments, observed_new_clients AS new_clients,
       returning_clients, is_partial_month
FROM perf WHERE month = (SELECT max(month) FROM perf)""",
    "trend_series": f"""WITH {PERFORMANCE}
SELECT month, completed_service_appointments AS completed_appointments, observed_new_clients AS new_clients,
       returning_clients, cancellation_rate * 100 AS cancellation_rate_pct, no_show_rate * 100 AS no_show_rate_pct
FROM perf""",
    "leakage_latest": f"""WITH {PERFORMANCE}
SELECT month, cancelled_service_appointments + no_show_service_appointments AS lost_bookings,
       cancelled_service_appointments AS cancelled, no_show_service_appointments AS no_show,
       format('{{}} cancelled + {{}} no-show', cancelled_service_appointments, no_show_service_appointments)
         AS lost_bookings_text,
       {TEXT_RATE.format("cancellation_rate")} AS cancellation_rate_text,
       {TEXT_RATE.format("no_show_rate")} AS no_show_rate_text
FROM perf ORDER BY month DESC LIMIT 1""",
    "retention_table": f"""WITH {RETENTION}
SELECT cohort_month, strftime(CAST(cohort_month || '-01' AS DATE), '%B %Y') AS acquisition_cohort, acquired_clients,
       {rate_text(42)}, {rate_text(90)}
FROM cohorts""",
    "normalize_names": """
SELECT c_custkey, CASE WHEN lower(name) IN ('walk-in', 'walk in', 'walkin') THEN 'WALK_IN' ELSE nullif(name, '') END
         AS client_name
FROM (SELECT c_custkey, trim(regexp_replace(CASE c_custkey % 6 WHEN 0 THEN '  ' || c_name || ' '
               WHEN 1 THEN replace(c_name, '#', ' ' || chr(9) || '  No ') WHEN 2 THEN 'Walk  IN' WHEN 3 THEN '   '
               WHEN 4 THEN 'WALK-in ' ELSE c_name END, '\\s+', ' ', 'g')) AS name
      FROM customer)""",
    "client_keys": f"WITH {NAMED} SELECT c_custkey, k AS client_key FROM named JOIN ref USING (name) "
    "WHERE ref.day IS NOT DISTINCT FROM CAST(first_visit AS DATE) GROUP BY ALL",
    "normalize_ids": """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 2 THEN 'a' || o_orderkey || '.0' WHEN 3 THEN NULL
         WHEN 4 THEN o_orderkey || '.05' ELSE CAST(o_orderkey AS VARCHAR) END AS source_id
FROM orders""",
    "parse_duration": """
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 3 * 60 + o_orderkey % 60
         WHEN 1 THEN o_orderkey % 60 END END AS INTEGER) AS minutes
FROM orders""",
    "numeric_coercion": """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CASE o_orderkey % 7 WHEN 2 THEN -CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE)
         WHEN 5 THEN CAST(o_orderkey * 100 AS DOUBLE)
         WHEN 6 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END END AS amount
FROM orders""",
    "event_datetime": """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 1, 4, 5)
         THEN o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + to_minutes(CAST(o_orderkey % 60 AS INTEGER))
         WHEN o_orderkey % 7 IN (2, 3) THEN o_orderdate END AS event_time
FROM orders""",
    "case_folded_names": f"WITH {NAMED} SELECT c_custkey, lower(name) AS client_name_casefold FROM named",
    "snake_case_headers": """
SELECT p_partkey, lower(trim(regexp_replace(p_type || ' and ' || p_brand || ' ' || p_name || ' net',
         '[^A-Za-z0-9]+', '_', 'g'), '_')) AS header
FROM part""",
    "identity_resolution": f"""WITH {NAMED}, {resolve(EVENT_SOURCE)}
SELECT id AS o_orderkey, k AS client_key, match_status AS client_match_status FROM linked_events""",
    "identity_status_counts": f"""WITH {NAMED}, {resolve(EVENT_SOURCE)}
SELECT match_status AS client_match_status, count(*) AS n_rows FROM linked_events GROUP BY ALL""",
    "status_counts": f"WITH {APPT} SELECT status, count(*) AS n_rows FROM appt GROUP BY status ORDER BY status",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "excess_keys": f"""WITH {APPT}
SELECT count(*) AS rows, count(DISTINCT client_key) AS distinct_keys,
       count(*) FILTER (client_key IS NULL) AS missing_rows, {big(shared("client_key", "appt"))} AS duplicate_rows,
       count(*) - count(DISTINCT client_key) AS excess_rows
FROM appt""",
    "distinct_transactions": f"WITH {SALES} SELECT count(DISTINCT transaction_id) AS unique_transactions FROM sale",
    "fk_violations": f"""WITH {APPT}
SELECT client_key, count(*) AS n_rows FROM appt
WHERE client_key NOT IN (SELECT client_key FROM linked) GROUP BY client_key""",
    "constraint_violations": f"""WITH {APPT}, {CLIENTS}, {SALES}
SELECT 'clients' AS table_name, 'bookings_count_not_negative' AS rule, count(*) FILTER (total_revenue < 0) AS violations FROM cl
UNION ALL SELECT 'clients', 'no_shows_count_not_negative', count(*) FILTER (no_shows_count = 0) FROM cl
UNION ALL SELECT 'appointments', 'appointment_datetime_present', count(*) FILTER (client_key IS NULL) FROM appt
UNION ALL SELECT 'appointments', 'service_present', count(*) FILTER (service = '1-URGENT') FROM appt
UNION ALL SELECT 'appointments', 'status_allowed', count(*) FILTER (status = 'No-show') FROM appt
UNION ALL SELECT 'appointments', 'service_length_positive', count(*) FILTER (minutes = 15) FROM appt
UNION ALL SELECT 'appointments', 'match_status_allowed', CAST(0 AS BIGINT)
UNION ALL SELECT 'sales', 'checkout_date_present', count(*) FILTER (type <> 'O') FROM sale
UNION ALL SELECT 'sales', 'transaction_id_present', count(*) FILTER (category = 'R') FROM sale
UNION ALL SELECT 'sales', 'match_status_allowed', count(*) FROM sale""",
    "row_reconciliation": f"""WITH {APPT}, {SALES},
pairs AS (
  SELECT 'appointments' AS table_name, (SELECT count(*) FROM orders) AS e, (SELECT count(*) FROM svc) AS a
  UNION ALL SELECT 'sales', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM sale)
)
SELECT table_name, e AS expected_rows, a AS actual_rows, a - e AS difference FROM pairs""",
    "load_summary": f"""WITH {APPT}, {SALES}
SELECT 'rows' AS name, 'clients' AS item, count(*) AS n_rows FROM customer
UNION ALL SELECT 'rows', 'appointments', count(*) FROM appt
UNION ALL SELECT 'rows', 'sales', count(*) FROM sale
UNION ALL SELECT 'transactions', 'sales', count(DISTINCT transaction_id) FROM sale
UNION ALL SELECT 'status', status, count(*) FROM appt GROUP BY status""",
    "validation_clients": f"""WITH {MESSY_CLIENTS}
{finding("clients", "rows", "rows", "count(*)")} FROM t
UNION ALL {finding("clients", "error", "missing_columns", "0")}
UNION ALL {finding("clients", "error", "first_visit_after_last_visit", "count(*) FILTER (first_visit > last_visit)")} FROM t
UNION ALL {finding("clients", "metric", "first_visit_min", detail=ISO.format("min(first_visit)"))} FROM t
UNION ALL {finding("clients", "metric", "last_visit_max", detail=ISO.format("max(last_visit)"))} FROM t
UNION ALL {finding("clients", "error", "rows_without_client_key", "count(*) FILTER (k IS NULL)")} FROM t
UNION ALL {finding("clients", "error", "rows_sharing_client_key", shared("k", "t"))}
UNION ALL {finding("clients", "metric", "unique_client_keys", "count(DISTINCT k)")} FROM t""",
    "validation_appointments": f"""WITH {MESSY_EVENTS}
{finding("appointments", "rows", "rows", "count(*)")} FROM t
UNION ALL {finding("appointments", "error", "missing_columns", "0")}
UNION ALL {finding("appointments", "error", "invalid_appointment_datetime", "count(*) FILTER (moment IS NULL)")} FROM t
UNION ALL {finding("appointments", "metric", "date_min", detail=ISO.format("min(moment)"))} FROM t
UNION ALL {finding("appointments", "metric", "date_max", detail=ISO.format("max(moment)"))} FROM t
UNION ALL {finding("appointments", "warning", "ambiguous_clients", "count(*) FILTER (match_status = 'ambiguous')")} FROM t
UNION ALL {finding("appointments", "error", "missing_booking_id", "count(*) FILTER (booking_id IS NULL)")} FROM t
UNION ALL {finding("appointments", "error", "rows_sharing_booking_id", shared("booking_id", "t"))}
UNION ALL {finding("appointments", "metric", "unique_booking_ids", "count(DISTINCT booking_id)")} FROM t
UNION ALL {finding("appointments", "metric", "linked_clients", "count(DISTINCT k)")} FROM t
UNION ALL {finding("appointments", "metric", "status_counts", "count(*)", "status")} FROM t GROUP BY status
UNION ALL {finding("appointments", "warning", "unexpected_status", "count(*)", "status")} FROM t
  WHERE status IN ('O', 'P') GROUP BY status
UNION ALL {finding("appointments", "metric", "client_match_counts", "count(*)", "match_status")} FROM t GROUP BY match_status""",
    "validation_sales": f"""WITH {MESSY_SALES}
{finding("sales", "rows", "rows", "count(*)")} FROM t
UNION ALL {finding("sales", "error", "missing_columns", "1", "'type'")}
UNION ALL {finding("sales", "error", "invalid_checkout_date", "count(*) FILTER (moment IS NULL)")} FROM t
UNION ALL {finding("sales", "metric", "date_min", detail=ISO.format("min(moment)"))} FROM t
UNION ALL {finding("sales", "metric", "date_max", detail=ISO.format("max(moment)"))} FROM t
UNION ALL {finding("sales", "warning", "ambiguous_clients", "count(*) FILTER (match_status = 'ambiguous')")} FROM t
UNION ALL {finding("sales", "warning", "unmatched_clients", "count(*) FILTER (match_status = 'unmatched')")} FROM t
UNION ALL {finding("sales", "error", "missing_transaction_id", "count(*) FILTER (tid IS NULL)")} FROM t
UNION ALL {finding("sales", "metric", "unique_transactions", "count(DISTINCT tid)")} FROM t
UNION ALL {finding("sales", "metric", "linked_clients", "count(DISTINCT k)")} FROM t
UNION ALL {finding("sales", "metric", "client_match_counts", "count(*)", "match_status")} FROM t GROUP BY match_status""",
    "report_rows": f"""WITH {RAW_APPOINTMENTS}
SELECT strftime(o_orderdate, '%-m/%-d/%Y %-I:%M %p') AS date_and_time, booking_id || '.0' AS booking_id, client,
       'Hair, face' AS main_category, service, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS service_value, status,
       CASE WHEN minutes >= 60 THEN (minutes // 60) || 'h:' || (minutes % 60) || 'min'
            ELSE minutes || 'min' END AS service_length
FROM raw""",
    "report_metadata": """
SELECT strftime(min(o_orderdate), '%-m/%-d/%y') AS report_period_start,
       strftime(max(o_orderdate), '%-m/%-d/%y') AS report_period_end
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_orderkey // 5000""",
    "report_column_counts": f"""WITH {RAW_APPOINTMENTS}, f AS (SELECT count(DISTINCT o_orderkey // 5000) AS n FROM raw)
SELECT 'date_and_time' AS column, count(*) + (SELECT n FROM f) AS n_values FROM raw
UNION ALL SELECT 'booking_id', count(*) + (SELECT n FROM f) FROM raw
UNION ALL SELECT 'client', count(client) FROM raw
UNION ALL SELECT 'main_category', count(*) FROM raw
UNION ALL SELECT 'service', count(*) FROM raw
UNION ALL SELECT 'service_value', count(*) FROM raw
UNION ALL SELECT 'status', count(status) FROM raw
UNION ALL SELECT 'service_length', count(minutes) FROM raw
UNION ALL SELECT 'payment_type', CAST(0 AS BIGINT)""",
    "clean_clients": f"""WITH {NAMED}, {CLIENTS}
SELECT CASE WHEN n.first_visit IS NOT NULL
            THEN 'client_' || left(sha256(n.name || '|' || strftime(n.first_visit, '%Y-%m-%d')), 16) END AS client_key,
       groups, bookings_count, no_shows_count, n.first_visit, c.last_visit,
       {cents("c_custkey", 3)} AS bookings_value, {cents("c_custkey", 7)} AS revenue_net,
       {cents("c_custkey", 11)} AS discount, {cents("c_custkey", 13)} AS tax, {cents("c_custkey", 17)} AS tip_amount,
       CAST(CAST(total_revenue AS DECIMAL(18,2)) AS DOUBLE) AS total_revenue
FROM named n JOIN cl c ON c.client_key = 'client_' || n.c_custkey""",
    "clean_appointments": f"""WITH {RAW_APPOINTMENTS}, {resolve(EVENT_SOURCE)}
SELECT booking_id, o_orderdate AS appointment_datetime, 'Hair, face' AS main_category, service, 'Ann' AS staffer,
       CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS service_value,
       {cents("o_orderkey", 5)} AS addons_value, {cents("o_orderkey", 7)} AS revenue_net,
       {cents("o_orderkey", 11)} AS discount, {cents("o_orderkey", 13)} AS tax, {cents("o_orderkey", 17)} AS tip_amount,
       CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS total_revenue, status, minutes AS service_length_minutes,
       k AS client_key, match_status AS client_match_status
FROM raw JOIN linked_events ON id = o_orderkey""",
    "clean_sales": f"""WITH {NAMED},
line AS (
  SELECT row_number() OVER () AS id, l.*, p_name, s.client, s.o_orderdate,
         CASE WHEN l_linenumber % 5 <> 0 THEN s.o_orderdate END AS booked
  FROM lineitem l JOIN said s ON l_orderkey = s.o_orderkey LEFT JOIN part ON l_partkey = p_partkey
), {resolve("SELECT id, client, CAST(coalesce(booked, l_shipdate) AS DATE) AS day FROM line")}
SELECT CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS checkout_date, CAST(l_orderkey AS VARCHAR) AS transaction_id,
       l_linestatus AS type, l_returnflag AS category, p_name AS item, 'Ann' AS staffer, l_quantity AS quantity,
       CAST(CAST(booked AS DATE) AS TIMESTAMP) AS booking_date,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS service_value,
       {cents("l_orderkey", 5)} AS addons_value, {cents("l_orderkey", 7)} AS revenue_net,
       CAST(CAST(l_discount AS DECIMAL(18,2)) AS DOUBLE) AS discount,
       CAST(CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) AS tax, {cents("l_orderkey", 17)} AS tip_amount,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS total_revenue, 'Card' AS payment_type,
       k AS client_key,
       match_status AS client_match_status
FROM line JOIN linked_events USING (id)""",
}

ORACLES["sales_line_ids"] = """
SELECT row_number() OVER (ORDER BY CAST(l_orderkey // 5000 AS VARCHAR), l_orderkey, l_linenumber) AS sales_line_id,
       CAST(l_orderkey AS VARCHAR) AS transaction_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey"""

ORACLES["report_records"] = f"""WITH {RAW_APPOINTMENTS}
SELECT strftime(o_orderdate, '%-m/%-d/%Y %-I:%M %p') AS date_and_time, booking_id || '.0' AS booking_id,
       CASE WHEN o_orderkey % 7 = 0 THEN client || chr(10) || 'Émile' ELSE client END AS client,
       CASE o_orderkey % 5 WHEN 0 THEN 'Hair,' || chr(10) || '"face" ' || o_orderkey
            WHEN 1 THEN 'a' || chr(10) || chr(10) || ',b"' || o_orderkey || '"' || chr(10) || ','
            WHEN 2 THEN '5" ' || o_orderkey WHEN 3 THEN '"' ELSE 'Hair' END AS main_category,
       service, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS service_value, status,
       CASE WHEN minutes >= 60 THEN (minutes // 60) || 'h:' || (minutes % 60) || 'min' ELSE minutes || 'min' END
       || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) || '",x"' ELSE '' END AS service_length,
       CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS total_revenue
FROM raw"""

ORACLES["rejected_cells"] = f"""WITH {RAW_APPOINTMENTS}
{finding("appointments", "warning", "rejected_cells", "count(*)", "'date_and_time'")} FROM raw WHERE o_orderkey % 9 = 0
UNION ALL {finding("appointments", "warning", "rejected_cells", "count(*)", "'service_value'")} FROM raw WHERE o_orderkey % 8 < 2
UNION ALL {finding("appointments", "warning", "rejected_cells", "count(*)", "'service_length'")} FROM raw WHERE o_orderkey % 7 = 0"""

ORACLES["clean_csv_round_trip"] = """
SELECT 'client_' || c_custkey AS client_key,
       CASE c_custkey % 6 WHEN 0 THEN 'say "' || c_custkey || '", ok'
            WHEN 1 THEN 'two' || chr(10) || ',"' || c_custkey || '"' || chr(10) || 'lines' || chr(10)
            WHEN 2 THEN '' WHEN 3 THEN '  ' || c_custkey || ' ' WHEN 4 THEN 'NA' END AS groups,
       CASE WHEN c_custkey % 10 = 1 THEN 9007199254740993 WHEN c_custkey % 10 NOT IN (0, 2, 4) THEN c_custkey END AS bookings_count,
       c_custkey % 3 AS no_shows_count,
       CASE WHEN c_custkey % 4 = 1 THEN TIMESTAMP '2026-02-03' WHEN c_custkey % 4 > 1 THEN TIMESTAMP '2026-02-03 04:05:06' END AS first_visit,
       NULL::TIMESTAMP AS last_visit, NULL::DOUBLE AS bookings_value, NULL::DOUBLE AS revenue_net, NULL::DOUBLE AS discount,
       CASE WHEN c_custkey % 5 <> 0 THEN CAST(0.25 AS DOUBLE) END AS tax, NULL::DOUBLE AS tip_amount, c_acctbal AS total_revenue
FROM customer"""

ORACLES["clean_csv_rejects"] = """
SELECT 'bookings_count' AS column, count(*) AS n_cells FROM customer WHERE c_custkey % 10 IN (0, 2)
UNION ALL SELECT 'first_visit', count(*) FROM customer WHERE c_custkey % 4 = 0
UNION ALL SELECT 'tax', count(*) FROM customer WHERE c_custkey % 5 = 0"""

ORACLES["gate_findings"] = " UNION ALL ".join(
    f"SELECT * FROM ({ORACLES[f'validation_{name}']}) WHERE kind = 'error' AND findings > 0" for name in ("clients", "appointments", "sales")
)

VIEW_SQL = {
    "analysis_appointments": "analysis_appointments", "visit_days": "visit_days", "client_completed_visits": "client_completed_visits",
    "monthly_performance": "monthly_performance", "monthly_active_clients": "active_clients", "client_retention": "client_retention",
    "client_cohorts": "client_cohorts", "client_visit_intervals": "visit_intervals", "repeat_cadence_summary": "repeat_cadence",
    "service_monthly": "service_monthly",
}
ORACLES["view_rows"] = " UNION ALL ".join(f"SELECT '{view}' AS name, count(*) AS n_rows FROM ({ORACLES[sql]})" for view, sql in VIEW_SQL.items())
ORACLES["view_join"] = f"""
SELECT p.month, booked_service_appointments, returning_clients, active_clients_42d, coalesce(n_visits, 0) AS n_visits
FROM ({ORACLES["monthly_performance"]}) p JOIN ({ORACLES["active_clients"]}) a ON a.month = p.month
LEFT JOIN (SELECT appointment_month, count(*) AS n_visits FROM ({ORACLES["client_completed_visits"]})
           WHERE observed_visit_number = 1 GROUP BY ALL) v ON appointment_month = p.month"""

GOLD = {
    "business_growth": ("monthly_performance", "month", (
        "booked_service_appointments", "completed_service_appointments", "cancelled_service_appointments", "no_show_service_appointments",
        "unique_completed_clients", "observed_new_clients", "returning_clients", "completion_rate", "cancellation_rate", "no_show_rate",
        "completed_service_minutes", "completed_service_value", "is_partial_month"), ("intervention_period",), 10),
    "active_clients": ("active_clients", "month", ("active_clients_42d", "active_clients_90d", "is_partial_month"), ("month_end", "intervention_period"), 2),
    "client_cohorts": ("client_cohorts", "cohort_month", (
        "acquired_clients", "clients_ever_repeated_observed", "observed_repeat_rate", "clients_eligible_42d", "clients_repeated_42d",
        "repeat_rate_42d", "clients_eligible_90d", "clients_repeated_90d", "repeat_rate_90d", "avg_days_to_second_visit", "is_partial_month"),
        ("intervention_period",), 2),
    "repeat_cadence": ("repeat_cadence", "cadence_band", ("return_intervals", "pct_of_return_intervals"), (), 1),
}
ORACLES["gold_export"] = " UNION ALL ".join(
    sql
    for dataset, (source, item, numbers, texts, defined) in GOLD.items()
    for sql in (
        *[f"SELECT '{dataset}' AS dataset, {item} AS item, '{f}' AS field, CAST({f} AS DOUBLE) AS number, NULL::VARCHAR AS text FROM ({ORACLES[source]})" for f in numbers],
        *[f"SELECT '{dataset}', {item}, '{f}', NULL, CAST({f} AS VARCHAR) FROM ({ORACLES[source]})" for f in texts],
        f"SELECT '{dataset}', NULL, 'definitions', {defined}::DOUBLE, NULL",
    )
)
