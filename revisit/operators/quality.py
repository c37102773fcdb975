"""Data-quality checks as rows.

Every check is one row (dataset, kind, name, findings, detail). `kind` is `rows`,
`error`, `warning` or `metric`; an error or warning with 0 findings has passed. Each
dataset is scanned once: `profile` groups its rows by all identifiers and histograms at
the same time, and every check follows from those groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisit.config import MATCH_STATUSES, Settings
from revisit.functions.calendar import iso_text

REQUIRED_COLUMNS = {
    "clients": ("client_key", "first_visit", "last_visit"),
    "appointments": ("appointment_datetime", "booking_id", "service", "status", "client_match_status"),
    "sales": ("checkout_date", "transaction_id", "type", "client_match_status"),
}

ALL = "rows"  # the group of all rows

Check = tuple[str, str, Column | None, Column | None]


def _count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def profile(df: DataFrame, keys: list[str], histograms: list[str], measures: dict[str, tuple[Column, str]]) -> DataFrame:
    """One scan of `df`: a row for all rows, one for each key column, and one for each value of a histogram.

    Columns: what (ALL or the column), value (of a histogram), n_rows, distinct_keys, missing_rows, duplicate_rows
    (rows that share a key; nulls share), and the measures, (value of a row, `sum`, `min` or `max`), of all rows.

    A row goes to one group of each kind, and groups combine before the shuffle; only measures of all rows go
    along. Then the groups of a key column, or of all rows, are summed. Without rows, there is still a row for all
    rows and for each key.
    """
    kinds = [ALL, *keys, *histograms]
    text = [F.lit(None).cast("string"), *[F.col(c).cast("string") for c in (*keys, *histograms)]]
    items = [F.struct(F.lit(kind).alias("what"), value.alias("value")) for kind, value in zip(kinds, text)]
    each = df.select(*[m.alias(f"m_{name}") for name, (m, _) in measures.items()], F.explode(F.array(*items)).alias("g"))
    of_all = {name: F.when(F.col("g.what") == ALL, F.col(f"m_{name}")) for name in measures}
    how = {"sum": F.sum, "min": F.min, "max": F.max}
    groups = each.groupBy(F.col("g.what").alias("what"), F.col("g.value").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), *[how[kind](of_all[name]).alias(name) for name, (_, kind) in measures.items()]
    )
    none = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(k) for k in (ALL, *keys)])).alias("what"), F.lit(0).cast("long").alias("n"))
    groups = groups.withColumn("is_key", F.col("what").isin(*keys) if keys else F.lit(False))
    groups = groups.unionByName(none.withColumn("is_key", F.lit(False)), allowMissingColumns=True)
    is_value = F.col("what").isin(*histograms) if histograms else F.lit(False)
    n, is_key = F.col("n"), F.col("is_key")
    return groups.groupBy("what", F.when(is_value, F.col("value")).alias("value")).agg(
        F.sum("n").alias("n_rows"),
        F.count(F.when(is_key, F.col("value"))).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(is_key & F.col("value").isNull(), n)), F.lit(0)).alias("missing_rows"),
        F.coalesce(F.sum(F.when(is_key & (n > 1), n)), F.lit(0)).alias("duplicate_rows"),
        *[how[kind](name).alias(name) for name, (_, kind) in measures.items()],
    )


def _findings(dataset: str, profiled: DataFrame, checks: dict[str, list[Check]]) -> DataFrame:
    """Turn the rows of a profile into one row per check. checks: by kind of row."""
    item = lambda kind, name, findings, detail: F.struct(
        F.lit(kind).alias("kind"),
        F.lit(name).alias("name"),
        (F.lit(None) if findings is None else findings).cast("long").alias("findings"),
        (F.lit(None) if detail is None else detail).cast("string").alias("detail"),
    )
    items = F.when(F.lit(False), F.array(item("", "", None, None)))
    for what, some in checks.items():
        if some:
            items = items.when(F.col("what") == what, F.array(*[item(*check) for check in some]))
    return profiled.select(F.lit(dataset).alias("dataset"), F.inline(items))


def _missing_columns(df: DataFrame, dataset: str) -> Check:
    """Required columns that the frame does not have; known without reading data."""
    missing = sorted(set(REQUIRED_COLUMNS[dataset]) - set(df.columns))
    return ("error", "missing_columns", F.lit(len(missing)), F.lit(", ".join(missing) or None))


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys, rows without key, rows sharing a key (nulls share), surplus rows.

    Counts per key combine before the shuffle, so a hot key is one row per task.
    """
    n = F.col("n")
    has_key = F.col(key).isNotNull()
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(key).alias("distinct_keys"),
            F.coalesce(F.sum(F.when(~has_key, n)), F.lit(0)).alias("missing_rows"),
            F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("duplicate_rows"),
            (F.coalesce(F.sum("n"), F.lit(0)) - F.count(key)).alias("excess_rows"),
        )
    )


def duplicate_rows(df: DataFrame, *key: str) -> DataFrame:
    """Keys held by several rows, with the number of rows; null keys equal each other."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, null included, most frequent first."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.orderBy(F.desc("n_rows"), F.asc_nulls_last(column))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _times(column: str, first: str, last: str) -> tuple[dict[str, tuple[Column, str]], list[Check]]:
    """Measures and checks of a column of times: how many are missing, the first and the last."""
    moment = F.col(column)
    measures = {"n_no_time": (moment.isNull().cast("long"), "sum"), "time_min": (moment, "min"), "time_max": (moment, "max")}
    checks = [
        ("error", f"invalid_{column}", F.coalesce("n_no_time", F.lit(0)), None),
        ("metric", first, None, iso_text(F.col("time_min"))),
        ("metric", last, None, iso_text(F.col("time_max"))),
    ]
    return measures, checks


def _status_is(status: str) -> tuple[Column, str]:
    return (F.coalesce(F.col("client_match_status") == status, F.lit(False)).cast("long"), "sum")


def _counted(name: str) -> Column:
    return F.coalesce(name, F.lit(0))


def validate_clients(df: DataFrame) -> DataFrame:
    present = set(df.columns)
    measures: dict[str, tuple[Column, str]] = {}
    checks: list[Check] = [("rows", "rows", F.col("n_rows"), None), _missing_columns(df, "clients")]
    if {"first_visit", "last_visit"} <= present:
        reversed_ = F.coalesce(F.col("first_visit") > F.col("last_visit"), F.lit(False))
        measures["n_reversed"] = (reversed_.cast("long"), "sum")
        checks.append(("error", "first_visit_after_last_visit", _counted("n_reversed"), None))
    if "first_visit" in present:
        measures["first_min"] = (F.col("first_visit"), "min")
        checks.append(("metric", "first_visit_min", None, iso_text(F.col("first_min"))))
    if "last_visit" in present:
        measures["last_max"] = (F.col("last_visit"), "max")
        checks.append(("metric", "last_visit_max", None, iso_text(F.col("last_max"))))
    of_keys = {
        "client_key": [
            ("error", "rows_without_client_key", F.col("missing_rows"), None),
            ("error", "rows_sharing_client_key", F.col("duplicate_rows"), None),
            ("metric", "unique_client_keys", F.col("distinct_keys"), None),
        ]
    }
    keys = [k for k in of_keys if k in present]
    return _findings("clients", profile(df, keys, [], measures), {ALL: checks, **{k: of_keys[k] for k in keys}})


def validate_appointments(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    present = set(df.columns)
    measures: dict[str, tuple[Column, str]] = {}
    checks: list[Check] = [("rows", "rows", F.col("n_rows"), None), _missing_columns(df, "appointments")]
    if "appointment_datetime" in present:
        of_time, found = _times("appointment_datetime", "date_min", "date_max")
        measures |= of_time
        checks += found
    if "client_match_status" in present:
        measures["n_ambiguous"] = _status_is("ambiguous")
        checks.append(("warning", "ambiguous_clients", _counted("n_ambiguous"), None))
    of_keys = {
        "booking_id": [
            ("error", "missing_booking_id", F.col("missing_rows"), None),
            ("error", "rows_sharing_booking_id", F.col("duplicate_rows"), None),
            ("metric", "unique_booking_ids", F.col("distinct_keys"), None),
        ],
        "client_key": [("metric", "linked_clients", F.col("distinct_keys"), None)],
    }
    of_values = {
        "status": [("metric", "status_counts", F.col("n_rows"), F.col("value"))],
        "client_match_status": [("metric", "client_match_counts", F.col("n_rows"), F.col("value"))],
    }
    keys, values = ([k for k in of if k in present] for of in (of_keys, of_values))
    profiled = profile(df, keys, values, measures)
    found = _findings("appointments", profiled, {ALL: checks, **{k: of_keys[k] for k in keys}, **{v: of_values[v] for v in values}})
    if "status" not in present:
        return found
    # A status that is not allowed is a warning as well.
    status = (F.col("name") == "status_counts") & F.col("detail").isNotNull() & ~F.col("detail").isin(*settings.statuses)
    both = F.when(status, F.array(F.struct("kind", "name"), F.struct(F.lit("warning").alias("kind"), F.lit("unexpected_status").alias("name"))))
    both = F.explode(both.otherwise(F.array(F.struct("kind", "name")))).alias("as")
    return found.select("dataset", both, "findings", "detail").select("dataset", "as.kind", "as.name", "findings", "detail")


def validate_sales(df: DataFrame) -> DataFrame:
    present = set(df.columns)
    measures: dict[str, tuple[Column, str]] = {}
    checks: list[Check] = [("rows", "rows", F.col("n_rows"), None), _missing_columns(df, "sales")]
    if "checkout_date" in present:
        of_time, found = _times("checkout_date", "date_min", "date_max")
        measures |= of_time
        checks += found
    if "client_match_status" in present:
        for status in ("ambiguous", "unmatched"):
            measures[f"n_{status}"] = _status_is(status)
            checks.append(("warning", f"{status}_clients", _counted(f"n_{status}"), None))
    of_keys = {
        "transaction_id": [
            ("error", "missing_transaction_id", F.col("missing_rows"), None),
            ("metric", "unique_transactions", F.col("distinct_keys"), None),
        ],
        "client_key": [("metric", "linked_clients", F.col("distinct_keys"), None)],
    }
    of_values = {"client_match_status": [("metric", "client_match_counts", F.col("n_rows"), F.col("value"))]}
    keys, values = ([k for k in of if k in present] for of in (of_keys, of_values))
    return _findings("sales", profile(df, keys, values, measures), {ALL: checks, **{k: of_keys[k] for k in keys}, **{v: of_values[v] for v in values}})


def failed(findings: DataFrame) -> DataFrame:
    """The errors that close the gate."""
    return findings.where((F.col("kind") == "error") & (F.col("findings") > 0))


# ----------------------------------------------------------------- load checks


def constraint_violations(tables: dict[str, DataFrame], settings: Settings = Settings()) -> DataFrame:
    """Rows that break a column rule of the store, per table and rule; 0 means the rule holds."""
    a_status = F.col("status")
    match = F.col("client_match_status")
    minutes = F.col("service_length_minutes")

    def not_in(column: Column, allowed: tuple[str, ...]) -> Column:
        return column.isNull() | ~column.isin(*allowed)

    rules: dict[str, list[tuple[str, Column]]] = {
        "clients": [
            ("bookings_count_not_negative", F.col("bookings_count").isNull() | (F.col("bookings_count") < 0)),
            ("no_shows_count_not_negative", F.col("no_shows_count").isNull() | (F.col("no_shows_count") < 0)),
        ],
        "appointments": [
            ("appointment_datetime_present", F.col("appointment_datetime").isNull()),
            ("service_present", F.col("service").isNull()),
            ("status_allowed", not_in(a_status, settings.statuses)),
            ("service_length_positive", minutes <= 0),
            ("match_status_allowed", not_in(match, MATCH_STATUSES)),
        ],
        "sales": [
            ("checkout_date_present", F.col("checkout_date").isNull()),
            ("transaction_id_present", F.col("transaction_id").isNull()),
            ("match_status_allowed", not_in(match, MATCH_STATUSES)),
        ],
    }
    frames = []
    for table, checks in rules.items():
        if table not in tables:
            continue
        summary = tables[table].agg(*[_count_if(broken).alias(rule) for rule, broken in checks])
        items = [F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("violations")) for rule, _ in checks]
        frames.append(summary.select(F.lit(table).alias("table_name"), F.inline(F.array(*items))))
    return _union(frames)


def foreign_key_violations(children: DataFrame, clients: DataFrame) -> DataFrame:
    """Client keys used by child rows but absent in `clients`, with the number of child rows.

    Child rows shrink to one per key first, so the anti join never sees a hot key.
    """
    return (
        children.where(F.col("client_key").isNotNull())
        .groupBy("client_key")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .join(clients.select("client_key"), "client_key", "left_anti")
    )


def row_reconciliation(expected: dict[str, DataFrame | int], actual: dict[str, DataFrame]) -> DataFrame:
    """Rows handed over (a frame or a known number) and rows stored, per table."""
    frames = []
    for table, stored in actual.items():
        handed = expected[table]
        if isinstance(handed, DataFrame):
            handed = handed.agg(F.count(F.lit(1))).scalar()
        else:
            handed = F.lit(handed).cast("long")
        frames.append(
            stored.agg(F.count(F.lit(1)).alias("actual_rows")).select(
                F.lit(table).alias("table_name"), handed.alias("expected_rows"), "actual_rows"
            )
        )
    return _union(frames).withColumn("difference", F.col("actual_rows") - F.col("expected_rows"))


def load_checks(
    tables: dict[str, DataFrame], expected: dict[str, DataFrame | int], settings: Settings = Settings()
) -> DataFrame:
    """All checks on staged tables as (table_name, rule, violations)."""
    frames = [constraint_violations(tables, settings)]
    for table, key in (("clients", "client_key"), ("appointments", "booking_id")):
        frames.append(
            key_profile(tables[table], key).select(
                F.lit(table).alias("table_name"),
                F.lit(f"{key}_unique").alias("rule"),
                F.col("excess_rows").alias("violations"),
            )
        )
    for table in ("appointments", "sales"):
        orphans = foreign_key_violations(tables[table], tables["clients"])
        frames.append(
            orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("violations")).select(
                F.lit(table).alias("table_name"), F.lit("client_key_known").alias("rule"), "violations"
            )
        )
    frames.append(
        row_reconciliation(expected, tables).select(
            "table_name", F.lit("row_count").alias("rule"), F.abs("difference").alias("violations")
        )
    )
    return _union(frames)


def load_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, distinct transactions and the status histogram; each table is scanned once."""
    rows = lambda table: ("rows", table, F.col("n_rows"))
    wanted = {
        "appointments": ([], ["status"], {"status": ("status", F.col("value"), F.col("n_rows"))}),
        "sales": (["transaction_id"], [], {"transaction_id": ("transactions", "sales", F.col("distinct_keys"))}),
    }
    frames = []
    for table, df in tables.items():
        keys, values, of = wanted.get(table, ([], [], {}))
        shown = F.when(F.lit(False), _named("", F.lit(""), F.lit(0)))
        for what, (name, item, n) in {ALL: rows(table), **of}.items():
            shown = shown.when(F.col("what") == what, _named(name, F.lit(item) if isinstance(item, str) else item, n))
        frames.append(profile(df, keys, values, {}).select(shown.alias("s")).select("s.name", "s.item", "s.n_rows"))
    return _union(frames)


def _named(name: str, item: Column, n: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), item.alias("item"), n.cast("long").alias("n_rows"))


def findings_text(findings: DataFrame, limit: int = 100) -> list[str]:
    """Readable lines for a bounded number of findings; a last one says how many more there are."""
    shown = findings.orderBy("dataset", "name", F.desc("findings")).limit(limit).collect()
    lines = [
        f"{r.dataset}: {r.name} = {r.findings}" + (f" ({r.detail})" if r.detail is not None else "")
        for r in shown
    ]
    more = findings.count() - limit if len(shown) == limit else 0
    return lines + [f"{more} more findings"] if more > 0 else lines
