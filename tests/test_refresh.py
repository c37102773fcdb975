"""The whole refresh on reports derived from the given tables, and its failure paths."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from revisit.plans.gold import GOLD_VIEWS, register_views, require_views
from revisit.plans.refresh import GateError, RefreshConfig, refresh
from revisit.schemas import data_dictionary, gold_schemas
from revisit.sources import files, reports, store
from workload import dumps
from workload.inputs import SETTINGS


@pytest.fixture(scope="module")
def report_paths(spark, sf_dir):
    return {
        "clients": dumps.client_dump(spark, sf_dir),
        "appointments": dumps.appointment_dump(spark, sf_dir),
        "sales": dumps.sales_dump(spark, sf_dir),
    }


@pytest.fixture(scope="module")
def run(spark, report_paths, tmp_path_factory):
    # Report names repeat on purpose, and a client and first visit may then repeat too;
    # the refresh is run on data where they do not (checked by the gate itself).
    root = str(tmp_path_factory.mktemp("store"))
    config = RefreshConfig(root=root, settings=SETTINGS, write_csv=True, **report_paths)
    return root, refresh(spark, config)


def test_publishes_a_version_with_all_tables(spark, run):
    root, result = run
    assert store.current_version(spark, root) == result.version
    counts = {t: store.read_table(spark, root, t).count() for t in ("clients", "appointments", "sales")}
    assert counts == {"clients": 150, "appointments": 1500, "sales": 6000}
    sales = store.read_table(spark, root, "sales")
    assert sales.select("sales_line_id").distinct().count() == 6000


def test_no_name_reaches_the_store(spark, run):
    root, _ = run
    for table in ("clients", "appointments", "sales"):
        assert not {"client", "client_name", "client_name_casefold"} & set(store.read_table(spark, root, table).columns)


def test_gold_has_the_published_shape_and_invariants(spark, run):
    root, result = run
    for name, schema in gold_schemas(SETTINGS).items():
        stored = store.read_table(spark, root, f"gold/{name}", result.version)
        assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in schema]
        assert result.row_counts[name] == stored.count()
    growth = result.gold["business_growth"].collect()
    for r in growth:
        parts = (r.completed_service_appointments, r.cancelled_service_appointments, r.no_show_service_appointments)
        assert sum(parts) == r.booked_service_appointments
        for part, rate in zip(parts, (r.completion_rate, r.cancellation_rate, r.no_show_rate)):
            assert abs(rate - part / r.booked_service_appointments) <= 0.00005000001
        assert r.unique_completed_clients <= r.observed_new_clients + r.returning_clients
    for r in result.gold["active_clients"].collect():
        assert r.active_clients_42d <= r.active_clients_90d
    cadence = result.gold["repeat_cadence"].collect()
    total = sum(r.return_intervals for r in cadence)
    for r in cadence:
        assert abs(r.pct_of_return_intervals - 100 * r.return_intervals / total) <= 0.0500001
    acquired = {r.cohort_month: r.acquired_clients for r in result.gold["client_cohorts"].collect()}
    # No client is known from before the reporting start here, so new equals acquired.
    assert acquired == {r.month: r.observed_new_clients for r in growth if r.observed_new_clients}


def test_exports_can_be_read_back(spark, run):
    root, result = run
    for name in gold_schemas(SETTINGS):
        path = store.version_path(root, result.version, f"export/{name}")
        back = files.read_gold_csv(spark, path, name, SETTINGS)
        columns = result.gold[name].columns
        assert back.select(columns).collect() == result.gold[name].orderBy(columns[0]).collect()
    listed = spark.read.csv(store.version_path(root, result.version, "export/data_dictionary"), header=True)
    assert sorted(map(tuple, listed.collect())) == sorted(data_dictionary(SETTINGS))
    assert len(data_dictionary(SETTINGS)) == 15


def test_clean_csv_round_trip(spark, run):
    root, result = run
    for name in ("clients", "appointments", "sales"):
        stored = store.read_table(spark, root, name).drop("sales_line_id")
        back = files.read_clean_csv(spark, store.version_path(root, result.version, f"csv/{name}_clean"), name)
        assert back.schema == stored.schema
        assert back.exceptAll(stored).isEmpty() and stored.exceptAll(back).isEmpty()


def test_report_lists_sources_counts_and_findings(spark, run):
    root, result = run
    text = spark.read.text(store.version_path(root, result.version, "validation_report")).first()[0]
    report = json.loads(text)
    assert report == result.report
    appointments = report["datasets"]["appointments"]
    assert appointments["rows"] == 1500
    assert sum(appointments["metrics"]["client_match_counts"].values()) == 1500
    assert appointments["errors"] == []
    assert any(w.startswith("ambiguous_clients") for w in appointments["warnings"])
    assert appointments["sources"][0]["report_period_start"]


def test_dashboard_tables_are_written(spark, run):
    root, result = run
    latest = store.read_table(spark, root, "dashboard/headline_latest").collect()
    assert len(latest) == 1
    assert latest[0].month == max(r.month for r in result.gold["business_growth"].collect())


def test_views_answer_sql(spark, run):
    root, _ = run
    names = register_views(store.read_table(spark, root, "appointments"), store.read_table(spark, root, "clients"), SETTINGS)
    assert set(GOLD_VIEWS) <= set(names) and len(names) == 10
    require_views(spark)
    rows = spark.sql("SELECT sum(booked_service_appointments) AS n FROM monthly_performance").first().n
    assert rows == spark.sql("SELECT count(*) AS n FROM analysis_appointments").first().n
    spark.catalog.dropTempView("client_cohorts")
    with pytest.raises(RuntimeError, match="client_cohorts"):
        require_views(spark)


def test_missing_sources_are_all_named(spark, tmp_path):
    config = RefreshConfig(clients=f"{tmp_path}/a", appointments=f"{tmp_path}/b", sales=f"{tmp_path}/c", root=str(tmp_path))
    with pytest.raises(reports.MissingSources) as error:
        refresh(spark, config)
    assert error.value.paths == [f"{tmp_path}/a", f"{tmp_path}/b", f"{tmp_path}/c"]


def test_gate_keeps_the_published_version(spark, report_paths, run, tmp_path):
    """Every appointment twice: shared booking ids close the gate, the report is still written."""
    root, before = run
    doubled = str(tmp_path / "doubled")
    for copy in ("a", "b"):
        spark.read.text(report_paths["appointments"] + "/file_id=0").coalesce(1).write.text(f"{doubled}/copy={copy}")
    spark.createDataFrame([("x",)] * 3, "value string").coalesce(1).write.text(f"{doubled}/copy=short")
    config = RefreshConfig(
        clients=report_paths["clients"], appointments=doubled, sales=report_paths["sales"], root=root, settings=SETTINGS
    )
    with pytest.raises(GateError) as error:
        refresh(spark, config)
    assert any("rows_sharing_booking_id" in p for p in error.value.problems)
    assert any("file_without_header" in p for p in error.value.problems)
    assert error.value.report["datasets"]["appointments"]["errors"]
    assert store.current_version(spark, root) == before.version


def test_gate_error_names_all_findings():
    error = GateError(["sales: late = 1", "6 more findings"], {}, "/store/v1/findings")
    assert str(error) == "sales: late = 1; 6 more findings; all findings: /store/v1/findings"


def test_load_checks_stop_the_publication(spark, run, tmp_path):
    published, result = run
    root = str(tmp_path / "other")
    tables = {t: store.read_table(spark, published, t) for t in ("clients", "appointments", "sales")}
    tables["appointments"] = tables["appointments"].withColumn("status", F.lit("Lost"))
    with pytest.raises(store.LoadError, match="status_allowed"):
        store.load(tables, root)
    assert store.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        store.read_table(spark, root, "clients")
    with pytest.raises(store.ContractError, match="service"):
        store.load({**tables, "appointments": tables["appointments"].drop("service")}, root)


def test_scratch_with_names_is_gone(spark, run):
    """After the good run and the failed ones above."""
    from pathlib import Path

    from revisit.session import shared_dir

    assert not list(Path(shared_dir(spark).removeprefix("file:"), "revisit-raw").glob("*"))


def test_load_error_names_the_keys(spark, run, tmp_path):
    published, _ = run
    tables = {t: store.read_table(spark, published, t) for t in ("clients", "appointments", "sales")}
    tables["clients"] = tables["clients"].limit(0)
    first = sorted(r[0] for r in tables["appointments"].select("client_key").distinct().dropna().collect())[0]
    with pytest.raises(store.LoadError, match=f"first keys: {first}"):
        store.load(tables, str(tmp_path / "other"))
