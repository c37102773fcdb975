"""The shape of the physical plans."""

from __future__ import annotations

import pytest

from workload.queries import REGISTRY

ALL = sorted(REGISTRY)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ALL)
def test_no_cross_join_no_python(spark, sf_dir, name):
    plan = plan_of(REGISTRY[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    from revisit.operators import monthly, visits
    from revisit.schemas import APPOINTMENTS

    path = f"{spark.conf.get('spark.checkpoint.dir')}/plan-appointments"
    spark.createDataFrame([], APPOINTMENTS).write.mode("overwrite").parquet(path)
    base = visits.analysis_appointments(spark.read.parquet(path))
    plan = plan_of(visits.visit_days(base))
    assert "IsNotNull(client_key)" in plan and "EqualTo(status,Completed)" in plan
    assert "ReadSchema: struct<appointment_datetime:timestamp_ntz,service:string,status:string,client_key:string>" in plan
    volume = plan_of(monthly.monthly_volume(base))
    assert "client_key" not in volume.split("ReadSchema")[1]


def test_rows_are_shuffled_once_for_numbering(spark, sf_dir):
    """Row-level exchanges of the visit sequence: one by (client, hour); the rest are aggregates."""
    plan = plan_of(REGISTRY["client_completed_visits"](spark, sf_dir))
    row_level = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_slot" in line]
    assert row_level and all("client_key" in line for line in row_level)


def test_client_windows_run_on_aggregates(spark, sf_dir):
    """No window over a client alone reads raw appointments."""
    for name in ("client_retention", "active_clients", "visit_intervals", "monthly_performance"):
        lines = plan_of(REGISTRY[name](spark, sf_dir)).splitlines()
        windows = [i for i, line in enumerate(lines) if "Window [" in line]
        for i in windows:
            assert any("HashAggregate" in line for line in lines[i:])


def executed(df) -> str:
    """The plan that ran, with what was replaced while it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize(("name", "scans"), [("validation_clients", 1), ("validation_sales", 1), ("validation_appointments", 1)])
def test_a_dataset_is_validated_in_one_scan(spark, sf_dir, name, scans, tmp_path):
    from revisit.operators import quality
    from revisit.schemas import STORED

    dataset = name.removeprefix("validation_")
    schema = STORED[dataset]
    spark.createDataFrame([(None,) * len(schema)], schema).write.parquet(str(tmp_path / dataset))
    df = spark.read.parquet(str(tmp_path / dataset))
    plan = executed(getattr(quality, f"validate_{dataset}")(df))
    assert plan.count("FileScan parquet") == scans


def test_the_load_summary_scans_each_table_once(spark, tmp_path):
    from revisit.operators import quality
    from revisit.schemas import STORED

    tables = {}
    for name, schema in STORED.items():
        spark.createDataFrame([(None,) * len(schema)], schema).write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    assert executed(quality.load_summary(tables)).count("FileScan parquet") == 3


def test_without_hot_clients_numbering_only_counts_them(spark, sf_dir):
    """At run time, cuts and starts of hot clients vanish: what is left is the rows, and one count of them."""
    from revisit.operators import visits
    from workload import inputs

    base = visits.analysis_appointments(inputs.appointments(spark, sf_dir), inputs.SETTINGS)
    plan = executed(visits.client_completed_visits(base, inputs.clients(spark, sf_dir), inputs.SETTINGS))
    assert plan.count("Window [") <= 2 and "RangePartitioning" not in plan
