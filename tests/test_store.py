"""Publication under a numbered pointer, clean-up, and views that replace nothing."""

from __future__ import annotations

from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from revisit import schemas
from revisit.operators.ordering import number_lines
from revisit.plans import gold
from revisit.sources import records, store


def empty_tables(spark):
    return {name: spark.createDataFrame([], schema) for name, schema in schemas.STORED.items()}


def versions(root: str) -> set[str]:
    folder = Path(root, "versions")
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


def test_of_two_runs_from_one_version_one_publishes(spark, tmp_path):
    root = str(tmp_path)
    assert store.pointer(spark, root) == store.Pointer(0, None)
    seen = store.pointer(spark, root)
    assert store.publish(spark, root, "a", seen) == store.Pointer(1, "a")
    with pytest.raises(store.PublishConflict, match="b: number 1"):
        store.publish(spark, root, "b", seen)
    assert store.current_version(spark, root) == "a"
    store.publish(spark, root, "b", store.pointer(spark, root))
    assert store.pointer(spark, root) == store.Pointer(2, "b")
    assert [p.version for p in store.published(spark, root)] == ["a", "b"]


def test_a_pointer_whose_run_ended_while_writing_is_passed_over(spark, tmp_path):
    root = str(tmp_path)
    store.publish(spark, root, "a")
    (tmp_path / "published" / f"{2:012d}").write_text("")
    assert store.pointer(spark, root) == store.Pointer(2, "a")
    store.publish(spark, root, "c")
    assert store.pointer(spark, root) == store.Pointer(3, "c")


def test_the_loser_leaves_no_tables(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    first = store.load(empty_tables(spark), root)
    assert set(first) == set(schemas.STORED) and len(versions(root)) == 1
    check = store.check_load

    def overtaken(*args):
        store.publish(spark, root, "other")
        check(*args)

    monkeypatch.setattr(store, "check_load", overtaken)
    with pytest.raises(store.PublishConflict):
        store.load(empty_tables(spark), root)
    assert len(versions(root)) == 1 and store.current_version(spark, root) == "other"


def test_a_failed_load_leaves_no_version(spark, tmp_path):
    root = str(tmp_path)
    tables = empty_tables(spark)
    row = {f.name: None for f in schemas.CLIENTS} | {"client_key": "a", "bookings_count": -1, "no_shows_count": 0}
    tables["clients"] = spark.createDataFrame([tuple(row.values())], schemas.CLIENTS)
    with pytest.raises(store.LoadError):
        store.load(tables, root)
    assert versions(root) == set() and store.current_version(spark, root) is None


def test_discard_keeps_findings(spark, tmp_path):
    root = str(tmp_path)
    for name in ("clients", "findings"):
        spark.range(1).write.parquet(store.version_path(root, "v", name))
    store.discard(spark, root, "v")
    assert versions(root) == set() and spark.read.parquet(store.failed_path(root, "v", "findings")).count() == 1
    store.discard(spark, root, "v")


def test_vacuum(spark, tmp_path):
    root, names = str(tmp_path), []
    for i in range(4):
        names.append(store.new_version())
        spark.range(1).write.parquet(store.version_path(root, names[-1], "clients"))
        if i != 1:
            store.publish(spark, root, names[-1])
    # The second was never published; it may still be running.
    assert store.vacuum(spark, root, keep=2) == [names[0]] and versions(root) == set(names[1:])
    assert store.vacuum(spark, root, keep=1, unpublished_for=timedelta(0)) == [names[1], names[2]]
    assert versions(root) == {names[3]} and store.current_version(spark, root) == names[3]
    assert store.vacuum(spark, root, keep=0) == [] and store.vacuum(spark, str(tmp_path / "none")) == []


def test_views_do_not_replace_others(spark):
    tables = empty_tables(spark)
    spark.range(3).createOrReplaceTempView("p1_visit_days")
    with pytest.raises(gold.ViewExists, match="p1_visit_days"):
        gold.register_views(tables["appointments"], tables["clients"], prefix="p1_")
    assert spark.sql("SELECT count(*) AS n FROM p1_visit_days").first().n == 3
    assert not spark.catalog.tableExists("p1_monthly_performance")
    spark.catalog.dropTempView("p1_visit_days")
    for _ in range(2):  # its own views are replaced
        names = gold.register_views(tables["appointments"], tables["clients"], prefix="p1_")
    assert names == [f"p1_{v}" for v in gold.VIEWS]
    gold.require_views(spark, gold.VIEWS, prefix="p1_")
    for name in names:
        assert spark.sql(f"SELECT * FROM {name}").collect() is not None


def jobs(spark, run) -> int:
    """Jobs that run() starts."""
    group = f"count-{id(run)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_registering_views_runs_nothing(spark, tmp_path):
    tables = empty_tables(spark)
    for name in ("appointments", "clients"):
        tables[name].write.parquet(str(tmp_path / name))
        tables[name] = spark.read.schema(schemas.STORED[name]).parquet(str(tmp_path / name))
    assert jobs(spark, lambda: gold.register_views(tables["appointments"], tables["clients"], prefix="p2_")) == 0


def test_dense_line_numbers(spark, tmp_path):
    rows = [(f"f{f % 7}", f % 3, 10 * i + f) for f in range(40) for i in range(f % 5 + 1)]
    df = spark.createDataFrame(rows, "file string, block int, line int").repartition(5)
    out = number_lines(df, "file", "block", "line", "n", lambda t: records.written(t, "files", str(tmp_path)))
    assert [tuple(r)[:3] for r in out.orderBy("n").collect()] == sorted(rows)
    assert sorted(r.n for r in out.select("n").collect()) == list(range(1, len(rows) + 1))
    none = number_lines(df.where(F.lit(False)), "file", "block", "line", "n", lambda t: records.written(t, "files", str(tmp_path)))
    assert none.columns == ["file", "block", "line", "n"] and none.isEmpty()
