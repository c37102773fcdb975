"""CSV exchange: what other tools write and read."""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import functions as F

from revisit import schemas
from revisit.sources import files
from revisit.sources.store import apply_contract

HARD = ["plain", 'say "hi", ok', "  padded  ", "back\\slash", "two\nlines", 'end"', "a,b", "\\\"", "é"]


def test_texts_come_back(spark, tmp_path):
    names = [f.name for f in schemas.STORED["appointments"]]
    rows = spark.createDataFrame([(str(i), x) for i, x in enumerate(HARD)], "booking_id string, service string")
    rows = apply_contract(rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schemas.STORED["appointments"] if f.name not in rows.columns}), "appointments")
    files.write_clean_csv(rows, str(tmp_path / "c"))
    back = files.read_clean_csv(spark, str(tmp_path / "c"), "appointments")
    assert back.columns == names
    assert {r.booking_id: r.service for r in back.collect()} == {str(i): x for i, x in enumerate(HARD)}
    read = [r for p in Path(tmp_path / "c").glob("part-*") for r in csv.DictReader(p.open(newline="", encoding="utf-8"))]
    assert {r["booking_id"]: r["service"] for r in read} == {str(i): x for i, x in enumerate(HARD)}


def test_texts_of_other_writers(spark, tmp_path):
    with (tmp_path / "x.csv").open("w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        others = [f.name for f in schemas.STORED["appointments"] if f.name not in ("service", "booking_id")]
        writer.writerow(["service", "booking_id", *others])
        writer.writerows([(x, str(i), *([""] * len(others))) for i, x in enumerate(HARD)])
    back = files.read_clean_csv(spark, str(tmp_path / "x.csv"), "appointments")
    assert {r.booking_id: r.service for r in back.collect()} == {str(i): x for i, x in enumerate(HARD)}


def contract_rows(spark, rows, columns):
    """Rows of the appointments' contract from some of its columns."""
    given = spark.createDataFrame(rows, columns)
    others = {f.name: F.lit(None).cast(f.dataType) for f in schemas.STORED["appointments"] if f.name not in given.columns}
    return apply_contract(given.withColumns(others), "appointments")


def test_null_and_empty_texts_differ(spark, tmp_path):
    rows = [("1", None), ("2", ""), ("3", " "), ("4", '"'), ("5", "total"), ("6", "two\n\nlines\r\nof, it"), (None, None), ("", "x")]
    files.write_clean_csv(contract_rows(spark, rows, "booking_id string, service string").repartition(3), str(tmp_path / "c"))
    back = files.scan_clean_csv(spark, str(tmp_path / "c"), "appointments")
    want = [(i, s if s is None else s.replace("\r\n", "\n")) for i, s in rows]
    assert sorted((tuple(r) for r in back.rows.select("booking_id", "service").collect()), key=repr) == sorted(want, key=repr)
    assert {r.column: r.n_cells for r in back.rejects.collect() if r.n_cells} == {}


def test_bad_cells_are_counted_and_whole_numbers_kept(spark, tmp_path):
    """One bad cell costs that cell; records with another number of cells are read as far as they go."""
    names = [f.name for f in schemas.STORED["clients"]]
    cells = {n: "" for n in names}
    rows = [
        {"client_key": "a", "bookings_count": "9007199254740993", "first_visit": "2026-03-01 10:00:00", "tax": "1.5"},
        {"client_key": "b", "bookings_count": "abc", "first_visit": "2026-13-01 10:00:00", "tax": "1,5"},
        {"client_key": "c", "bookings_count": "3.0", "first_visit": "2026-03-01", "tax": "NaN"},
        {"client_key": "d", "bookings_count": "3.5", "no_shows_count": "99999999999999999999", "tax": "1e3"},
    ]
    with (tmp_path / "x.csv").open("w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(["extra", *reversed(names)])
        writer.writerows(["z", *[{**cells, **r}[n] for n in reversed(names)]] for r in rows)
        out.write("short,1.0\r\n\r\n" + ",".join(["q"] * 14) + "\r\n")
    found = files.scan_clean_csv(spark, str(tmp_path / "x.csv"), "clients")
    got = {r.client_key: r for r in found.rows.collect()}
    assert found.rows.count() == 6
    assert [got[k].bookings_count for k in "abcd"] == [9007199254740993, None, 3, None]
    assert [str(got[k].first_visit) for k in "abcd"] == ["2026-03-01 10:00:00", "None", "2026-03-01 00:00:00", "None"]
    assert [got[k].tax for k in "abcd"] == [1.5, None, None, 1000.0]
    rejects = {r.column: r.n_cells for r in found.rejects.collect() if r.n_cells}
    # The last record is all "q": each column of numbers or times loses one cell.
    assert rejects[None] == 2 and rejects["bookings_count"] == 3 and rejects["first_visit"] == 2 and rejects["no_shows_count"] == 2
    assert rejects["tax"] == 2 and set(rejects) - {None} <= set(names) - {"client_key", "groups"}


def test_files_with_cells_over_splits_stay_splittable(spark, tmp_path):
    rows = [(str(i), "a\n" * (i % 7) + f'say "{i}", {i}') for i in range(300)]
    files.write_clean_csv(contract_rows(spark, rows, "booking_id string, service string").coalesce(1), str(tmp_path / "c"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1499")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(str(tmp_path / "c")).rdd.getNumPartitions() > 5
        back = files.read_clean_csv(spark, str(tmp_path / "c"), "appointments")
        assert {r.booking_id: r.service for r in back.collect()} == dict(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_missing_contract_columns(spark, tmp_path):
    import pytest

    from revisit.sources.store import ContractError

    (tmp_path / "x.csv").write_text("client_key,groups\na,b\n")
    with pytest.raises(ContractError):
        files.read_clean_csv(spark, str(tmp_path / "x.csv"), "clients")
