from __future__ import annotations

from pathlib import Path

from revisit.session import shared_dir
from workload import dumps
from workload.queries import REGISTRY


def _scratch(spark) -> dict[str, set[str]]:
    root = Path(shared_dir(spark).removeprefix("file:"))
    return {folder: {p.name for p in (root / folder).glob("sales-*")} for folder in ("reports", "staged", "landed")}


def test_only_landed_rows_of_sales_stay_in_scratch(spark, sf_dir):
    for name in ("clean_sales", "sales_line_ids"):
        before = _scratch(spark)
        rows = REGISTRY[name](spark, sf_dir)
        after = _scratch(spark)
        assert after["reports"] == before["reports"] and after["staged"] == before["staged"]
        assert len(after["landed"] - before["landed"]) == 1
        n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
        assert rows.count() == n == rows.count()


def test_a_dumps_rows_stand_in_order_between_preamble_and_total(spark):
    rows = spark.createDataFrame(
        [(f, s, f"c{s}", f"2026-0{1 + s % 3}-0{1 + f}") for f in range(3) for s in (7, 3, 3, 12)], "file_id long, seq long, cell string, day string"
    )
    path = dumps._dump(spark, "some", rows, ("Cell",), "day")
    for f in range(3):
        lines = [r["value"] for r in spark.read.text(f"{path}/file_id={f}").collect()]
        body = [f'"",{s},c{s}' for s in (3, 3, 7, 12)]
        period = f'"Period from 1/{1 + f}/26 to 2/{1 + f}/26"'
        assert lines == [",,,", "Salon report,,,", period, *[",,,"] * 4, ",,Cell", *body, ",, Total ,4"]
