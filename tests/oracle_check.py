"""Compare the registered queries with their SQL oracles; also a command line tool."""

from __future__ import annotations

import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    def cell(value):
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value) or value is pd.NA:
            return "∅"
        if isinstance(value, float):
            return repr(value)
        if hasattr(value, "isoformat"):
            return pd.Timestamp(value).isoformat()
        return str(value)

    df = df[sorted(df.columns)]
    return sorted(tuple(cell(v) for v in row) for row in df.astype(object).itertuples(index=False, name=None))


def compare(spark_df, relation) -> str | None:
    """None when equal, else what differs."""
    mine = pd.DataFrame([r.asDict() for r in spark_df.collect()], columns=spark_df.columns, dtype=object)
    theirs = pd.DataFrame(relation.fetchall(), columns=[d[0] for d in relation.description], dtype=object)
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}"
    a, b = canonical(mine), canonical(theirs)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    extra, lacking = Counter(a) - Counter(b), Counter(b) - Counter(a)
    if extra or lacking:
        return f"{sum(extra.values())} of {len(a)} rows differ: {sorted(extra)[:2]} instead of {sorted(lacking)[:2]}"
    return None


def main() -> None:
    from revisit.session import build_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(queries())
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            planned = time.time()
            df._jdf.queryExecution().executedPlan()
            planned, built = time.time() - planned, planned - start
            if name in oracle_sql():
                relation = con.execute(oracle_sql()[name])
                types = sorted((d[0], str(d[1])) for d in relation.description)
                problem = compare(df, relation)
                pairs = [f"{a[0]}:{a[1]}/{b[1]}" for a, b in zip(sorted(df.dtypes), types)]
                print("OK  " if problem is None else "BAD ", name, f"{time.time() - start:.1f}s (build {built:.1f} plan {planned:.1f})", df.count(), problem or "", flush=True)
                same = {"string": "STRING", "bigint": "NUMBER", "int": "NUMBER"}
                print("      ", " ".join(pairs), flush=True) if "-v" in sys.argv else None
            else:
                print("ROWS", name, df.count(), flush=True)
        except Exception:
            print("FAIL", name, traceback.format_exc()[-600:], flush=True)


if __name__ == "__main__":
    main()
