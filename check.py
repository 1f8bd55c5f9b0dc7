"""Run registered queries next to their SQL and compare the rows.

    python check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from trackline import plans
from trackline.session import session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    plain = frame.apply(lambda column: column.map(_plain))
    return plain.sort_values(list(plain.columns)).reset_index(drop=True)


def _plain(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA:
        return "~"
    if isinstance(value, float):
        if value != value:
            return "~"
        return repr(value) if value != int(value) else str(int(value))
    if hasattr(value, "item"):
        return _plain(value.item())
    return str(value)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} instead of {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    a, b = canonical(got), canonical(want)
    unequal = (a != b).any(axis=1)
    if unequal.any():
        return (
            f"{int(unequal.sum())} rows differ\n--- got\n{a[unequal].head(4).to_string()}"
            f"\n--- want\n{b[unequal].head(4).to_string()}"
        )
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = session(
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(args.sf)
    failed = 0
    for name in args.names or plans.QUERIES:
        begin = time.time()
        try:
            got = plans.QUERIES[name](spark, args.sf).toPandas()
            took = time.time() - begin
            if name in plans.ORACLE:
                problem = differences(got, db.sql(plans.ORACLE[name]).df())
                state = "ok" if problem is None else f"WRONG {problem}"
            else:
                state = "rows only"
        except Exception as error:  # report and go on with the next query
            took, state = time.time() - begin, f"FAILED {str(error)[:1500]}"
        failed += state.startswith(("WRONG", "FAILED"))
        rows = len(got) if not state.startswith("FAILED") else 0
        print(f"{name:28s} {rows:8d} rows {took:6.1f} s  {state}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
