"""Compare every registered query with its SQL at one scale: python tests/check_oracle.py [dir] [names]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tallymart.session import build_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr), sorted(columns)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    df = entry.queries()[name](spark, sf_dir)
    start = time.time()
    got, got_columns = rows_of(df.columns, df.collect())
    took = time.time() - start
    rel = con.sql(entry.oracle_sql()[name])
    want, want_columns = rows_of(rel.columns, rel.fetchall())
    types = dict(zip(rel.columns, map(str, rel.types), strict=True))
    note = f"{len(got)} rows / {len(want)}, {took:.1f}s, {df.dtypes} {types}"
    if got_columns != want_columns:
        return False, f"columns {got_columns} / {want_columns}"
    if got != want:
        diff = [(a, b) for a, b in zip(got, want, strict=False) if a != b][:3]
        return False, f"{note}; first differences {diff}"
    return True, note


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.oracle_sql())
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print("OK  " if ok else "FAIL", name, note, flush=True)
    print("failed:", bad)
