"""Runs registered queries next to their SQL twins: python tests/compare.py FOLDER [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

import __spark_entry__ as entry
from sprintlens.session import build_session

SPENT = [0.0]


def engine(folder: str):
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(f)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def key(row):
    return tuple((v is None, "" if v is None else (f"{v:.6f}" if isinstance(v, float) else str(v))) for v in row)


def compare(spark, con, folder: str, name: str) -> str:
    """'' when equal, else what differs."""
    start = time.time()
    mine = entry.queries()[name](spark, folder).toArrow()
    SPENT[0] = time.time() - start
    theirs = con.execute(entry.oracle_sql()[name]).to_arrow_table()
    columns = sorted(mine.column_names)
    if columns != sorted(theirs.column_names):
        return f"columns {columns} / {sorted(theirs.column_names)}"
    types = [(c, str(mine.schema.field(c).type), str(theirs.schema.field(c).type)) for c in columns]
    wrong = [t for t in types if t[1].replace("large_", "") != t[2].replace("large_", "")]
    note = f"types {wrong} " if wrong else ""
    if mine.num_rows != theirs.num_rows:
        return note + f"rows {mine.num_rows} / {theirs.num_rows}"
    a = sorted(zip(*[mine[c].to_pylist() for c in columns]), key=key)
    b = sorted(zip(*[theirs[c].to_pylist() for c in columns]), key=key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        close = all(
            u == v or (isinstance(u, float) and isinstance(v, float) and math.isclose(u, v, abs_tol=2e-6))
            for x, y in bad for u, v in zip(x, y)
        )
        return note + f"{len(bad)} of {len(a)} rows differ (close: {close}) {columns} {bad[0]}"
    return note


if __name__ == "__main__":
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = engine(folder)
    oracle = entry.oracle_sql()
    for name in wanted or entry.queries():
        start = time.time()
        try:
            if name in oracle:
                found = compare(spark, con, folder, name) or f"ok (spark {SPENT[0]:.1f}s)"
            else:
                table = entry.queries()[name](spark, folder).toArrow()
                found = f"rows-only {table.num_rows} {table.slice(0, 2).to_pylist()}"
        except Exception as e:  # noqa: BLE001
            found = f"FAIL {type(e).__name__}: {str(e)[:600]}"
        print(f"{name}: {found} [{time.time() - start:.1f}s]", flush=True)
