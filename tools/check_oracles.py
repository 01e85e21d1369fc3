"""Run every named query against its SQL in DuckDB and report differences.

    python tools/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retinue.catalog import ORACLES, QUERIES  # noqa: E402
from retinue.session import build_session  # noqa: E402

BASE = "region nation customer supplier part orders lineitem events".split()


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Rows as text in a canonical order; floats keep every digit."""

    def cell(value):
        if value is None or (isinstance(value, float) and pd.isna(value)) or value is pd.NaT:
            return ""
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        if pd.api.types.is_float(value):
            return repr(float(value))
        return str(value)

    frame = frame[sorted(frame.columns)]
    text = pd.DataFrame({c: [cell(v) for v in frame[c].astype(object)] for c in frame.columns})
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def as_frame(table) -> pd.DataFrame:
    return pd.DataFrame({c: table.column(c).to_pylist() for c in table.column_names}, dtype=object)


def oracle_connection(folder: str):
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def difference(con, df, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    got = as_frame(df.toArrow())
    if name not in ORACLES:
        return None if len(got) else "no rows"
    want = as_frame(con.sql(ORACLES[name]).to_arrow_table())
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = normal(got), normal(want)
    for column in a.columns:
        wrong = a[column] != b[column]
        if wrong.any():
            i = wrong.idxmax()
            return f"{int(wrong.sum())} cells differ in {column}: {a[column][i]} != {b[column][i]}"
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "oracles", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(con, QUERIES[name](spark, folder), name)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        tag = "ok  " if problem is None else "FAIL"
        kind = "" if name in ORACLES else " (rows only)"
        print(f"{tag} {name}{kind} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
