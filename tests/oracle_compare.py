"""Run registered queries next to their SQL in DuckDB.

    python tests/oracle_compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows[sorted(rows.columns)]
    return rows.sort_values(list(rows.columns), kind="stable").reset_index(drop=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs, or None: names, types, count and exact values are compared."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} v {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} v {len(theirs)}"
    a, b = canonical(ours), canonical(theirs)
    for c in a.columns:
        if a[c].dtype != b[c].dtype:
            return f"type of {c}: {a[c].dtype} v {b[c].dtype}"
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = (~same).idxmax()
            return f"{(~same).sum()} values of {c}, first {a.loc[i].to_dict()} v {b.loc[i].to_dict()}"
    return None


def main(sf: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from linkloom.session import build_session

    spark, con = build_session("8"), connect(sf)
    oracles, failed = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            ours = run(spark, sf).toPandas()
            ran = time.time()
            verdict = "rows only"
            if name in oracles:
                theirs = con.execute(oracles[name]).fetch_df()
                verdict = differences(ours, theirs) or "equal"
            took = f"{ran - start:6.2f}s {time.time() - ran:6.2f}s"
        except Exception as error:  # report and go on
            verdict, took = f"{type(error).__name__}: {str(error)[:500]}", ""
        failed += verdict not in ("equal", "rows only")
        print(f"{name:24s} {took} rows={len(ours):7d} {verdict}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
