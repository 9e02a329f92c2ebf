"""Compares every registered query with its SQL: ``python tests/parity.py [folder] [names...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, cells as comparable text, rows sorted."""

    def cell(v: object) -> str:
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return "null"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v))
        return str(v)

    out = df[sorted(df.columns)].astype(object).map(cell)
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = canonical(got), canonical(want)
    if not a.equals(b):
        unequal = (a != b).any(axis=1)
        return f"{unequal.sum()} rows differ\n{a[unequal].head(3)}\n{b[unequal].head(3)}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from anteframe.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "parity", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                 "spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = []
    for name, run in entry.queries().items():
        if name not in entry.oracle_sql() or (wanted and name not in wanted):
            continue
        start = time.time()
        try:
            got = run(spark, folder).toPandas()
            took = time.time() - start
            want = con.execute(entry.oracle_sql()[name]).df()
            problem = difference(got, want)
        except Exception as e:  # noqa: BLE001
            problem, took, got = f"{type(e).__name__}: {str(e)[:600]}", time.time() - start, []
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32s} {len(got):7d} rows {took:6.2f} s", flush=True)
        if problem:
            print("     " + problem.replace("\n", "\n     "))
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
