"""Run each catalogued query on Spark and its counterpart on DuckDB, and compare exactly.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(os.path.join(sf_dir, "*.parquet"))):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(df: pd.DataFrame) -> list[tuple]:
    """Rows in a canonical order, columns by name, missing values as None."""
    df = df[sorted(df.columns)]
    rows = [tuple(None if pd.isna(v) else v for v in row) for row in df.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def difference(spark_df, duck: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides hold the same rows; else the first difference."""
    left, right = spark_df.toPandas(), duck.execute(sql).df()
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} != {sorted(right.columns)}"
    for column in left.columns:
        if left[column].dtype != right[column].dtype and len(left):
            kinds = (left[column].dtype.kind, right[column].dtype.kind)
            if kinds[0] != kinds[1]:
                return f"type of {column}: {left[column].dtype} != {right[column].dtype}"
    a, b = _plain(left), _plain(right)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first: {wrong[0]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from checks import oracle
    from hazgrid import catalog
    from hazgrid.session import build_session

    spark = build_session("local[8]", spark__sql__shuffle__partitions="8")
    con, sql, bad = connect(sf_dir), oracle.all_sql(), 0
    for name, query in catalog.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        if name not in sql:
            print(f"{name:28s} {query(spark, sf_dir).count()} rows, no SQL")
            continue
        found = difference(query(spark, sf_dir), con, sql[name])
        bad += found is not None
        print(f"{name:28s} {time.time() - start:5.1f}s {found or 'equal'}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
