"""Run the queries next to their oracles and report differences: ``python -m checks.compare [sf_dir] [query ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

from catalogsync.session import build_session
from checks.oracle import oracle_sql
from checks.queries import registry


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Sorted columns and rows, all values as text: equal frames hold the same rows."""
    frame = frame[sorted(frame.columns)]
    text = frame.astype(object).where(frame.notna(), None).map(_text)
    return text.sort_values(list(text.columns), ignore_index=True)


def _text(value: object) -> str:
    if value is None:
        return "∅"
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return str(value)


def difference(got: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a query and its oracle, None for nothing."""
    mine, want = got.toPandas(), con.execute(sql).df()
    if sorted(mine.columns) != sorted(want.columns):
        return f"columns {sorted(mine.columns)} but oracle has {sorted(want.columns)}"
    if len(mine) != len(want):
        return f"{len(mine)} rows but oracle has {len(want)}"
    a, b = _plain(mine), _plain(want)
    if a.equals(b):
        return None
    off = (a != b).any(axis=1)
    return f"{int(off.sum())} of {len(a)} rows differ:\n{a[off].head(3).to_dict('records')}\n{b[off].head(3).to_dict('records')}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", LOCAL)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = oracle_connection(sf_dir), oracle_sql(), 0
    for name, query in registry().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            found = difference(query(spark, sf_dir), con, oracles[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    return bad


# For one machine: no web interface, one address, few partitions.
LOCAL = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
    "spark.driver.memory": "8g",
    "spark.sql.shuffle.partitions": "8",
}

if __name__ == "__main__":
    sys.exit(main())
