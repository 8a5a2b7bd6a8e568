"""Run the registered queries and their SQL side by side: ``python -m checks.compare [dir] [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.suite import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "O" and len(df) and hasattr(df[c].dropna().iloc[:1].squeeze(), "year"):
            df[c] = pd.to_datetime(df[c])
        if df[c].dtype.kind == "M":
            df[c] = df[c].astype("datetime64[us]")
        if df[c].dtype.kind in "iub":
            df[c] = df[c].astype("float64")
        if df[c].dtype.kind == "f":
            df[c] = df[c].astype("float64") + 0.0
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = int((~same).to_numpy().argmax())
            return f"{c}: {int((~same).sum())} differ, first {a[c][i]!r} != {b[c][i]!r} in {dict(a.loc[i])}"
    return None


def main(folder: str, names: list[str]) -> int:
    spark, con, bad = session(), database(folder), 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            got = QUERIES[name](spark, folder).toPandas()
            took = time.time() - start
            if name not in ORACLES:
                print(f"rows  {name:28s} {len(got):7d} rows {took:6.2f}s", flush=True)
                continue
            start = time.time()
            want = con.execute(ORACLES[name]).fetchdf()
            problem = difference(got, want)
            print(f"{'BAD ' if problem else 'ok  '}  {name:28s} {len(got):7d} rows {took:6.2f}s "
                  f"sql {time.time() - start:5.2f}s {problem or ''}", flush=True)
            bad += problem is not None
        except Exception as error:
            bad += 1
            print(f"FAIL  {name:28s} {type(error).__name__}: {str(error)[:600]}", flush=True)
    print(f"{bad} bad of {len(names or QUERIES)}")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    where = args.pop(0) if args and Path(args[0]).is_dir() else "/root/testdata/sf0.01"
    sys.exit(1 if main(where, args) else 0)
