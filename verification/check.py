"""Compare queries with their SQL: ``python -m verification.check [--sf 0.01] [name ...]``."""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from caseloom.plans.session import START_SETTINGS, apply_settings

from .queries import ORACLES, QUERIES


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("caseloom-check")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").config(map=START_SETTINGS).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark: SparkSession, con, folder: str, name: str) -> str:
    """Empty when equal, else what differs."""
    df = QUERIES[name](spark, folder)
    got = _rows(df.columns, df.collect())
    if name not in ORACLES:
        return "" if got else "no rows"
    rel = con.execute(ORACLES[name])
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    want = _rows(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    spark_kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE",
                   "boolean": "BOOLEAN"}
    types = [f"{c}: {t} / {kinds[c]}" for c, t in df.dtypes if spark_kinds.get(t) != kinds[c]]
    if types:
        return f"types {types}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    bad = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else "" if got else "both empty"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--cores", type=int, default=8)
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark, con = session(args.cores), database(folder)
    failed = 0
    for name in args.names or QUERIES:
        t = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as e:  # report and go on with the other queries
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - t:.1f}s {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
