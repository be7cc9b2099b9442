"""The case line list used for checking: a projection of the given tables.

The same text runs in Spark SQL and DuckDB.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_TEXTS = Path(__file__).resolve().parent / "sql_text"

CASES_SQL, SYMPTOMS_SQL, SECOND_SQL = (
    (_TEXTS / f"{name}.sql").read_text().strip() for name in ("cases", "symptoms", "second_source")
)

ASOF = "2001-06-30"
MIN_DATE = "1996-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(spark: SparkSession, sql: str, tables: dict[str, DataFrame]) -> DataFrame:
    for name in tables:
        sql = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", sql)
    return spark.sql(sql, **tables)


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["customer", "nation", "region"]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # the test table is a single row group, which a scan cannot split
    orders = orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _run(spark, CASES_SQL, {"orders": orders, **{n: table(spark, sf_dir, n) for n in names}})


def symptoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, SYMPTOMS_SQL, {"lineitem": table(spark, sf_dir, "lineitem")})


def first_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark, sf_dir).where("k % 103 <> 0")


def second_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, SECOND_SQL, {"cases_fixture": cases(spark, sf_dir)})
