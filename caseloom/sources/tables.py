"""Reading tables and running extract SQL, each read at most once per session."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import flat_dates
from ..functions.text import latin1_text
from ..plans.sizing import materialise
from .store import ResultStore


class Tables:
    """Tables by name under one folder, kept as lazy DataFrames and temp views.

    ``persist`` keeps a table in executor memory and disk; leave it off for tables that
    are larger than the cluster's storage, a parquet scan with pruned columns is cheaper.
    """

    def __init__(self, spark: SparkSession, folder: str, *, persist: bool = False):
        self.spark, self.folder, self.persist = spark, folder.rstrip("/"), persist
        self._known: dict[str, DataFrame] = {}

    def get(self, name: str, *, refresh: bool = False) -> DataFrame:
        if refresh and name in self._known:
            self._known.pop(name).unpersist()
        if name not in self._known:
            df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            self.register(name, df)
        return self._known[name]

    def register(self, name: str, df: DataFrame) -> DataFrame:
        df = df.persist() if self.persist else df
        df.createOrReplaceTempView(name)
        self._known[name] = df
        return df

    def flat(self, name: str) -> DataFrame:
        """The table with every date column as a date, whatever its stored form, and old accents as they were meant."""
        return latin1_text(flat_dates(self.get(name)))


class SqlExtracts:
    """Results of extract SQL, one per distinct text; with a ``store``, results of earlier sessions are read again."""

    def __init__(self, spark: SparkSession, *, persist: bool = False, store: ResultStore | None = None):
        self.spark, self.persist, self.store = spark, persist, store
        self._known: dict[str, DataFrame] = {}

    @staticmethod
    def key(sql: str) -> str:
        return hashlib.sha256(sql.encode()).hexdigest()

    def get(self, sql: str, *, refresh: bool = False) -> DataFrame:
        k = self.key(sql)
        if refresh and k in self._known:
            self._known.pop(k).unpersist()
        if k not in self._known:
            df = self.spark.sql(sql.strip().rstrip(";")) if self.store is None else self.store.get(sql, refresh=refresh)
            self._known[k] = df.persist() if self.persist else df
        return self._known[k]

    def clear(self) -> None:
        for df in self._known.values():
            df.unpersist()
        self._known.clear()


def read_jdbc(
    spark: SparkSession, url: str, table: str, *, column: str, lower: object, upper: object,
    partitions: int, fetch_size: int = 10_000, properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a database table in parallel ranges of a column; replaces paging by offset.

    Ranges do not overlap and the outer ones are open, so no row is lost or repeated.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url).option("dbtable", table)
        .option("partitionColumn", column)
        .option("lowerBound", str(lower)).option("upperBound", str(upper))
        .option("numPartitions", partitions).option("fetchsize", fetch_size)
    )
    return reader.options(**(properties or {})).load()


def _literal(value: object, kind: T.DataType) -> str:
    """A value as standard SQL."""
    if isinstance(kind, T.DateType):
        return f"DATE '{value}'"
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return f"TIMESTAMP '{value}'"
    if isinstance(kind, T.StringType):
        return "'" + str(value).replace("'", "''") + "'"
    if not isinstance(kind, T.NumericType):
        raise ValueError(f"no ranges over {kind.simpleString()}")
    return repr(value) if isinstance(kind, T.FloatType | T.DoubleType) else str(value)


def range_starts(histogram: DataFrame, partitions: int, *, key: str = "key", n: str = "n") -> list:
    """First keys of the ranges, but the first, that cut a histogram of keys into parts of about equal rows.

    The histogram may be as large as the table: it is sorted and summed up in parts, and one row for each range reaches
    the driver. A key that holds several shares is a range of its own; missing keys are left out.
    """
    if partitions < 1:
        raise ValueError("at least one range is needed")
    rows = histogram.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.sum(n).cast("long").alias("n"))
    # dealt in order; stored, so that numbers of parts and their sums belong together
    rows = materialise(rows.where("n > 0").repartitionByRange("k").withColumn("part", F.spark_partition_id()))
    sums = rows.groupBy("part").agg(F.sum("n").alias("all"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = sums.agg(F.sum("all")).first()[0]
    if not total:
        return []
    # a row for each part of the table at hand
    sums = sums.select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before") + F.sum("n").over(inside)
    # a key belongs to the range in which the middle of its rows lies
    middle = (upto.cast("decimal(38,0)") * 2 - F.col("n")) * partitions
    ranged = rows.join(F.broadcast(sums), "part").select("k", F.least(F.floor(middle / (2 * F.lit(total).cast("decimal(20,0)"))), F.lit(partitions - 1)).alias("range"))
    starts = sorted(r["k"] for r in ranged.groupBy("range").agg(F.min("k").alias("k")).collect())
    return starts[1:]


def balanced_predicates(histogram: DataFrame, partitions: int, column: str, *, key: str = "key", n: str = "n") -> list[str]:
    """Conditions on ``column`` that each row of a table meets exactly one of, for a read in parallel ranges.

    ``histogram`` counts the rows (``n``) of each ``key``, or of each coarse step of it. The outer ranges are open, so rows
    that came since are read too, and rows without a key go with the first.
    """
    kind = histogram.schema[key].dataType
    cuts = [_literal(x, kind) for x in range_starts(histogram, partitions, key=key, n=n)]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_jdbc_balanced(
    spark: SparkSession, url: str, table: str, *, column: str, partitions: int, step: str | None = None,
    fetch_size: int = 10_000, properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a database table in ranges of about equal rows, whatever the distribution of ``column``.

    The database counts its rows by key first; ``step`` is an expression that makes keys coarser in order, such as
    ``floor(id / 1000) * 1000``, where there are very many.
    """
    own = {"fetchsize": str(fetch_size), **(properties or {})}
    counted = f"(SELECT {step or column} AS key, count(*) AS n FROM {table} GROUP BY {step or column}) counted"
    histogram = spark.read.jdbc(url, counted, properties=own)
    names = {c.lower(): c for c in histogram.columns}
    cuts = balanced_predicates(histogram, partitions, column, key=names["key"], n=names["n"])
    return spark.read.jdbc(url, table, predicates=cuts, properties=own)


def read_csv(spark: SparkSession, path: str, schema: str, *, encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header and a known schema; blanks are null. ``ISO-8859-1`` keeps old accents."""
    return (
        spark.read.option("header", True).option("nullValue", "").option("emptyValue", "")
        .option("escape", '"').option("multiLine", True).option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .schema(schema).csv(path)
    )
