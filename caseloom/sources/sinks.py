"""Writers for extracts; any Hadoop file-system path works, object stores included."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Saver = Callable[[DataFrame, str], None]


def save_csv(df: DataFrame, path: str, *, compression: str = "gzip") -> None:
    """CSV parts with a header; missing values and blanks are written as nothing.

    A single column writes them as a quoted blank: an empty line would not be read as a row. Parts are compressed, as the
    same few words fill most cells of a line list; ``none`` is for readers that cannot unpack them.
    """
    blank = '""' if len(df.columns) == 1 else ""
    if blank:
        df = df.select(F.coalesce(F.col(f"`{df.columns[0]}`").cast("string"), F.lit("")).alias(df.columns[0]))
    (
        df.write.mode("overwrite").option("header", True).option("nullValue", "")
        .option("emptyValue", blank).option("escape", '"').option("compression", compression)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def save_csv_plain(df: DataFrame, path: str) -> None:
    save_csv(df, path, compression="none")


def save_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_table(df: DataFrame, name: str, *, path: str | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def save_jdbc(df: DataFrame, url: str, table: str, *, batch: int = 10_000, connections: int = 8, properties: dict[str, str] | None = None) -> None:
    """Replace the rows of a database table, over at most so many connections; its definition and grants stay."""
    writer = df.write.format("jdbc").mode("overwrite").option("truncate", True)
    writer = writer.option("url", url).option("dbtable", table).option("batchsize", batch).option("numPartitions", connections)
    writer.options(**(properties or {})).save()


def truncate_names(df: DataFrame, max_chars: int = 32) -> DataFrame:
    """Cut column names to a length; two names that become equal are an error."""
    names = [c[:max_chars] for c in df.columns]
    twice = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    if twice:
        raise ValueError(f"column names collide after truncation: {twice}")
    return df.toDF(*names)


def save_truncated(df: DataFrame, path: str) -> None:
    save_parquet(truncate_names(df), path)


# Writers by the names that extract configurations use. An object-store target is a path like
# any other, and single-machine formats are written as their columnar equivalent.
SAVERS: dict[str, Saver] = {
    "save_csv": save_csv,
    "save_csv_plain": save_csv_plain,
    "save_parquet": save_parquet,
    "save_feather": save_parquet,
    "save_table": save_table,
    "save_db": save_table,
    "save_truncated": save_truncated,
    "save_sas7bdat": save_truncated,
    "save_azure": save_csv,
    "save_azure_modelling": save_csv,
}


def saved(spark: SparkSession, saver: Saver, path: str) -> DataFrame | None:
    """What a writer has left at a path, for a copy by the same writer; null if it is not known how to read it.

    CSV is read as text, so a copy of it has the same cells.
    """
    if saver in (save_csv, save_csv_plain):
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if saver in (save_parquet, save_truncated):
        return spark.read.parquet(path)
    return spark.table(path) if saver is save_table else None
