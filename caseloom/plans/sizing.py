"""Size checks, durable cuts and keyed joins shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes of a table that is sent to every executor.
BROADCAST_BYTES = 32 << 20


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; make a private one in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="caseloom-checkpoint-")
    sc.setCheckpointDir(shared)


def materialise(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _width(x: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return 16 + F.coalesce(F.octet_length(x), F.lit(0))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType | T.BinaryType):
            return F.aggregate(x, F.lit(16), lambda n, e: n + 16 + F.coalesce(F.octet_length(e), F.lit(0)))
        return 16 + 16 * F.greatest(F.size(x), F.lit(0))
    if isinstance(kind, T.StructType):
        return sum((_width(x[f.name], f.dataType) for f in kind.fields), F.lit(8))
    return F.lit(8)


def size_in_bytes(df: DataFrame) -> int:
    """About how many bytes a table takes in memory: one aggregation, one row to the driver."""
    row = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16))
    return df.agg(F.sum(F.coalesce(row, F.lit(64)).cast("long"))).first()[0] or 0


def is_small(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether a stored table has few enough bytes to be sent to every executor."""
    return size_in_bytes(df) <= most


def hinted(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast hint for a table whose size was checked, or whose rows are bounded by one that was.

    Otherwise the table is returned as it is, and the join becomes a shuffle join
    that adaptive execution may split on skewed keys.
    """
    return F.broadcast(df) if small else df


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    return hinted(df, is_small(df, most))


def bounded_rows(df: DataFrame, most: int, what: str) -> list[Row]:
    """Rows of a small table on the driver; more than ``most`` are an error, not a risk."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} {what}")
    return rows


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete intermediate files, wherever they are."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equi-join condition in which missing keys match each other."""
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def assert_unique(df: DataFrame, key: str) -> None:
    """Raise when a key occurs twice: one aggregation, one row to the driver."""
    dup = df.groupBy(key).count().where("count > 1").limit(1).count()
    if dup:
        raise ValueError(f"column {key} is not unique")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for intermediate files."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
