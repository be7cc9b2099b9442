"""Session settings that suit these plans; apply them where the session is made."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Wide projections make methods the JVM will not compile; beyond this size the
    # planner falls back to generated code that is split into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Only settable when the session is made: without the first every column call inspects the Python stack.
START_SETTINGS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # files of intermediate results go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def apply_settings(spark: SparkSession) -> SparkSession:
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def small_methods(spark: SparkSession) -> bool:
    """Whether generated methods are limited to a size that the JVM compiles."""
    return int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove what the writes of this block have shuffled as each ends, not when the driver comes to collect their plans.

    For results that are written and not computed again: between the reports of a long batch the files would pile up.
    """
    old = spark.conf.get(_SHUFFLES_GO, "false")
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLES_GO, old)
