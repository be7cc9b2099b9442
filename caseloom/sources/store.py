"""Results of extract SQL that outlive a session.

A result is kept under a key made of the SQL, of what it means in this session (views and constants resolved) and of the
listing of its input files. So a changed file, view or day is a miss, and an equal question is read and not computed.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sizing import ensure_checkpoint_dir
from .files import Files

_TO_STRING = "spark.sql.debug.maxToStringFields"


def shared_folder(spark: SparkSession) -> str:
    """The folder that sessions share: the one the cluster names, without the part that belongs to one session."""
    ensure_checkpoint_dir(spark)
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir().rsplit("/", 1)[0]


class ResultStore:
    """Parquet results by key, each in versions of which the last complete one is read."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.files = spark, Files(spark)
        self.folder = f"{(folder or shared_folder(spark)).rstrip('/')}/results"

    def key(self, df: DataFrame, sql: str) -> str | None:
        """Null for a result that cannot be known again: one that is random, or read from other places than files."""
        plan = df._jdf.queryExecution().analyzed()
        leaves = plan.collectLeaves()
        roots = []
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            kind = leaf.getClass().getSimpleName()
            if kind == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
                roots.append(leaf.relation().location().rootPaths().mkString("|"))
            elif kind in ("Range", "OneRowRelation"):
                roots.append(kind)
            else:
                return None
        if not plan.deterministic():
            return None
        old = self.spark.conf.get(_TO_STRING)
        self.spark.conf.set(_TO_STRING, str(2**31 - 1))
        try:
            # numbers of columns differ from session to session; constants such as today's date are in the optimised plan
            meaning = re.sub(r"#\d+L?", "", df._jdf.queryExecution().optimizedPlan().toString())
        finally:
            self.spark.conf.set(_TO_STRING, old)
        schema = df.schema.json()
        parts = [" ".join(sql.split()).rstrip("; "), meaning, *roots, schema, self._listing(df)]
        return hashlib.sha256("\0".join(parts).encode()).hexdigest()

    def _listing(self, df: DataFrame) -> str:
        """Digest of the input files with their sizes and times; the files are listed by tasks and not opened."""
        folders = sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()})
        if not folders:
            return ""
        files = self.spark.read.format("binaryFile").load(folders).select("path", "length", "modificationTime")
        sums = [F.sum(F.xxhash64(F.lit(k), "path", "length", "modificationTime").cast("decimal(38,0)")) for k in (0, 1)]
        return str(tuple(files.agg(F.count(F.lit(1)), *sums).first()))

    def versions(self, key: str) -> list[str]:
        """Complete versions of a result, oldest first."""
        return [v for v in self.files.names(f"{self.folder}/{key}") if v.startswith("v")]

    def get(self, sql: str, *, refresh: bool = False) -> DataFrame:
        """The stored result of a SQL text, which is computed and stored first where it is not there, or with ``refresh``."""
        df = self.spark.sql(sql.strip().rstrip(";"))
        key = self.key(df, sql)
        if key is None:
            return df
        done = self.versions(key)
        if refresh or not done:
            done = [self._store(df, key)]
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{key}/{done[-1]}")

    def _store(self, df: DataFrame, key: str) -> str:
        # written aside and renamed: a version is whole, or not there
        part = f"{self.folder}/{key}/.part-{uuid.uuid4().hex}"
        df.write.parquet(part)
        version = f"v{time.time_ns():020}-{uuid.uuid4().hex[:8]}"
        self.files.move(part, f"{self.folder}/{key}/{version}")
        return version

    def prune(self, keep: int = 1) -> int:
        """Remove all but the last versions of every result, and what died writers left; how many went."""
        gone = 0
        for key in self.files.names(self.folder):
            done = set(self.versions(key)[-keep:] if keep else [])
            for name in self.files.names(f"{self.folder}/{key}"):
                if name not in done:
                    self.files.remove(f"{self.folder}/{key}/{name}")
                    gone += 1
        return gone
