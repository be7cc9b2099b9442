"""Small file operations that work on any Hadoop file system, object stores included."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The file system behind a path, as the session's Hadoop configuration names it."""

    def __init__(self, spark: SparkSession):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._utils = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self._path(path)
        return target.getFileSystem(self._conf), target

    def exists(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target)

    def names(self, path: str) -> list[str]:
        """Names in a folder in order; none if there is no such folder."""
        fs, target = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []

    def move(self, source: str, target: str) -> None:
        """Rename; the folders above the target are made, and a target that is there is an error."""
        fs, a = self._at(source)
        b = self._path(target)
        fs.mkdirs(b.getParent())
        if fs.exists(b) or not fs.rename(a, b):
            raise OSError(f"cannot move {source} to {target}")

    def remove(self, path: str) -> None:
        fs, target = self._at(path)
        fs.delete(target, True)

    def write(self, path: str, text: str) -> None:
        """A small text file that is there as a whole or not at all; one that is there is replaced."""
        part = f"{path}.part-{uuid.uuid4().hex}"
        fs, target = self._at(part)
        out = fs.create(target, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.remove(path)
        self.move(part, path)

    def read(self, path: str) -> str | None:
        """A small text file; null if there is none."""
        fs, target = self._at(path)
        try:
            stream = fs.open(target)
        except Py4JJavaError as e:
            if "FileNotFoundException" in str(e.java_exception):
                return None
            raise
        try:
            return bytes(self._utils.toByteArray(stream)).decode()
        finally:
            stream.close()
