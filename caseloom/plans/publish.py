"""Publishing of reports so that a batch can die at any point.

A report is written beside its place and then renamed into it. A manifest says which reports of a batch are done, or ready
to be renamed; the same batch run again goes on from there. Readers see the old report or the new one, never a part.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import Files
from ..sources.sinks import Saver, save_table


class Manifest:
    """What a batch has done so far: a small file for each report in a folder that outlives the session."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.files, self.folder = spark, Files(spark), folder.rstrip("/")

    def _file(self, name: str, digest: str) -> str:
        # a name may hold anything; the digest of what is asked for tells a changed report from a finished one
        return f"{self.folder}/{hashlib.sha256(name.encode()).hexdigest()[:16]}-{digest}.json"

    @staticmethod
    def digest(*parts: object) -> str:
        return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()[:32]

    def state(self, name: str, digest: str) -> dict:
        text = self.files.read(self._file(name, digest))
        return json.loads(text) if text else {"moves": [], "done": False}

    def note(self, name: str, digest: str, state: dict) -> None:
        self.files.write(self._file(name, digest), json.dumps({"name": name, **state}))

    def finished(self) -> list[str]:
        """Names of the reports that are done."""
        texts = (self.files.read(f"{self.folder}/{f}") for f in self.files.names(self.folder) if f.endswith(".json"))
        states = [json.loads(t) for t in texts if t]
        return sorted(s["name"] for s in states if s["done"])

    # ---- publishing

    def publish(self, name: str, digest: str, write) -> bool:
        """Run ``write(stage)`` unless this report is done; ``stage(path)`` gives where to write instead of the path.

        False if there was nothing to do. Reports whose files were ready when the batch died are only renamed.
        """
        state = self.state(name, digest)
        if state["done"]:
            return False
        if not state["moves"]:
            moves: list[list[str]] = []

            def stage(path: str) -> str:
                self._tidy(path)
                aside = f"{path}__staged_{uuid.uuid4().hex}"
                moves.append([aside, path, f"{path}__replaced_{uuid.uuid4().hex}"])
                return aside

            write(stage)
            state = {"moves": moves, "done": False}
            self.note(name, digest, state)
        for aside, path, replaced in state["moves"]:
            self._swap(aside, path, replaced)
        self.note(name, digest, {**state, "done": True})
        for _, _, replaced in state["moves"]:
            self.files.remove(replaced)
        return True

    def _tidy(self, path: str) -> None:
        """Remove what a writer that died has left beside a path."""
        above, _, own = path.rstrip("/").rpartition("/")
        for left in self.files.names(above):
            if left.startswith(f"{own}__staged_"):
                self.files.remove(f"{above}/{left}")

    def _swap(self, aside: str, path: str, replaced: str) -> None:
        """Put a staged folder in place; each step is skipped where a run before has done it."""
        if not self.files.exists(aside):
            return
        if self.files.exists(path):
            self.files.move(path, replaced)
        self.files.move(aside, path)


def publish_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table by one that is written whole under another name first."""
    spark = df.sparkSession
    aside = f"{name}__staged_{uuid.uuid4().hex}"
    save_table(df, aside)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")


def staged(save: Saver) -> bool:
    """Whether a writer's target is a path that can be staged; a catalog table is replaced by name."""
    return save is not save_table
