"""Counts kept by report day, so that a daily run reads new days only.

Counts of disjoint days add up: what is kept for a day is merged with that of all others, and reports are made from the
sums. A run counts the days since the last one, and the last days again as often as reports of them still change.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_col
from ..sources.files import Files

#: Where rows without a report day are kept.
NO_DAY = "none"

#: Counts of a table by the given columns first; they must add up over any split of its rows by these.
Count = Callable[[DataFrame, list[str]], DataFrame]


class DayCounts:
    """Counts by day under a folder. Every state is a manifest that says which run's files hold for which days.

    A run writes its counts aside and then adds a manifest, so a run that dies changes nothing, and a reader sees all
    of a run or nothing of it. After ``most_runs`` runs their counts are written together.
    """

    def __init__(self, spark: SparkSession, folder: str, count: Count, *, day: str = "phacreporteddate", most_runs: int = 30):
        self.spark, self.files, self.folder, self.count, self.day = spark, Files(spark), folder.rstrip("/"), count, day
        self.most_runs = most_runs

    def _manifests(self) -> list[str]:
        return [n for n in self.files.names(self.folder) if n.startswith("manifest-") and n.endswith(".json")]

    def state(self) -> dict:
        """Runs with the days they hold for (after one, up to another), the run of rows without a day, and the columns."""
        names = self._manifests()
        text = self.files.read(f"{self.folder}/{names[-1]}") if names else None
        return json.loads(text) if text else {"runs": [], "none": None, "upto": None, "schema": None}

    def _note(self, state: dict) -> None:
        names = self._manifests()
        number = int(names[-1][len("manifest-") : -len(".json")]) + 1 if names else 0
        self.files.write(f"{self.folder}/manifest-{number:09}.json", json.dumps(state))

    def _write(self, counts: DataFrame) -> str:
        run = uuid.uuid4().hex
        # in order of days, so that a reader passes over parts of files that hold for no day any more
        counts.sortWithinPartitions("__day").write.parquet(f"{self.folder}/run={run}")
        return run

    def update(self, df: DataFrame, upto: dt.date, *, again: int = 0) -> list[str]:
        """Count the days after the last run up to ``upto``, the ``again`` days before them and rows without a day.

        The condition is on the day alone, so it reaches the scan. Returns the days that hold rows.
        """
        state = self.state()
        day = F.col(self.day).cast("date")
        since = None if state["upto"] is None else dt.date.fromisoformat(state["upto"]) - dt.timedelta(days=again)
        wanted = day <= as_col(upto)
        if since is not None:
            wanted = wanted & (day > as_col(since))
        text = F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(NO_DAY))
        counts = self.count(df.where(wanted | day.isNull()).withColumn("__day", text), ["__day"])
        run = self._write(counts)
        low, high = "" if since is None else since.isoformat(), upto.isoformat()
        # what earlier runs counted holds before and after these days, also where no rows are left
        kept = [{"run": r["run"], "after": a, "upto": b} for r in state["runs"] for a, b in ((r["after"], min(r["upto"], low)), (max(r["after"], high), r["upto"])) if a < b]
        if low < high:
            kept.append({"run": run, "after": low, "upto": high})
        schema = T.StructType([f for f in counts.schema.fields if f.name != "__day"])
        self._note({"runs": kept, "none": run, "upto": max(high, state["upto"] or ""), "schema": schema.json()})
        found = self.spark.read.schema("__day string").parquet(f"{self.folder}/run={run}").distinct()
        days = sorted(r[0] for r in found.collect())
        if len({r["run"] for r in kept} | {run}) > self.most_runs:
            self.compact()
        return days

    def _by_day(self) -> DataFrame:
        state = self.state()
        if state["schema"] is None:
            raise ValueError("nothing was counted yet")
        fields = T.StructType.fromJson(json.loads(state["schema"])).fields
        schema = T.StructType([*fields, T.StructField("__day", T.StringType()), T.StructField("run", T.StringType())])
        runs = sorted({r["run"] for r in state["runs"]} | {state["none"]})
        read = self.spark.read.schema(schema).option("basePath", self.folder).parquet(*[f"{self.folder}/run={r}" for r in runs])
        run, day = F.col("run"), F.col("__day")
        holds = (run == state["none"]) & (day == NO_DAY)
        for r in state["runs"]:
            holds = holds | ((run == r["run"]) & (day != NO_DAY) & (day > r["after"]) & (day <= r["upto"]))
        return read.where(holds).drop("run")

    def merged(self) -> DataFrame:
        """The counts of all days, not yet summed; before the first run this is an error."""
        return self._by_day().drop("__day")

    def compact(self) -> None:
        """Write the counts of all runs together; days stay apart, so that they can be counted again."""
        state = self.state()
        run = self._write(self._by_day())
        self._note({**state, "runs": [{"run": run, "after": "", "upto": state["upto"]}], "none": run})

    def prune(self) -> None:
        """Remove the files of runs that hold for no day any more, and all but the last manifest."""
        state = self.state()
        used = {r["run"] for r in state["runs"]} | {state["none"]}
        for name in self._manifests()[:-1]:
            self.files.remove(f"{self.folder}/{name}")
        for name in self.files.names(self.folder):
            if name.startswith("run=") and name.removeprefix("run=") not in used:
                self.files.remove(f"{self.folder}/{name}")
