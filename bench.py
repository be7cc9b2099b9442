"""Times the headline queries, the median of three passes, and prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from statistics import median

from pyspark.sql import SparkSession

from caseloom.plans.session import SETTINGS, START_SETTINGS
from verification.queries import QUERIES

HEADLINE = [
    "dq_report",
    "count_summary",
    "impute_dates",
    "cell_diff",
    "epi_rolling_mean",
    "completeness_wide",
    "positivity_by_age",
    "suggest_value_fixes",
    "case_view_sql",
    "one_time_clean",
    "data_hub_full",
    "recent_travel_cases",
]

# The median of this many passes counts.
PASSES = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("caseloom-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (SETTINGS | START_SETTINGS).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["daily_headline"](spark, folder).write.format("noop").mode("overwrite").save()
    passes: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for _ in range(PASSES):
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            passes[name].append(time.perf_counter() - start)
    seconds = {name: round(median(s), 3) for name, s in passes.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "passes": PASSES,
                "cores": int(cpus),
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
