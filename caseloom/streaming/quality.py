"""The row-level rules on a stream of cases: append only, no state, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import error_report


def stream_errors(cases: DataFrame, path: str, checkpoint: str, *, asof, min_date="2020-01-01") -> StreamingQuery:
    """Append the errors of newly arrived cases to a parquet folder, then stop."""
    found = error_report(cases, asof=asof, min_date=min_date, ordered=False)
    return (
        found.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
