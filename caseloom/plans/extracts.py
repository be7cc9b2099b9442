"""Scheduled extracts: which are due, how they are adjusted, where they are written."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_col
from ..functions.categories import clean_constant
from ..functions.text import NA_TEXT, clean_names, clean_str, snake_case
from ..operators import clean, quality, reports, summary
from ..sources.sinks import SAVERS, Saver, save_csv, save_csv_plain, save_parquet, save_table, save_truncated, saved
from ..sources.store import ResultStore
from ..sources.tables import SqlExtracts
from .publish import Manifest, publish_table, staged
from .session import shuffles_removed

Adjust = Callable[[DataFrame], DataFrame]

READABLE = (save_csv, save_csv_plain, save_parquet, save_table, save_truncated)

# The weekday columns of the schedule.
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def do_nothing(df: DataFrame) -> DataFrame:
    return df


ADJUSTERS: dict[str, Adjust] = {
    "do_nothing": do_nothing,
    "clean_names": clean_names,
    "do_something": clean_names,
    "make_data_hub": reports.data_hub,
    "remove_pt_cols": clean.drop_identifiers,
    "remove_retired_cols": clean.drop_retired,
    "keep_only_trend_epi_cols": clean.keep_trend_cols,
    "keep_only_trendvoc_epi_cols": clean.keep_trend_variant_cols,
    "keep_only_web_epi_cols": clean.keep_web_cols,
    "keep_only_weekly_report_cols": clean.keep_weekly_cols,
}


def by_name[T](registry: dict[str, T], name: str | None, default: T) -> T:
    """Registered function of that name; the default when the name is blank or unknown."""
    return registry.get(name, default) if name else default


Source = Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class Extract:
    """One configured extract: SQL text or a function that makes the table, adjustment, writer, target and weekdays."""

    nm: str
    sql_str: str | Source
    path: str
    adjust_func: str | None = None
    saving_func: str | None = None
    copy_path: str | None = None
    days: dict[str, str | None] = field(default_factory=lambda: dict.fromkeys(WEEKDAYS, "x"))


def due(config: DataFrame, asof: object, *, name: str = "nm") -> DataFrame:
    """Names whose column for that weekday holds more than blanks and punctuation."""
    today = F.date_format(as_col(asof), "E")
    days = [c for c in config.columns if c in WEEKDAYS]
    return (
        config.unpivot([name], days, "day", "flag")
        .where((F.col("day") == today) & (F.length(clean_str("flag")) > 0))
        .select(name)
    )


def is_due(extract: Extract, asof: dt.date) -> bool:
    """The same test for one configured extract, on the driver: no data is involved."""
    return clean_constant(extract.days.get(WEEKDAYS[asof.weekday()]) or "") not in ("", NA_TEXT)


def write_twice(df: DataFrame, save: Saver, path: str, copy_path: str | None) -> None:
    """Write the result, and a copy in a second place if one is configured.

    The copy is made from the first files, so the result is computed once and both are equal. For a writer of
    one's own, whose files cannot be read here, the result is kept in executor storage meanwhile.
    """
    if copy_path is None:
        with shuffles_removed(df.sparkSession):
            save(df, path)
        return
    kept = None if save in READABLE else df.persist()
    try:
        with shuffles_removed(df.sparkSession):
            save(df, path)
            save(saved(df.sparkSession, save, path) if kept is None else kept, copy_path)
    finally:
        if kept is not None:
            kept.unpersist()


def run_extract(
    extracts: SqlExtracts, extract: Extract, *, manifest: Manifest | None = None, asof: dt.date | None = None,
    refresh: bool = False,
) -> DataFrame | None:
    """Make, adjust and write one extract. With a manifest it is published whole, and null if it was done before."""
    source, save = extract.sql_str, by_name(SAVERS, extract.saving_func, save_csv)

    def adjusted() -> DataFrame:
        df = extracts.get(source, refresh=refresh) if isinstance(source, str) else source(extracts.spark)
        return df.transform(by_name(ADJUSTERS, extract.adjust_func, do_nothing))

    if manifest is None:
        out = adjusted()
        write_twice(out, save, extract.path, extract.copy_path)
        return out
    made: list[DataFrame] = []

    def write(stage: Callable[[str], str]) -> None:
        made.append(adjusted())
        if staged(save):
            write_twice(made[0], save, stage(extract.path), stage(extract.copy_path) if extract.copy_path else None)
        else:
            write_twice(made[0], publish_table if save is save_table else save, extract.path, extract.copy_path)

    what = source if isinstance(source, str) else getattr(source, "__qualname__", "function")
    digest = manifest.digest(asof, what, extract.adjust_func, extract.saving_func, extract.path, extract.copy_path)
    manifest.publish(extract.nm, digest, write)
    return made[0] if made else None


def report_extracts(out: str, days: dict[str, dict[str, str]] | None = None) -> list[Extract]:
    """One extract per named report over the published views, due every day unless told otherwise."""
    made = []
    for name, (view, without) in reports.REPORT_VIEWS.items():
        cols = f"* EXCEPT ({', '.join(without)})" if without else "*"
        extra = {"days": days[name]} if days and name in days else {}
        folder = snake_case(name)
        made.append(Extract(folder, f"SELECT {cols} FROM {view}", f"{out}/{folder}", **extra))
    return made


def run_due(
    spark: SparkSession, config: Iterable[Extract], asof: dt.date, *, share: bool = True,
    manifest: Manifest | None = None, store: ResultStore | None = None, refresh: bool = False,
) -> list[Extract]:
    """Run every extract that is due.

    A SQL text that several due extracts use is computed once and kept in executor storage until the end; switch
    ``share`` off where it would not fit. With a ``store``, results of earlier sessions are read again while their inputs
    are the same, unless ``refresh`` asks for new ones. With a ``manifest``, a batch that died goes on where it was:
    extracts that are done for the same day and settings are not made again.
    """
    due_now = [e for e in config if is_due(e, asof)]
    uses = Counter(SqlExtracts.key(e.sql_str) for e in due_now if isinstance(e.sql_str, str))
    several = {k for k, n in uses.items() if n > 1}
    # what is stored needs no place in executor storage
    alone = SqlExtracts(spark, store=store)
    shared = alone if store is not None else SqlExtracts(spark, persist=True)
    fresh: set[str] = set()
    try:
        for e in due_now:
            key = SqlExtracts.key(e.sql_str) if isinstance(e.sql_str, str) else None
            # once for each SQL text, however many extracts use it
            again = refresh and key not in fresh
            run_extract(shared if share and key in several else alone, e, manifest=manifest, asof=asof, refresh=again)
            fresh.add(key)
    finally:
        shared.clear()
    return due_now


def daily_reports(
    cases: DataFrame, out: str, *, asof: dt.date, min_date: object = "2020-01-01",
    config: Iterable[clean.Cleaning] = (),
) -> dict[str, Extract]:
    """The reports that are made by functions, by name; each may have its own weekdays like any extract."""
    made: dict[str, Source] = {
        "daily_headline": lambda _: summary.daily_headline(cases, asof=asof),
        "db_errs": lambda _: quality.error_report(cases, asof=asof, min_date=min_date),
        "ijn": lambda _: summary.recent_travel_cases(cases, asof=asof),
        "completness": lambda _: summary.completeness_wide(cases, config=config),
        "count_summary": lambda _: summary.count_summary(cases),
    }
    return {name: Extract(name, source, f"{out}/{name}") for name, source in made.items()}


# The reports of the daily batch before and after the named extracts.
BEFORE, AFTER = ["daily_headline", "db_errs"], ["ijn"]


def end_of_day(
    spark: SparkSession, cases: DataFrame, config: Iterable[Extract], out: str, *, asof: dt.date,
    min_date: object = "2020-01-01", days: dict[str, dict[str, str | None]] | None = None,
    before: list[str] = BEFORE, after: list[str] = AFTER, cleaning: Iterable[clean.Cleaning] = (), share: bool = True,
    manifest: Manifest | None = None, store: ResultStore | None = None, refresh: bool = False,
) -> dict[str, str]:
    """The ordered daily batch: headline, error report, named extracts, travel report; each only if it is due.

    ``days`` holds the weekdays of the reports by name; one that is not listed is due every day. Completeness and the
    count summary are made by name too, where ``before`` or ``after`` lists them. ``share``, ``manifest``, ``store`` and
    ``refresh`` as in :func:`run_due`; over stored tables a scan costs less than a place in executor storage.
    """
    made = daily_reports(cases, out, asof=asof, min_date=min_date, config=cleaning)
    named = {n: replace(e, days=days[n]) if days and n in days else e for n, e in made.items()}
    batch = [*(named[n] for n in before), *config, *(named[n] for n in after)]
    done = run_due(spark, batch, asof, share=share, manifest=manifest, store=store, refresh=refresh)
    return {e.nm: e.path for e in done}
