"""Counts, completeness and other report tables.

Raw values are counted before they are cleaned, so the regular expressions run once per
distinct value; whatever follows the first aggregation works on small tables.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import NOT_DATES, as_col, to_date, week_of_year
from ..functions.text import clean_str, matching, thousands
from ..plans.sizing import bounded_rows, broadcast_if_small, materialise
from .clean import Cleaning, final_clean
from .derive import EPISODE_DATES, EPISODE_LABELS, episode_date, episode_type

# Fixed value: how the summary prints a missing value.
MISSING_LABEL = "NULL or BLANK STRING"

# Width of the occupancy bitmap aggregate.
_BITS = 32768

# Of so many classes of raw texts, by their hash, one is cleaned for the lower bound of the cleaned values.
_CLASSES = 16

_CONFIRMED_OR_PROBABLE = ["confirmed", "probable"]


def _occupancy(x: Column, where: Column | None = None) -> Column:
    """Occupied hash slots: never more than the number of distinct values; of the rows ``where``, if it is given."""
    slot = F.pmod(F.xxhash64(x), F.lit(_BITS))
    # rows without a slot are passed over
    return F.bitmap_count(F.bitmap_construct_agg(slot if where is None else F.when(where, slot)))


def few_valued(df: DataFrame, cols: list[str], max_unique: int) -> list[str]:
    """Columns that may have at most ``max_unique`` cleaned values.

    Occupied hash slots are a lower bound of the distinct count, so a column dropped here
    surely has too many values; survivors are counted exactly later. One scan and one global
    aggregate of fixed-size buffers, which returns a single row, so a column of free text never reaches a
    shuffle. Only text is cleaned: cleaning merges numbers in pairs at the most, by their sign. As any of the raw
    values give a lower bound too, only those of one class of hashes are cleaned, which spares most regular expressions.
    """
    if not cols:
        return []
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    raw = [_occupancy(F.col(c)).alias(f"raw_{i}") for i, c in enumerate(cols)]
    chosen = {c: F.pmod(F.hash(F.col(c)), F.lit(_CLASSES)) == 0 for c in text}
    cleaned = [_occupancy(clean_str(c), chosen[c]).alias(f"clean_{i}") for i, c in enumerate(cols) if c in text]
    row = df.agg(*raw, *cleaned).first()

    def few(i: int, c: str) -> bool:
        return row[f"raw_{i}"] <= 2 * max_unique if c not in text else min(row[f"raw_{i}"], row[f"clean_{i}"]) <= max_unique

    return [c for i, c in enumerate(cols) if few(i, c)]


def _shown(x: Column) -> Column:
    return clean_str(x, na_replace=MISSING_LABEL, blank_replace=MISSING_LABEL)


def _day_parts(name: str, day: Column) -> list[tuple[str, Column]]:
    return [(f"{name}_month", F.month(day)), (f"{name}_week", week_of_year(day)), (f"{name}_dow", F.dayofweek(day))]


def _cells(df: DataFrame, strats: list[str], plain: list[str], dates: dict[str, Column]) -> DataFrame:
    """Counts by name, value and strata of the plain columns and of the parts of the dates."""
    # (name, text, number): names travel as their position, numbers as numbers
    parts: list[tuple[str, Column, Column]] = [(c, F.col(c).cast("string"), F.lit(None).cast("int")) for c in plain]
    parts += [(n, F.lit(None).cast("string"), part) for c, day in dates.items() for n, part in _day_parts(c, day)]
    entries = [
        F.struct(F.lit(i).alias("at"), raw.alias("raw"), part.alias("part"))
        for i, (_, raw, part) in enumerate(parts)
    ]
    counted = (
        df.select(*strats, F.explode(F.array(*entries)).alias("e"))
        .groupBy(*strats, "e.at", "e.raw", "e.part")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = F.array(*[F.lit(name) for name, _, _ in parts])
    return (
        counted.withColumn("name", names[F.col("at")])
        .withColumn("value", _shown(F.coalesce(F.col("raw"), F.col("part").cast("string"))))
        .groupBy("name", "value", *strats)
        .agg(F.sum("n").alias("n"))
    )


def _cells_by_part(df: DataFrame, strats: list[str], plain: list[str], dates: dict[str, Column]) -> DataFrame:
    """The same for strata so many that a task which reads the cases meets each of them only a few times.

    The rows of a stratum meet before they become cells, or nearly every cell would be shuffled by itself. Adaptive
    execution splits strata of very many rows, whose cells the second half of the count sums. Dates are counted whole,
    one cell instead of three for a row, and taken apart afterwards.
    """
    cells = [*[F.col(c).cast("string") for c in plain], *[F.unix_date(day).cast("string") for day in dates.values()]]
    named = [f"__c{i}" for i in range(len(cells))]
    if not cells:
        return _cells(df, strats, plain, dates)
    dealt = df.select(*strats, *[c.alias(n) for c, n in zip(cells, named, strict=True)]).hint("rebalance", *[F.col(c) for c in strats])
    counted = dealt.unpivot(strats, named, "at", "raw").groupBy(*strats, "at", "raw").agg(F.count(F.lit(1)).alias("n"))
    at, day = F.substring("at", 4, 9).cast("int"), F.date_from_unix_date(F.col("raw").cast("int"))
    names = F.array(*[F.lit(c) for c in [*plain, *dates]])
    missing = _shown(F.lit(None).cast("string"))
    name = names[at]
    taken_apart = F.array(
        *[
            F.struct(F.concat(name, F.lit(end)).alias("name"), F.coalesce(part.cast("string"), missing).alias("value"))
            for end, part in _day_parts("", day)
        ]
    )
    own = F.array(F.struct(name.alias("name"), _shown(F.col("raw")).alias("value")))
    return (
        counted.select(*strats, "n", F.explode(F.when(at < len(plain), own).otherwise(taken_apart)).alias("e"))
        .groupBy("e.name", "e.value", *strats)
        .agg(F.sum("n").alias("n"))
    )


def summary_counts(
    df: DataFrame, strats: tuple[str, ...] = ("pt", "agegroup10"), *, max_unique: int = 60, by: tuple[str, ...] = ()
) -> DataFrame:
    """Counts of every low-cardinality column by strata, and by columns ``by`` that split the rows in parts.

    Counts of several parts add up in :func:`summary_of`. With ``by``, a column that has too many values has a row
    without a count in each part instead, by which it is left out of the whole as well.
    """
    strats = [*by, *strats]
    dated = matching(df.columns, "date")
    dates = [c for c in dated if c not in matching(dated, NOT_DATES)]
    skip = {"phacid", "ptcaseid", "comments", *strats}
    plain = [
        c for c in df.columns
        if c not in dated and c not in skip and not c.endswith("spec") and "comment" not in c
    ]
    candidates, plain = plain, few_valued(df, plain, max_unique)
    types = {f.name: f.dataType for f in df.schema.fields}

    if by:
        cells = _cells_by_part(df, strats, plain, {c: to_date(F.col(c), types[c]) for c in dates})
    else:
        cells = _cells(df, strats, plain, {c: to_date(F.col(c), types[c]) for c in dates})
    dropped = [c for c in candidates if c not in plain]
    if not by or not dropped:
        return cells
    gone = df.select(*by).distinct().select(*by, F.explode(F.array(*[F.lit(c) for c in dropped])).alias("name"))
    return cells.unionByName(gone, allowMissingColumns=True)


def count_summary(
    df: DataFrame, strats: tuple[str, ...] = ("pt", "agegroup10"), *, max_unique: int = 60
) -> DataFrame:
    """Value counts of every low-cardinality column by strata.

    Date columns are replaced by their month, week and weekday, which have few values: the
    partial counts of a task stay small however many days or cases it sees.
    """
    return summary_of(summary_counts(df, strats, max_unique=max_unique), strats, max_unique=max_unique)


def summary_of(
    counts: DataFrame, strats: tuple[str, ...] = ("pt", "agegroup10"), *, max_unique: int = 60, merge: bool = False
) -> DataFrame:
    """The count summary from :func:`summary_counts`; with ``merge`` from those of several parts."""
    strats = list(strats)
    if merge:
        gone = counts.where("n IS NULL").select("name").distinct()
        counts = counts.join(F.broadcast(gone), "name", "left_anti").groupBy("name", "value", *strats).agg(F.sum("n").alias("n"))
    # small and read several times from here on: the cases are not scanned again
    cells = materialise(counts)

    # at most one row per reported column, so this side is bounded by the schema
    few = (
        cells.select("name", "value").distinct()
        .groupBy("name").agg(F.count(F.lit(1)).alias("values"))
        .where(F.col("values") <= max_unique).select("name")
    )
    cells = cells.join(F.broadcast(few), "name")

    def total(*keys: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*keys))

    out = cells.withColumn("n_all_strats", total("name", *strats))
    out = out.withColumn("f_all_strats", F.col("n") / F.col("n_all_strats"))
    for s in strats:
        out = out.withColumn(f"n_{s}", total("name", "value", s)).withColumn(f"d_{s}", total("name", s))
        out = out.withColumn(f"f_{s}", F.col(f"n_{s}") / F.col(f"d_{s}"))
    lead = ["name", "value", *strats, "n", "n_all_strats", "f_all_strats"]
    return out.select(*lead, *[f"{p}_{s}" for s in strats for p in ("n", "d", "f")])


def _missing(c: str) -> Column:
    return F.col(c).isNull() | (F.length(F.col(c).cast("string")) == 0)


# Fixed value: the name under which the configuration cleans this report.
COMPLETENESS = "Completness"


def completeness_counts(
    df: DataFrame, *, region: str = "pt", skip: tuple[str, ...] = ("phacid",), only_classified: bool = True,
    config: Iterable[Cleaning] = (), by: tuple[str, ...] = (),
) -> DataFrame:
    """Empty cells and rows per column and region, and by columns ``by`` that split the rows in parts; these add up."""
    if only_classified:
        df = df.where(F.lower("classification").isin(_CONFIRMED_OR_PROBABLE))
    df = final_clean(df, COMPLETENESS, df.columns, config)
    cols = [c for c in df.columns if c != region and c not in skip and c not in by]
    wide = df.groupBy(*by, region).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.sum(F.when(_missing(c), 1).otherwise(0)).alias(f"m_{i}") for i, c in enumerate(cols)],
    )
    cells = F.array(
        *[F.struct(F.lit(c).alias("colnm"), F.col(f"m_{i}").alias("no_data")) for i, c in enumerate(cols)]
    )
    return wide.select(*by, region, "total", F.explode(cells).alias("e")).select(*by, "e.colnm", region, "e.no_data", "total")


def completeness_of(counts: DataFrame, *, region: str = "pt", merge: bool = False) -> DataFrame:
    """Completeness from :func:`completeness_counts`; with ``merge`` from those of several parts."""
    if merge:
        counts = counts.groupBy("colnm", region).agg(F.sum("no_data").alias("no_data"), F.sum("total").alias("total"))
    has = F.col("total") - F.col("no_data")
    return counts.select("colnm", region, has.alias("has_data"), "no_data", "total", (has / F.col("total")).alias("fraction_complete"))


def completeness(
    df: DataFrame, *, region: str = "pt", skip: tuple[str, ...] = ("phacid",), only_classified: bool = True,
    config: Iterable[Cleaning] = (),
) -> DataFrame:
    """Filled and empty cells per column and region: one aggregation, then a reshape.

    Cells are cleaned as the report's configuration says before they are tested, so a lone full stop is no data
    where punctuation is removed. Column names come out in lower case.
    """
    counts = completeness_counts(df, region=region, skip=skip, only_classified=only_classified, config=config)
    return completeness_of(counts, region=region)


def completeness_wide(
    df: DataFrame, levels: list[str] | None = None, *, region: str = "pt", max_levels: int = 1000, **kw
) -> DataFrame:
    """One row per column, four columns per region.

    Without ``levels`` the regions are those of the long form, which is written out before the call returns, as any
    pivot needs them by name; each becomes four columns, so more than ``max_levels`` are an error.
    """
    long = completeness(df, region=region, **kw)
    if levels is None:
        long = materialise(long)
        found = bounded_rows(long.select(region).where(F.col(region).isNotNull()).distinct(), max_levels, "regions")
        levels = sorted(r[0] for r in found)
    measures = ["has_data", "no_data", "total", "fraction_complete"]
    picked = [
        F.max(F.when(F.col(region) == lv, F.col(m))).alias(f"{m}_{lv}") for m in measures for lv in levels
    ]
    return long.groupBy("colnm").agg(*picked)


def daily_headline(df: DataFrame, *, asof) -> DataFrame:
    """Case and death totals with the sentence that reports them."""
    kept = df.where(F.lower("classification").isin(_CONFIRMED_OR_PROBABLE))
    out = kept.agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.count(F.when(F.lower("coviddeath") == "yes", 1)).alias("n_deaths"),
    )
    day = as_col(asof)
    sentence = F.concat(
        F.lit("Total Confirmed & Probable cases in database on "), day.cast("string"),
        F.lit(" EOD is '"), thousands("n_cases"), F.lit("' while Deaths are '"), thousands("n_deaths"),
        F.lit("'"),
    )
    return out.select(day.alias("asof"), "n_cases", "n_deaths", sentence.alias("message"))


# Leading and trailing columns of the travel report.
TRAVEL_LEAD = [
    "phacreporteddate", "pt", "ptcaseid", "phacid", "episodedate", "episodetype", "age", "sex",
    "residency", "location", "labspecimencollectiondate1",
]
TRAVEL_TAIL = ["exposure_cat", "classification"]


def recent_travel_cases(
    df: DataFrame, *, asof, reported_days: int = 7, episode_days: int = 14, travel_days: int = 16,
    episode_cols: list[str] = EPISODE_DATES, episode_labels: list[str] = EPISODE_LABELS,
) -> DataFrame:
    """International-travel cases reported lately, with the travel dates that are recent enough.

    Travel dates outside the window become null; a case without any travel date is judged by
    its episode date. Works row by row: nothing is reshaped or shuffled.
    """
    day, report = as_col(asof), F.col("phacreporteddate")
    df = df.where(
        F.lower("classification").isin(_CONFIRMED_OR_PROBABLE)
        & report.between(F.date_sub(day, reported_days), F.date_sub(day, 1))
        & (F.col("exposure_cat") == "International travel")
    ).withColumns(
        {"episodedate": episode_date(episode_cols), "episodetype": episode_type(episode_cols, episode_labels)}
    )
    travel = [c for c in matching(df.columns, "^travel") if c.lower() != "travel"]
    dates = matching(travel, r"date\d$")
    oldest = F.date_sub(report, travel_days)
    recent = {c: F.when(F.col(c) >= oldest, F.col(c)) for c in dates}
    if dates:
        undated = F.coalesce(*dates).isNull()
        meets = F.when(undated, F.col("episodedate") >= oldest).otherwise(
            F.coalesce(*recent.values()).isNotNull()
        )
    else:
        meets = F.col("episodedate") >= oldest
    kept = df.where(
        meets & F.col("episodedate").between(F.date_sub(day, episode_days), F.date_add(day, 1))
    )
    have = {c.lower() for c in df.columns}
    cols = [c for c in [*TRAVEL_LEAD, *travel, *TRAVEL_TAIL] if c.lower() in have]
    return kept.select(*[recent[c].alias(c) if c in recent else F.col(c) for c in cols])


def missing_fraction(df: DataFrame, cols: list[str]) -> DataFrame:
    """Share of nulls per column, largest first, columns without nulls left out."""
    row = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols],
    )
    cells = F.array(*[F.struct(F.lit(c).alias("colnm"), F.col(c).alias("n")) for c in cols])
    return (
        row.select("__rows", F.explode(cells).alias("e"))
        .where("e.n > 0")
        .select("e.colnm", (F.col("e.n") / F.col("__rows")).alias("missing_fraction"))
        .orderBy(F.desc("missing_fraction"), "colnm")
    )


def onset_month_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("pt", F.month("onsetdate").alias("month_onset"), "exposure_cat").agg(
        F.count(F.lit(1)).alias("n")
    )


def report_delay_hist(df: DataFrame, *, min_cases: int = 1000, low: int = -3, high: int = 21) -> DataFrame:
    """Days from onset to report by region, for regions with enough cases.

    Region sizes count every row. They are summed from the counts per delay, so a large
    region is never gathered into one window.
    """
    known_age = F.coalesce(F.col("agegroup20") != "Unknown", F.lit(False))
    delay = F.datediff("reporteddate", "onsetdate")
    counted = df.groupBy("pt", F.when(known_age, delay).alias("report_delay")).agg(
        F.count(F.lit(1)).alias("n")
    )
    region = F.sum("n").over(Window.partitionBy("pt"))
    return (
        counted.withColumn("region_cases", region)
        .where((F.col("region_cases") >= min_cases) & F.col("report_delay").between(low, high))
        .select("pt", "report_delay", "n")
    )


# Columns that identify a case and are not checked for spellings.
_ID_COLUMNS = ["phacid", "pt", "ptcaseid", "phacreporteddate"]


def suggest_value_fixes(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Cells whose spelling differs from the most frequent spelling of the same cleaned value.

    Spellings are counted once, before the call returns; only the ones to be replaced are joined back, to cells of
    the columns that have any, broadcast when their bytes allow. Of equally frequent spellings the first in order is kept.
    """
    if cols is None:
        cols = [
            f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name.lower() not in _ID_COLUMNS
        ]
    df = df.where(F.lower("classification").isin(_CONFIRMED_OR_PROBABLE))
    cells = F.array(*[F.struct(F.lit(c).alias("varname"), F.col(c).alias("old_value")) for c in cols])
    spelled = (
        df.select(F.explode(cells).alias("e"))
        .groupBy("e.varname", "e.old_value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("cleaned", clean_str("old_value"))
    )
    spelled = materialise(spelled)
    rank = F.struct(-F.col("n"), F.col("old_value").isNull(), "old_value")
    best = (
        spelled.groupBy("varname", "cleaned")
        .agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("spellings"))
        .where("spellings > 1")
        .select("varname", "cleaned", F.col("best.old_value").alias("new_value"))
    )
    fixes = (
        spelled.join(best, ["varname", "cleaned"])
        .where("old_value <> new_value and new_value <> ''")
        .select("varname", "old_value", "new_value")
    )
    fixes = materialise(fixes)
    # one row for each column at the most
    fixed = {r[0] for r in fixes.select("varname").distinct().collect()}
    keep = [c for c in df.columns if c.lower() in _ID_COLUMNS]
    left = F.array(
        *[F.struct(F.lit(c).alias("varname"), F.col(c).alias("old_value")) for c in cols if c in fixed]
    ).cast("array<struct<varname:string,old_value:string>>")
    return (
        df.select(*keep, F.explode(left).alias("e"))
        .select(*keep, "e.varname", "e.old_value")
        .join(broadcast_if_small(fixes), ["varname", "old_value"])
        .select(*keep, "varname", "old_value", "new_value", F.lit("").alias("approved"))
    )
