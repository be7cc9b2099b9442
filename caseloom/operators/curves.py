"""Epidemic-curve tables: daily counts, lumped facets, rolling means, reporting lag.

The case table is read once into counts per (date, colour, facet); every share, peak and
window is taken over those counts, whose size follows the calendar and not the cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_col
from ..functions.text import UNKNOWN, clean_str
from ..plans.sizing import materialise

CLASSIFICATIONS = ("probable", "confirmed")
OTHER = "Other"
SERIES = ["date_col", "color_col"]

# The columns that colour the usual charts, over the imputed onset date.
CHART_COLORS = ["disposition", "exposure_cat", "asymptomatic2", "agegroup20", "hospstatus"]

# Days until reports of a day are complete, by date column.
REPORTING_LAG = {"phacreporteddate": 0, "reporteddate": 3}
DEFAULT_LAG = 14


def lump_rare(counts: DataFrame, level: str, by: list[str], min_share: float, n: str = "n") -> DataFrame:
    """Rename levels with at most ``min_share`` of the rows of a group to ``Other``.

    A single rare level is left alone, and a null level stays null. ``counts`` is an aggregate: with groups all of
    it happens in windows over one exchange by the group.
    """
    x = F.col(level)
    if by:
        whole = Window.partitionBy(*by)
        sized = counts.withColumn("__n", F.sum(n).over(Window.partitionBy(*by, level))).withColumn("__total", F.sum(n).over(whole))
        rare = F.when(x.isNotNull() & (F.col("__n") / F.col("__total") <= min_share), x)
        several = sized.withColumn("__rare", rare).withColumn("__several", F.size(F.collect_set("__rare").over(whole)) > 1)
        lumped = F.when(F.col("__several") & F.col("__rare").isNotNull(), F.lit(OTHER)).otherwise(x)
        return several.select(*[c for c in counts.columns if c != level], lumped.alias(level))
    sizes = counts.groupBy(level).agg(F.sum(n).alias("__n"))
    shares = sizes.withColumn("__total", sizes.agg(F.sum("__n").alias("t")).select("t").scalar())
    rare = shares.where(x.isNotNull() & (F.col("__n") / F.col("__total") <= min_share))
    number = rare.agg(F.count(F.lit(1)).alias("__rare"))
    several = rare.where(number.select("__rare").scalar() > 1).select(x.alias("__level"))
    joined = counts.alias("c").join(several.alias("r"), F.col(f"c.{level}") == F.col("r.__level"), "left")
    lumped = F.when(F.col("r.__level").isNotNull(), F.lit(OTHER)).otherwise(F.col(f"c.{level}"))
    return joined.select(*[F.col(f"c.{c}") for c in counts.columns if c != level], lumped.alias(level))


def curve_parts(
    df: DataFrame, pairs: list[tuple[str, str]] | None = None, *, facet: str = "pt",
    classifications: tuple[str, ...] | None = CLASSIFICATIONS, by: tuple[str, ...] = (),
) -> DataFrame:
    """Counts per (series, date, cleaned colour, facet) for several series in one scan; ``by`` splits them in parts.

    Counts of several parts add up in :func:`curve_of`.
    """
    pairs = pairs or [("onsetdate_imputed", c) for c in CHART_COLORS]
    if classifications is not None:
        df = df.where(F.lower("classification").isin(*classifications))
    entries = [
        F.when(
            F.col(d).isNotNull(),
            F.struct(
                F.lit(d).alias("date_col"), F.lit(c).alias("color_col"),
                F.col(d).cast("date").alias("date"), F.col(c).cast("string").alias("raw"),
            ),
        )
        for d, c in pairs
    ]
    keys = [*by, *SERIES, "date", "facet"]
    return (
        df.select(*by, F.col(facet).alias("facet"), F.explode(F.array_compact(F.array(*entries))).alias("e"))
        .groupBy(*by, "facet", "e.date_col", "e.color_col", "e.date", "e.raw")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("color", clean_str("raw", blank_replace=UNKNOWN))
        .groupBy(*keys, "color")
        .agg(F.sum("n").alias("n"))
    )


def curve_counts_batch(
    df: DataFrame,
    pairs: list[tuple[str, str]] | None = None,
    *,
    facet: str = "pt",
    classifications: tuple[str, ...] | None = CLASSIFICATIONS,
    min_share: float = 0.02,
) -> DataFrame:
    """Counts per series, date, facet (rare ones lumped) and colour of several (date, colour) pairs.

    One scan of the cases, whose counts are written out before the call returns.
    """
    return curve_of(curve_parts(df, pairs, facet=facet, classifications=classifications), min_share=min_share)


def curve_of(counts: DataFrame, *, min_share: float = 0.02) -> DataFrame:
    """Curve counts, rare facets lumped, from :func:`curve_parts` of one or several parts."""
    lumped = lump_rare(materialise(counts), "facet", SERIES, min_share)
    return lumped.groupBy(*SERIES, "date", "facet", "color").agg(F.sum("n").alias("n"))


def with_shares(cells: DataFrame) -> DataFrame:
    """Add totals, shares and peaks to curve counts, by windows over the exchange of the series."""
    n, whole = F.col("n"), Window.partitionBy(*SERIES)
    color, facet = Window.partitionBy(*SERIES, "color"), Window.partitionBy(*SERIES, "facet")
    out = cells.withColumn("total", F.sum(n).over(whole))
    out = out.withColumn("color_percent", 100 * F.sum(n).over(color) / F.col("total"))
    out = out.withColumns({"facet_total": F.sum(n).over(facet), "facet_max": F.max(n).over(facet)})
    out = out.withColumn("facet_percent", 100 * F.col("facet_total") / F.col("total"))
    return out.select(
        *SERIES, "date", "color", "facet", "n", "total", "color_percent", "facet_percent", "facet_max",
        "facet_total",
    )


def epi_curve_batch(
    df: DataFrame, pairs: list[tuple[str, str]] | None = None, *, since: object | None = None, **kw
) -> DataFrame:
    """Epi-curve counts with shares of several (date, colour) pairs from one scan of the cases.

    Shares and peaks are those of the whole period; ``since`` only trims the rows shown.
    """
    out = with_shares(curve_counts_batch(df, pairs, **kw))
    return out if since is None else out.where(F.col("date") >= as_col(since))


def curve_counts(df: DataFrame, date_col: str, color_col: str, **kw) -> DataFrame:
    """Counts of one series: what rolling means and shares of a day need."""
    return curve_counts_batch(df, [(date_col, color_col)], **kw).drop(*SERIES)


def epi_curve_counts(df: DataFrame, date_col: str, color_col: str, **kw) -> DataFrame:
    return epi_curve_batch(df, [(date_col, color_col)], **kw).drop(*SERIES)


def two_digits(x: Column) -> Column:
    """A percentage with two significant digits and no trailing zeros: ``33``, ``5.7``, ``0.12``, ``100``."""
    out = F.round(x, 0).cast("bigint").cast("string")
    # the digit count is that of the rounded number: 9.96 prints as 10
    for limit, places in ((9.95, 1), (0.995, 2), (0.0995, 3), (0.00995, 4), (0.000995, 5)):
        short = F.round(x, places).cast(f"decimal(12,{places})").cast("string")
        out = F.when(x < limit, F.regexp_replace(short, r"\.?0+$", "")).otherwise(out)
    return F.when(x == 0, F.lit("0")).otherwise(out)


def with_labels(curve: DataFrame) -> DataFrame:
    """Add the colour and facet captions; percent, peak and total are part of the text."""
    color = F.concat("color", F.lit(" ("), two_digits(F.col("color_percent")), F.lit("%)"))
    facet = F.concat(
        "facet", F.lit("\n"), two_digits(F.col("facet_percent")),
        F.lit("%\nPeak:"), F.format_number("facet_max", 0),
        F.lit("\nTotal:"), F.format_number("facet_total", 0),
    )
    return curve.withColumns({"color_lbl": color, "facet_lbl": facet})


def rolling_mean(
    counts: DataFrame, *, days: int = 7, normalise: bool = False, since: object | None = None,
    by: list[str] = (),
) -> DataFrame:
    """Mean of the last ``days`` rows per facet, null until there are that many.

    With ``normalise`` counts and means are divided by their maximum in the facet. The
    trimming by ``since`` comes last, so the first shown days have full windows. ``by`` names the
    series columns of a batch.
    """
    keys = [*by, "facet"]
    daily = counts.groupBy(*keys, "date").agg(F.sum("n").alias("n"))
    back = Window.partitionBy(*keys).orderBy("date").rowsBetween(1 - days, 0)
    mean = F.when(F.count("n").over(back) == days, F.avg("n").over(back))
    out = daily.withColumn("roll_mean", mean)
    if normalise:
        whole = Window.partitionBy(*keys)
        out = out.withColumns(
            {
                "roll_mean": F.col("roll_mean") / F.max("roll_mean").over(whole),
                "n": F.col("n") / F.max("n").over(whole),
            }
        )
    return out if since is None else out.where(F.col("date") >= as_col(since))


def percent_fill(counts: DataFrame, *, by: list[str] = ()) -> DataFrame:
    """Share of each colour in the counts of its day and facet."""
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by, "date", "facet")))


def six_months_before(asof: object) -> Column:
    return F.add_months(as_col(asof), -6)


def reporting_lag_ribbon(
    df: DataFrame, date_col: str, color_col: str, *, asof: object, facet: str = "pt",
    report_col: str = "phacreporteddate", min_share: float = 0.02,
) -> DataFrame:
    """Days whose counts are still incomplete, per facet, with the height of the ribbon.

    The ribbon runs from the last report date less the usual lag to the last day shown. A facet
    whose start lies after that day has no ribbon.
    """
    since = six_months_before(asof)
    reported = df.groupBy(F.col(facet).alias("facet")).agg(
        F.count(F.lit(1)).alias("n"), F.max(report_col).alias("last_report")
    )
    reported = lump_rare(materialise(reported), "facet", [], min_share)
    lag = REPORTING_LAG.get(date_col.lower(), DEFAULT_LAG)
    start = reported.where("facet is not null").groupBy("facet").agg(
        F.date_sub(F.max("last_report"), lag).alias("start")
    )
    curve = curve_counts(df, date_col, color_col, facet=facet, min_share=min_share).where(F.col("date") >= since)
    daily = materialise(curve.groupBy("date", "facet").agg(F.sum("n").alias("n")))
    peak = daily.groupBy("facet").agg(F.max("n").cast("long").alias("ymax"))
    last = daily.agg(F.max("date").alias("last_day")).select("last_day").scalar()
    days = start.join(peak, "facet").withColumn("last_day", last).where("start <= last_day")
    return days.select(
        "facet",
        F.explode(F.sequence("start", "last_day", F.expr("interval 1 day"))).alias("date"),
        F.lit(0).cast("long").alias("ymin"),
        "ymax",
    )
