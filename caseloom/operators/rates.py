"""Positivity by age group and region with exact binomial limits.

The cases are read once into counts per (region, age group, value), which are written to the
checkpoint folder; everything after that works on the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binomial import binomial_limits
from ..functions.text import NO, YES, clean_str, clean_up, percent_label, thousands
from ..plans.sizing import materialise

NATIONAL = "CANADA"


def _ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


# The columns charted by age and region, with the value that stands for a missing one.
CHARTED = [("coviddeath", "No"), ("asymptomatic", ""), ("hosp", ""), ("icu", "")]
AGE_GROUPS = ["agegroup20", "agegroup10"]


def _min_age(age_group: Column) -> Column:
    return F.split(age_group, "[^0-9A-Za-z]+")[0].try_cast("int")


def value_counts_batch(
    df: DataFrame, series: list[tuple[str, str, str]], *, region: str = "pt"
) -> DataFrame:
    """Counts by value, region and age group of several (column, age group, missing value) in one scan."""
    entries = [
        F.struct(
            F.lit(column).alias("column"), F.lit(age).alias("age_col"), F.col(age).alias("age_group"),
            F.coalesce(F.col(column), F.lit(na_replace)).alias("nm"),
        )
        for column, age, na_replace in series
    ]
    return (
        df.select(F.col(region).alias("pt"), F.explode(F.array(*entries)).alias("e"))
        .groupBy("e.column", "e.age_col", "pt", "e.age_group", "e.nm")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("min_age", _min_age(F.col("age_group")))
    )


def value_counts_by_age(
    df: DataFrame, column: str, *, age_group: str = "agegroup20", region: str = "pt", na_replace: str = ""
) -> DataFrame:
    """Counts by value, region and age group; ``min_age`` orders the groups."""
    counts = value_counts_batch(df, [(column, age_group, na_replace)], region=region)
    return counts.select("pt", "age_group", "min_age", "nm", "n")


# The columns that tell the series of a batch apart.
SERIES = ["column", "age_col"]


def recorded_by_region(
    counts: DataFrame, *, min_fraction: float = 0.9, min_sample: int = 100, include_canada: bool = True,
    by: list[str] = (),
) -> DataFrame:
    """Regions that record the value often enough; the national row may be kept regardless."""
    sized = counts.groupBy(*by, "pt").agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("is_recorded"), F.col("n")).otherwise(0)).alias("yes")
    )
    out = sized.select(
        *by, "pt",
        (F.col("yes") / F.col("total")).alias("is_recorded_fraction"),
        F.col("yes").cast("double").alias("sample_size"),
    )
    enough = (F.col("is_recorded_fraction") >= min_fraction) & (F.col("sample_size") > min_sample)
    return out.where(enough | (F.col("pt") == NATIONAL) if include_canada else enough)


def recorded_counts(df: DataFrame, series: list[tuple[str, str, str]], **kw) -> DataFrame:
    """Cleaned value counts with a flag for recorded values; one scan, then written out."""
    counts = value_counts_batch(df, series, **kw).withColumn("nm", clean_str(clean_up("nm")))
    counts = counts.groupBy("column", "age_col", "pt", "age_group", "min_age", "nm").agg(F.sum("n").alias("n"))
    return materialise(counts.withColumn("is_recorded", F.col("nm") != ""))


def with_national(counts: DataFrame, by: list[str] = SERIES) -> DataFrame:
    """Counts of each series with the national rows, whose values are Yes for the positive value and No for the rest.

    Yes is positive wherever it occurs, otherwise the most frequent recorded value is. ``by`` names the series.
    """
    sizes = counts.where("is_recorded").groupBy(*by, "nm").agg(F.sum("n").alias("n"))
    best = F.min(F.struct(F.col("nm") != YES, -F.col("n"), "nm"))["nm"]
    # one row for each series that was asked for
    positive = F.broadcast(sizes.groupBy(*by).agg(best.alias("positive")))
    national = (
        counts.join(positive, list(by), "left")
        .withColumn("nm", F.when(F.col("nm") == F.col("positive"), F.lit(YES)).otherwise(F.lit(NO)))
        .groupBy(*by, "nm", "age_group", "min_age", "is_recorded")
        .agg(F.sum("n").alias("n"))
        .withColumn("pt", F.lit(NATIONAL))
    )
    return national.unionByName(counts.select(*national.columns))


def _yes_no(counts: DataFrame, *keys: str) -> DataFrame:
    def total(v: str) -> Column:
        return F.sum(F.when(F.col("nm") == v, F.col("n")).otherwise(0))

    return counts.where("is_recorded").groupBy(*keys).agg(
        total(YES).alias("nm_yes"), total(NO).alias("nm_no")
    )


def exact_binomial_ci(df: DataFrame, x: str, n: str, *, alpha: float = 0.05, digits: int = 6) -> DataFrame:
    """Add mean and exact limits of x out of n, rounded."""
    limits = binomial_limits(alpha)(F.col(x), F.col(n))
    out = df.withColumn("__ci", limits)
    return out.withColumns(
        {
            "mean_ci": _ratio(F.col(x), F.col(n)),
            "lower_ci": F.round(F.nanvl("__ci.lower", F.lit(None)), digits),
            "upper_ci": F.round(F.nanvl("__ci.upper", F.lit(None)), digits),
        }
    ).drop("__ci")


def positivity_batch(
    df: DataFrame,
    series: list[tuple[str, str, str]] | None = None,
    *,
    descriptions: dict[str, str] | None = None,
    min_fraction: float = 0.9,
    min_sample: int = 100,
    include_canada: bool = False,
    alpha: float = 0.05,
) -> DataFrame:
    """Share of positive values by region and age group for several columns and age groupings.

    Regions that record a value too seldom are left out. The cases are read once, before the call returns; what
    follows is one plan over small counts, with the series as a key.
    """
    series = series or [(c, age, na) for c, na in CHARTED for age in AGE_GROUPS]
    names = descriptions or {}
    total = with_national(recorded_counts(df, series))
    kept = recorded_by_region(
        total, min_fraction=min_fraction, min_sample=min_sample, include_canada=include_canada, by=SERIES
    )
    overall = _yes_no(total, *SERIES, "pt").select(
        *SERIES, "pt", _ratio(F.col("nm_yes"), F.col("nm_yes") + F.col("nm_no")).alias("overall")
    )
    named = F.lit(None).cast("string")
    for column in dict.fromkeys(c for c, _, _ in series):
        named = F.when(F.col("column") == column, F.lit(names.get(column, column.upper()))).otherwise(named)
    label = F.concat(
        F.col("pt"), F.lit(" recorded="), percent_label("is_recorded_fraction"),
        F.lit("\n"), named, F.lit("="), percent_label("overall"), F.lit("\nN="), thousands("sample_size"),
    )
    labels = kept.join(overall, [*SERIES, "pt"], "left").select(*SERIES, "pt", label.alias("lbl"))
    by_age = (
        _yes_no(total.where("age_group <> 'Unknown'"), *SERIES, "age_group", "min_age", "pt")
        .join(labels, [*SERIES, "pt"])
        .withColumn("nm_total", F.col("nm_yes") + F.col("nm_no"))
        .withColumn("nm_frac_yes", _ratio(F.col("nm_yes"), F.col("nm_total")))
    )
    out = exact_binomial_ci(by_age, "nm_yes", "nm_total", alpha=alpha)
    span = F.concat(
        F.lit(" ("), percent_label("lower_ci"), F.lit("-"), percent_label("upper_ci"), F.lit(")")
    )
    return out.select(
        *SERIES, "pt", "age_group", "min_age", "nm_yes", "nm_no", "nm_total", "nm_frac_yes", "mean_ci", "lower_ci",
        "upper_ci", span.alias("nm_per_yes"), "lbl",
    )


def positivity_by_age(
    df: DataFrame, column: str, *, description: str | None = None, age_group: str = "agegroup10",
    na_replace: str = "", **kw,
) -> DataFrame:
    """The same for one column and age grouping."""
    names = {column: description} if description else None
    out = positivity_batch(df, [(column, age_group, na_replace)], descriptions=names, **kw)
    return out.drop("column", "age_col")
