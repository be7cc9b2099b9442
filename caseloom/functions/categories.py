"""Mapping of messy categories to a closed set of values."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import BLANK, NO, UNKNOWN, YES, clean_str


def clean_constant(s: str) -> str:
    """The driver-side twin of ``clean_str`` for a value given by the caller."""
    if s.lower() == "na":
        return ""
    s = "".join(" " if unicodedata.category(ch).startswith("P") else ch for ch in s)
    return " ".join(w.capitalize() for w in s.split())


def lookup(x: Column | str, mapping: dict[str, str], default: str | None = None) -> Column:
    """Map cleaned values to others.

    Most cells hold a listed value as it stands but for case; they are matched without any
    regular expression, and only the others are cleaned.
    """
    raw = (F.col(x) if isinstance(x, str) else x).cast("string")
    low = F.lower(raw)
    slow = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    rest = F.coalesce(F.try_element_at(slow, clean_str(raw)), F.lit(default).cast("string"))
    plain = {k: v for k, v in mapping.items() if k != "Na"}
    out = F.when(raw.isNull(), F.lit(mapping.get("", default)).cast("string"))
    for value in dict.fromkeys(plain.values()):
        keys = [k.lower() for k, v in plain.items() if v == value]
        out = out.when(low.isin(keys), F.lit(value))
    return out.otherwise(rest)


def clean_categorical(
    x: Column | str,
    good_vals: list[str],
    *,
    other_replace: str = UNKNOWN,
    bad_value_replace: str = BLANK,
    bad_value: str = "",
) -> Column:
    blank_to, bad = clean_constant(bad_value_replace), clean_constant(bad_value)
    mapping = {v: v for v in [*map(clean_constant, good_vals), blank_to]} | {bad: blank_to}
    return lookup(x, mapping, clean_constant(other_replace))


def clean_yes_no(x: Column | str, *, map_yn: bool = False, **kw) -> Column:
    """Yes / No / Unknown, with blank kept.

    ``y`` and ``n`` become Unknown unless ``map_yn`` is set.
    """
    if map_yn:
        x = lookup(x, {"Y": YES, "N": NO, YES: YES, NO: NO, "": ""}, UNKNOWN)
    return clean_categorical(x, [YES, NO], **kw)


def top_values(df: DataFrame, x: Column | str, n: int) -> DataFrame:
    """The n most frequent cleaned values: partial counts, then a distributed top-n.

    Raw spellings are counted before they are cleaned, so the regular
    expressions run once per spelling and not once per row.
    """
    x = F.col(x) if isinstance(x, str) else x
    raw = df.groupBy(x.alias("raw")).agg(F.count(F.lit(1)).alias("n"))
    return (
        raw.groupBy(clean_str("raw").alias("value"))
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), F.asc("value"))
        .limit(n)
    )


def clean_categorical_top_n(df: DataFrame, column: str, n: int = 1, *, out: str | None = None) -> DataFrame:
    """Keep the n most frequent values of a column, the rest become Unknown.

    The broadcast side is exactly n rows by construction.
    """
    top = F.broadcast(top_values(df, column, n).select(F.col("value").alias("__top")))
    c = clean_str(column)
    kept = F.when((c == "") | F.col("__top").isNotNull(), c).otherwise(F.lit(UNKNOWN))
    return df.join(top, c == F.col("__top"), "left").withColumn(out or column, kept).drop("__top")
