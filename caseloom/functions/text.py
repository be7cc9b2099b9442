"""Text standardisation as column expressions.

Everything here stays inside whole-stage codegen: no Python runs per row.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The title-cased category words the reports use.
YES = "Yes"
NO = "No"
UNKNOWN = "Unknown"
BLANK = ""
NOT_STATED = "Not Stated"
NA_TEXT = "Na"
DO_NOT = "Do Not"

CaseFn = Callable[[Column], Column]

_EDGE_SPACE = " \t\r\n"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def same(x: Column) -> Column:
    return x


CASE_FUNCTIONS: dict[str, CaseFn] = {
    "str_to_title": F.initcap,
    "str_to_lower": F.lower,
    "str_to_upper": F.upper,
    "str_to_same": same,
}


def squeeze(x: Column) -> Column:
    return F.regexp_replace(x, " {2,}", " ")


def trim_ws(x: Column) -> Column:
    """Trim space, tab, CR and LF; Spark's ``trim`` removes spaces only."""
    return F.btrim(x, F.lit(_EDGE_SPACE))


# Case functions for which applying them twice, or trimming in between, changes nothing.
_IDEMPOTENT = (F.initcap, F.lower, F.upper, same)

PUNCTUATION = r"\p{P}"


def _without_punctuation(c: Column, pattern: str, replacement: str) -> Column:
    if pattern == PUNCTUATION and replacement == " ":
        return F.regexp_replace(c, r"[\p{P} ]+", " ")
    return squeeze(F.regexp_replace(c, pattern, replacement))


def _is_na_text(x: Column, case: CaseFn) -> Column:
    """Whether the case function turns the text into ``Na``."""
    if case in (F.lower, F.upper):
        return F.lit(False)
    return (F.lower(x) == "na") if case is F.initcap else case(x) == NA_TEXT


def clean_str(
    x: Column | str,
    *,
    strip_punct: bool = True,
    pattern: str = PUNCTUATION,
    replacement: str = " ",
    na_replace: str = "",
    blank_replace: str = "",
    case: CaseFn = F.initcap,
    replace_na_text: bool = True,
) -> Column:
    """Standardise free text; never null.

    The literal text ``Na`` is matched before trimming, and a replacement value is itself
    re-cased at the end. The usual settings cost one regular expression and one case change.
    """
    raw = _col(x).cast("string")
    c = _without_punctuation(raw, pattern, replacement) if strip_punct else squeeze(raw)
    if case not in _IDEMPOTENT:
        c = case(c)
    missing = raw.isNull()
    if replace_na_text:
        # a replaced character stays visible in the result, so only raw "na" becomes "na"
        visible = not strip_punct or (replacement and not any(ch.isalpha() for ch in replacement))
        missing = missing | _is_na_text(raw if visible else c, case)
    c = trim_ws(F.when(missing, F.lit(na_replace)).otherwise(c))
    if blank_replace != "":
        c = F.coalesce(F.nullif(c, F.lit("")), F.lit(blank_replace))
    return case(c)


def clean_str_b(
    x: Column | str, *, na_replace: str = "", blank_replace: str = "", case: CaseFn = F.initcap
) -> Column:
    """As :func:`clean_str` but punctuation is kept and case is applied once."""
    c = trim_ws(case(F.coalesce(squeeze(_col(x).cast("string")), F.lit(na_replace))))
    if blank_replace != "":
        c = F.when(c == "", F.lit(blank_replace)).otherwise(c)
    return c


# Answers that mean "nothing recorded".
NOT_RECORDED = ["unknown", "unk", "not asked"]


def clean_up(x: Column | str) -> Column:
    c = F.coalesce(trim_ws(F.lower(_col(x))), F.lit(""))
    return F.when(c.isin(NOT_RECORDED), F.lit("")).otherwise(c)


def number_to_id(x: Column | str, pattern: str = " ", replacement: str = "-") -> Column:
    return F.regexp_replace(_col(x), pattern, replacement)


def insert_str(x: Column | str, s: str = "-", *, after: int) -> Column:
    c = _col(x)
    return F.concat(F.substring(c, 1, after), F.lit(s), c.substr(F.lit(after + 1), F.length(c)))


def na_text(x: Column | str) -> Column:
    """Text for message building, where a missing value prints as ``NA``."""
    return F.coalesce(_col(x).cast("string"), F.lit("NA"))


def thousands(x: Column | str) -> Column:
    return F.format_number(_col(x), 0)


def percent_label(x: Column | str, digits: int = 0) -> Column:
    """``0.417`` to ``42%``; half-way cases round to even, as label formatters do."""
    c = F.bround(_col(x) * 100, digits)
    return F.concat((c.cast("bigint") if digits == 0 else c).cast("string"), F.lit("%"))


def snake_case(name: str) -> str:
    s = name.replace("'", "").replace('"', "").replace("%", "_percent_").replace("#", "_number_")
    s = re.sub(r"[^0-9A-Za-z]+", "_", s)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"_+", "_", s).strip("_").lower()
    return f"x{s}" if not s or s[0].isdigit() else s


def snake_names(names: list[str]) -> list[str]:
    """Snake-case names made unique: the second ``a`` becomes ``a_2``."""
    seen: dict[str, int] = {}
    out = []
    for s in map(snake_case, names):
        seen[s] = seen.get(s, 0) + 1
        out.append(s if seen[s] == 1 else f"{s}_{seen[s]}")
    return out


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*snake_names(df.columns))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def matching(names: list[str], pattern: str, *, ignore_case: bool = True) -> list[str]:
    """Column names matching a pattern, in column order; case is ignored by default."""
    rx = re.compile(pattern, re.IGNORECASE if ignore_case else 0)
    return [n for n in names if rx.search(n)]


def latin1_text(df: DataFrame) -> DataFrame:
    """Text whose bytes are not UTF-8 read as ISO-8859-1, in all text columns; other text stays as it is.

    Old databases store accents in one byte each; every byte is a letter there, so nothing is lost.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(F.is_valid_utf8(c), c).otherwise(F.decode(c.cast("binary"), "ISO-8859-1"))
        out.append(c.alias(f.name))
    return df.select(*out)
