"""Configured cleaning and projection jobs: each is a single select."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import (
    CASE_FUNCTIONS,
    DO_NOT,
    YES,
    clean_str_b,
    matching,
    number_to_id,
    same,
    squeeze,
    trim_ws,
)

_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Cleaning:
    """How one report cleans one column; a row of the ``input`` configuration."""

    report: str
    col_nm: str
    clean_it: str = YES
    punct_replace: str = " "
    na_blank_replace: str = ""
    case_standard: str = ""

    @property
    def active(self) -> bool:
        return (self.clean_it or "").strip().title() == YES


def report_columns(config: Iterable[Cleaning], report: str) -> list[str]:
    """Ordered column list of a report."""
    return [c.col_nm for c in config if c.report == report]


def select_report(df: DataFrame, config: Iterable[Cleaning], report: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c.lower()) for c in report_columns(config, report)])


def _clean(x: Column, how: Cleaning) -> Column:
    fill = F.lit((how.na_blank_replace or "").strip())
    punct = (how.punct_replace or "").strip()
    if punct != DO_NOT:
        x = F.regexp_replace(x, r"\p{Punct}", re.sub(r"([\\$])", r"\\\1", punct))
    x = F.when(x.isNull() | (x == ""), fill).otherwise(x)
    case = CASE_FUNCTIONS.get((how.case_standard or "").strip(), same)
    return trim_ws(case(squeeze(x)))


def final_clean(
    df: DataFrame, report: str, cols: list[str], config: Iterable[Cleaning] = ()
) -> DataFrame:
    """Clean the configured text columns, turn timestamps into dates, lower the names, select."""
    how: dict[str, Cleaning] = {}
    for c in config:
        if c.report == report and c.active:
            how.setdefault(c.col_nm.lower(), c)
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    out = []
    for name in (c.lower() for c in cols):
        x = F.col(name)
        if isinstance(types[name], T.StringType) and name in how:
            x = _clean(x, how[name])
        elif isinstance(types[name], _TIMESTAMPS):
            x = x.cast("date")
        out.append(x.alias(name))
    return df.select(*out)


# Column lists of the published reports.
IDENTIFIER_COLUMNS = [
    "pt", "phacid", "healthcare_worker2", "phacreporteddate", "reporteddate", "onsetdate",
    "earliestlabcollectiondate", "earliestlabtestresultdate",
]
RETIRED_COLUMNS = ["mincontactcaseid"]
TREND_COLUMNS = [
    "phacid", "phacreporteddate", "episodedate", "pt", "age_years", "agegroup10", "agegroup20",
    "onsetdate", "earliestlabcollectiondate", "sex", "gender", "sexgender", "coviddeath", "hosp",
    "icu", "exposure_cat", "earliestdate", "earliestdatetype",
]
TREND_VARIANT_COLUMNS = [
    *TREND_COLUMNS, "variantid", "variantidentified", "variantscreenresult", "variantsequenceresult",
]
WEB_COLUMNS = [
    "phacid", "episodedate", "episodetype", "sex_excunk", "exposure_cat", "agegroup10",
    "mechanicalvent", "hospstatus", "coviddeath", "pt", "earliestdate", "earliestdatetype",
    "last_refreshed",
]
WEEKLY_COLUMNS = [
    "phacid", "ptcaseid", "phacreporteddate", "classification", "pt", "episodedate", "earliestdate",
    "earliestdatetype", "age", "ageunit", "agegroup10", "agegroup20", "sexgender", "exposure_cat",
    "exposurecountry", "hospstatus", "coviddeath", "disposition", "last_refreshed",
]
DATA_HUB_COLUMNS = [
    "phacid", "pt", "episodedate", "classification", "sexgender2", "agegroup10", "age", "occupation2",
    "healthcare_worker2", "ltc_resident", "asymptomatic2", "onsetdate", "reporteddate", "symcough",
    "symfever", "symchills", "symsorethroat", "symrunnynose", "symshortnessofbreath", "symnausea",
    "symheadache", "symweakness", "sympain", "symirritability", "symdiarrhea", "symother",
    "symotherspec", "hospstatus", "disposition2", "resolutiondate2", "exposure_cat2",
]


def drop_identifiers(df: DataFrame) -> DataFrame:
    return df.drop(*IDENTIFIER_COLUMNS)


def drop_retired(df: DataFrame) -> DataFrame:
    return df.drop(*RETIRED_COLUMNS)


def keep_trend_cols(df: DataFrame) -> DataFrame:
    return df.select(*TREND_COLUMNS)


def keep_trend_variant_cols(df: DataFrame) -> DataFrame:
    return df.select(*TREND_VARIANT_COLUMNS)


def keep_web_cols(df: DataFrame) -> DataFrame:
    return df.select(*WEB_COLUMNS)


def keep_weekly_cols(df: DataFrame) -> DataFrame:
    return df.select(*WEEKLY_COLUMNS)


def one_time_clean(df: DataFrame, *, id_col: str = "phacid", region: str = "pt") -> DataFrame:
    """Lower-case text, dashed ids, upper-case regions, dates as text; column order is kept."""
    dates = set(matching(df.columns, "date"))
    out = []
    for f in df.schema.fields:
        x = F.col(f.name)
        if isinstance(f.dataType, T.StringType) and f.name not in dates:
            x = clean_str_b(x, case=F.lower)
            if f.name.lower() == id_col:
                x = number_to_id(x)
            elif f.name.lower() == region:
                x = F.upper(x)
        elif isinstance(f.dataType, (T.DateType, *_TIMESTAMPS)):
            x = F.date_format(x, "yyyy-MM-dd")
        out.append(x.alias(f.name))
    return df.select(*out)
