"""Derived case columns.

Each function returns a column expression; none shuffles. Families of columns
(``sym*``, ``rf*``, ``travel*``) are found in the schema.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.categories import clean_categorical, clean_yes_no, lookup
from ..functions.text import NO, NOT_STATED, UNKNOWN, YES, clean_str, matching, squeeze

# The dates an episode is dated by, in order, and their labels.
EPISODE_DATES = ["onsetdate", "earliestlabcollectiondate", "earliestlabtestresultdate"]
EPISODE_LABELS = ["Onset date", "Lab specimen collection date", "Lab test result date"]

SYMPTOM_PATTERN = r"^sym.*(?<!spec)$"
RISK_PATTERN = r"^rf.*(?<!spec)$"
TRAVEL_COUNTRY_PATTERN = r"^(travelfromcountry|traveltocountry)\d"

EPOCH = dt.date(1970, 1, 1)


def _yn(name: str) -> Column:
    return clean_yes_no(name)


def first_good_value(cols: list[str], bad_value: object = 0) -> Column:
    """First value that is neither null nor bad; with none, the last column as it is."""
    *head, last = cols
    good = [F.when(F.col(c) != F.lit(bad_value), F.col(c)) for c in head]
    return F.coalesce(*good, F.when(F.col(last) != F.lit(bad_value), F.col(last)), F.col(last))


def first_good_label(cols: list[str], labels: list[str]) -> Column:
    """Label of the first column that holds a value, else an empty string."""
    out = F.lit("")
    for c, label in reversed(list(zip(cols, labels, strict=True))):
        v = F.col(c).cast("string")
        out = F.when(v != "", F.lit(label)).otherwise(out)
    return out


def episode_date(cols: list[str] = EPISODE_DATES) -> Column:
    return first_good_value(cols, EPOCH)


def episode_type(cols: list[str] = EPISODE_DATES, labels: list[str] = EPISODE_LABELS) -> Column:
    return first_good_label(cols, labels)


def _intensive_care() -> Column:
    return (
        (_yn("icu") == YES)
        | F.col("icustartdate").isNotNull()
        | (_yn("mechanicalvent") == YES)
        | F.col("ventstartdate").isNotNull()
    )


def _in_hospital() -> Column:
    return (_yn("hosp") == YES) | F.col("hospstartdate").isNotNull()


def hosp_status() -> Column:
    return (
        F.when(_intensive_care(), F.lit("Hospitalized - ICU"))
        .when(_in_hospital(), F.lit("Hospitalized - non-ICU"))
        .when(_yn("hosp") == NO, F.lit("Not hospitalized"))
        .otherwise(F.lit(UNKNOWN))
    )


def hospitalized() -> Column:
    return (
        F.when(_intensive_care() | _in_hospital(), F.lit(YES))
        .when(_yn("hosp") == NO, F.lit(NO))
        .otherwise(F.lit(UNKNOWN))
    )


def icu_flag() -> Column:
    return (
        F.when(_intensive_care(), F.lit(YES))
        .when(_yn("icu") == NO, F.lit(NO))
        .otherwise(F.lit(UNKNOWN))
    )


def indigenous_group_flag(name: str = "indigenousgroup") -> Column:
    words = squeeze(F.regexp_replace(F.col(name), r"[^\p{L}\p{N}]", " "))
    return F.coalesce(words.rlike("(?i)First Nation|Inuit|Metis"), F.lit(False))


def indigenous2() -> Column:
    own = clean_str("indigenous")
    return F.when((own == YES) | indigenous_group_flag(), F.lit(YES)).otherwise(own)


def _count(conds: list[Column]) -> Column:
    ones = [F.when(c, F.lit(1)).otherwise(F.lit(0)) for c in conds]
    return reduce(lambda a, b: a + b, ones, F.lit(0))


def comorbidity_columns(df: DataFrame, pattern: str = RISK_PATTERN) -> dict[str, Column]:
    cols = matching(df.columns, pattern)
    n_yes = _count([_yn(c) == YES for c in cols])
    n_no = _count([_yn(c) == NO for c in cols])
    any_yes, all_no = n_yes >= 1, n_no >= len(cols)
    return {
        "comorbidityyes": F.when(any_yes, F.lit(YES)).otherwise(F.lit("")),
        "comorbidityno": F.when(all_no, F.lit(NO)).otherwise(F.lit("")),
        "countrf": n_yes.cast("double"),
        "comorbidity": F.when(any_yes, F.lit(YES)).when(all_no, F.lit(NO)).otherwise(F.lit(UNKNOWN)),
    }


def asymptomatic_columns(df: DataFrame, pattern: str = SYMPTOM_PATTERN) -> dict[str, Column]:
    cols = matching(df.columns, pattern)
    absent = [
        (_yn(c) == NO) | (_yn(c) == UNKNOWN if c.lower() == "symother" else F.lit(False)) for c in cols
    ]
    all_absent = _count(absent) >= len(cols)
    any_present = _count([_yn(c) == YES for c in cols]) >= 1
    none_known = _count([_yn(c).isin(YES, NO) for c in cols]) == 0
    stated = (_yn("asymptomatic") == YES) & none_known
    return {
        "asymptomaticyes1": F.when(all_absent, F.lit(YES)).otherwise(F.lit("")),
        "asymptomaticno": F.when(any_present, F.lit(NO)).otherwise(F.lit("")),
        "symptomsmissing": F.when(none_known, F.lit(YES)).otherwise(F.lit("")),
        "asymptomaticyes": F.when(stated, F.lit(YES)).otherwise(F.lit("")),
        "asymptomatic2": F.when(stated | all_absent, F.lit(YES))
        .when(any_present, F.lit(NO))
        .otherwise(F.lit(UNKNOWN)),
    }


def asymptomatic2(df: DataFrame) -> Column:
    return asymptomatic_columns(df)["asymptomatic2"]


def death_flag() -> Column:
    unclear = dict.fromkeys(["Deceased", "", UNKNOWN], UNKNOWN)
    return F.when(_yn("coviddeath") == YES, F.lit(YES)).otherwise(lookup("disposition", unclear, NO))


def sex2() -> Column:
    return clean_categorical("sex", ["Female", "Male", "Other"], bad_value_replace=NOT_STATED)


def occupation2() -> Column:
    return clean_str("occupationspec", blank_replace=NOT_STATED)


def _stated_yes_no(name: str) -> Column:
    return clean_categorical(name, [YES, NO, UNKNOWN], bad_value_replace=NOT_STATED)


def healthcare_worker2() -> Column:
    return _stated_yes_no("healthcare_worker")


def ltc_resident2() -> Column:
    return _stated_yes_no("ltc_resident")


def onset_date_text() -> Column:
    return clean_str("onsetdate", na_replace=NOT_STATED, replacement="-")


# Disposition as reported, and its summary value.
DISPOSITION_MAP = {
    "Ill": "Stable",
    "Self Isolation": "Stable",
    "Stable": "Stable",
    "Not Reported": "Unknown",
    "Other": "Unknown",
    "Pending": "Unknown",
    "": "Unknown",
    "Recovered": "Recovered",
    "Deceased": "Deceased",
}


def disposition2() -> Column:
    """Nine fixed values need no lookup join; anything unmapped is null."""
    return lookup("disposition", DISPOSITION_MAP)


def recovery_date2() -> Column:
    return F.when(disposition2() == "Recovered", F.col("recoverydate"))


def exposure_country(
    df: DataFrame,
    pattern: str = TRAVEL_COUNTRY_PATTERN,
    *,
    ignored: tuple[str, ...] = ("Canada", ""),
    sep: str = " ",
) -> Column:
    cols = matching(df.columns, pattern)
    if not cols:
        return F.lit("")
    cleaned = F.array(*[F.when(F.col(c).isNotNull(), clean_str(c)) for c in cols])
    kept = F.filter(cleaned, lambda v: v.isNotNull() & ~v.isin(*ignored))
    return F.array_join(F.array_distinct(kept), sep)


def exposure_cat2() -> Column:
    domestic = F.lower("exposure_cat").contains("domestic")
    return F.when(domestic, F.lit("Domestic acquisition")).otherwise(
        clean_str("exposure_cat", blank_replace="Missing")
    )


def age_group10(age: str = "age", group: str = "agegrouping") -> Column:
    """Ten-year bands from the exact age, else from the reported group.

    The first band also covers everything below twenty.
    """
    out = F.when((F.col(age) <= 19) | (F.col(group) == "0-19"), F.lit("0 to 19"))
    for low in range(20, 80, 10):
        hit = (F.col(age) <= low + 9) | (F.col(group) == f"{low}-{low + 9}")
        out = out.when(hit, F.lit(f"{low} to {low + 9}"))
    return out.when((F.col(age) >= 80) | (F.col(group) == "80+"), F.lit("80 or plus")).otherwise(
        F.lit("unknown")
    )
