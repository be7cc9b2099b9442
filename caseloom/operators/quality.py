"""Data-quality rules and the long error report.

A rule is a condition and a message over one row. The report evaluates all rules in a
single projection and explodes the hits, so it costs one scan and one sort whatever
the number of rules. This equals the union of the single rules joined back by id
while the id is unique (see ``plans.sizing.assert_unique``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import NOT_DATES, as_col, date_columns
from ..functions.text import clean_str, matching, na_text
from ..plans.session import small_methods
from ..plans.sizing import assert_unique
from .derive import episode_date

Hit = tuple[Column, Column]


@dataclass(frozen=True)
class Rule:
    """``hits`` gives the (condition, message) pairs the rule checks on one row."""

    name: str
    typ: str
    hits: Callable[[DataFrame], list[Hit]]
    default: bool = True


@dataclass(frozen=True)
class Wording:
    """Column, value and texts of the happy outcome, which the two source layouts name differently."""

    date: str
    value: str
    listed: str
    listed_typ: str
    both: str
    early: str
    early_typ: str
    blank_unit: bool
    disposition: str
    death: str
    death_text: Callable[[str], Column]
    episode: Callable[[], Column]
    before_episode: str
    not_dates: str | None
    reported: str
    age: str
    region: str


# Texts of the report for either source layout.
RECOVERY = Wording(
    date="recoverydate", value="recovered", listed="Recovery date", listed_typ="Recovery date listed but not recovered",
    both="recovery date", early="Recovered before Onset", early_typ="Early Recovered", blank_unit=True,
    disposition="Disposition", death="COVIDDeath", death_text=clean_str, episode=episode_date,
    before_episode="PHACReported before EpisodeDate", not_dates=None, reported="ReportedDate", age="Age", region="PT",
)
RESOLUTION = Wording(
    date="resolutiondate", value="resolved", listed="Resolution date", listed_typ="Resolution date listed but not resolved",
    both="resolution date", early="Resolved before Onset", early_typ="Early resolution", blank_unit=False,
    # this layout holds lower-case text and has an episode date of its own
    disposition="disposition", death="coviddeath", death_text=F.col, episode=lambda: F.col("episodedate"),
    before_episode="PHACReported before episodedate", not_dates=NOT_DATES, reported="reporteddate", age="age", region="pt",
)


def _lower_is(col: str, value: str) -> Column:
    return F.lower(F.col(col)) == value


def _quoted(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"'{name}' is '"), value, F.lit("'"))


def _joined(parts: list[Column], sep: str) -> Column:
    """Non-null parts in column order; ``concat_ws`` skips nulls."""
    return F.concat_ws(sep, *parts)


def _fixed(cond: Callable[[], Column], err: str) -> Callable[[DataFrame], list[Hit]]:
    return lambda df: [(cond(), F.lit(err))]


def _date_without_status(status: str, value: str, dates: list[str], err: str):
    def hits(df: DataFrame) -> list[Hit]:
        listed = F.coalesce(*dates).isNotNull()
        return [(~_lower_is(status, value) & listed, F.lit(err))]

    return hits


def _outcome_date(status: str, value: str, date: str, label: str, named: str):
    def hits(df: DataFrame) -> list[Hit]:
        err = F.concat(
            F.lit(f"{label} of '"), F.col(date).cast("string"),
            F.lit(f"' is listed but {named} is '"), na_text(status), F.lit("'"),
        )
        return [(~_lower_is(status, value) & F.col(date).isNotNull(), err)]

    return hits


def _any(conds: list[Column]) -> Column:
    """Whether one of the conditions holds; unknown ones do not."""
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conds])


def _filled(df: DataFrame, name: str) -> Column:
    """Whether a cell has text; only text can be blank, so others need not become text."""
    x = F.col(name)
    return x.isNotNull() if isinstance(df.schema[name].dataType, T.DateType | T.NumericType) else x.cast("string") != ""


def _symptoms(df: DataFrame) -> list[Hit]:
    parts, found = [], []
    for c in matching(df.columns, "^sym"):
        v = F.col(c).cast("string")
        present = ~F.lower(v).isin("", ".", "no", "unknown")
        found.append(present)
        parts.append(F.when(present, F.concat(F.lit(f"{c}="), v)))
    if not parts:
        return []
    # no text is made to find a hit
    cond = _lower_is("asymptomatic", "yes") & _any(found)
    return [(cond, F.concat(F.lit("Asymptomatic is 'yes' but "), _joined(parts, " + ")))]


def _details(prefix: str, opening: str):
    """The flag is not yes, yet another column of the family is filled in."""

    def hits(df: DataFrame) -> list[Hit]:
        parts, found = [], []
        for c in matching(df.columns, f"^{prefix}"):
            if c.lower() != prefix:
                filled = _filled(df, c)
                found.append(filled)
                parts.append(F.when(filled, _quoted(c, F.col(c).cast("string"))))
        if not parts:
            return []
        cond = ~_lower_is(prefix, "yes") & _any(found)
        return [(cond, F.concat(F.lit(opening), _joined(parts, " and ")))]

    return hits


def _before(early: str, late: str, opening: str):
    def hits(df: DataFrame) -> list[Hit]:
        a, b = F.col(early), F.col(late)
        err = F.concat(
            F.lit(f"{opening} '"), a.cast("string"), F.lit("' < '"), b.cast("string"), F.lit("'")
        )
        return [(a < b, err)]

    return hits


def _dead_and_alive(words: Wording):
    def hits(df: DataFrame) -> list[Hit]:
        d, r = F.col("deathdate"), F.col(words.date)
        err = F.concat(
            F.lit("Both Death date '"), d.cast("string"),
            F.lit(f"' and {words.both} '"), r.cast("string"), F.lit("' listed."),
        )
        return [(d.isNotNull() & r.isNotNull(), err)]

    return hits


def _testing_reason(df: DataFrame) -> list[Hit]:
    reason, contact = F.col("testingreason"), F.col("closecontactcase")
    err = F.concat(
        F.lit("TestingReason '"), reason, F.lit("' disagrees with  CloseContactCase '"), contact, F.lit("'")
    )
    cond = _lower_is("testingreason", "contact of a case") & (F.lower(contact) != "yes")
    return [(cond, err)]


def _death_disposition(words: Wording):
    def hits(df: DataFrame) -> list[Hit]:
        death, disposition = words.death_text("coviddeath"), words.death_text("disposition")
        err = F.concat(
            F.lit(f"{words.death} '"), death, F.lit(f"' disagrees with  {words.disposition} '"), disposition, F.lit("'")
        )
        # a cheap necessary condition first: cleaning runs on the few rows that pass
        likely = F.lower("coviddeath").contains("yes")
        return [(likely & (F.lower(death) == "yes") & (F.lower(disposition) != "deceased"), err)]

    return hits


def _report_before_episode(words: Wording):
    def hits(df: DataFrame) -> list[Hit]:
        a, b = F.col("phacreporteddate"), words.episode()
        err = F.concat(
            F.lit(f"{words.before_episode} '"), a.cast("string"), F.lit("' < '"), b.cast("string"), F.lit("'")
        )
        return [(a < b, err)]

    return hits


def _each_date(test: Callable[[Column], Column], ending: str, words: Wording):
    def hits(df: DataFrame) -> list[Hit]:
        names = date_columns(df)
        skipped = set(matching(names, words.not_dates)) if words.not_dates else set()
        return [(test(F.col(c)), F.lit(f"{c}{ending}")) for c in names if c not in skipped]

    return hits


def _open_long(date: str, opening: str, asof: Column, days: int, words: Wording):
    def hits(df: DataFrame) -> list[Hit]:
        d = F.col(date)
        closed = F.coalesce(F.lower("disposition").isin("deceased", words.value), F.lit(False))
        cond = (
            F.lower("classification").isin("confirmed", "probable")
            & ~closed
            & (d <= F.date_sub(asof, days))
        )
        err = F.concat(
            F.lit(f"{opening} "), d.cast("string"), F.lit(" is "), F.datediff(asof, d).cast("string"),
            F.lit(f" days ago....Thats a lot, maybe verify this with the {words.region}?"),
        )
        return [(cond, err)]

    return hits


def _age_range(words: Wording):
    def hits(df: DataFrame) -> list[Hit]:
        age = F.col("age")
        return [((age < 0) | (age > 113), F.concat(F.lit(f"{words.age}  "), age.cast("string"), F.lit(" is  wrong")))]

    return hits


def rules(
    asof: object, min_date: object = "2020-01-01", *, open_days: int = 150, words: Wording = RECOVERY
) -> list[Rule]:
    """The rule catalogue. Message and type texts are fixed values of the report.

    Status words are compared without regard to case, so either source layout works.
    """
    today, earliest = as_col(asof), as_col(min_date)
    unit = F.col("ageunit")
    known_age = F.col("age").isNotNull
    return [
        Rule(
            "residency_blank",
            "Residency is unspecified, yet ResidenceCountry is not blank.",
            _fixed(
                lambda: (F.col("residency") == "") & (F.length("residencecountry") > 0),
                "Residency is unspecified, yet ResidenceCountry is not blank.",
            ),
        ),
        Rule(
            "residency_mismatch",
            "Residency is Canadian, yet ResidenceCountry is not.",
            _fixed(
                lambda: _lower_is("residency", "canadian resident")
                & (F.lower("residencecountry") != "canada"),
                "Residency is Canadian, yet ResidenceCountry is not.",
            ),
        ),
        Rule(
            "age_group_unknown",
            "Age group unkown, but known age",
            _fixed(
                lambda: known_age()
                & (_lower_is("agegroup10", "unknown") | _lower_is("agegroup20", "unknown")),
                "Exact Age is given but Agegroup is listed as unkown.",
            ),
        ),
        Rule(
            "age_unit_missing",
            "No Age units",
            _fixed(
                lambda: known_age() & ((unit == "") if words.blank_unit else unit.isNull()),
                "Exact Age is given but Age units are not.",
            ),
        ),
        Rule("asymptomatic_with_symptoms", "Asymptomatic but not", _symptoms),
        Rule(
            "hosp_date",
            "A hospital date is listed but Hosp is not Yes",
            _date_without_status(
                "hosp", "yes", ["hospstartdate", "hospenddate"],
                "A hospital date is listed but Hosp is not Yes",
            ),
        ),
        Rule(
            "icu_date",
            "ICU",
            _date_without_status(
                "icu", "yes", ["icustartdate", "icuenddate"], "A ICU date is listed but ICU is not Yes"
            ),
        ),
        Rule(
            "isolation_date",
            "Isolation",
            _date_without_status(
                "isolation", "yes", ["isolationstartdate", "isolationenddate"],
                "A Isolation date is listed but Isolation is not Yes",
            ),
        ),
        Rule(
            "vent_date",
            "vent",
            _date_without_status(
                "mechanicalvent", "yes", ["ventstartdate", "ventenddate"],
                "A vent date is listed but MechanicalVent is not Yes",
            ),
        ),
        Rule(
            "recovered_date",
            words.listed_typ,
            _outcome_date("disposition", words.value, words.date, words.listed, words.disposition),
        ),
        Rule(
            "death_date",
            "Death date listed but not dead.",
            _outcome_date("disposition", "deceased", "deathdate", "Death date", words.disposition),
        ),
        Rule("travel_details", "Travel", _details("travel", "travel is not yes but ")),
        Rule(
            "close_contact_details",
            "Close Contact",
            _details("closecontactcase", "CloseContactCase is not yes but "),
            default=False,
        ),
        Rule("dead_and_alive", f"Both Death date and {words.both} listed.", _dead_and_alive(words)),
        Rule("dead_before_onset", "Early Dead", _before("deathdate", "onsetdate", "Dead before Onset")),
        Rule(
            "recovered_before_onset",
            words.early_typ,
            _before(words.date, "onsetdate", words.early),
        ),
        Rule("testing_reason", "Contact Testing Reason", _testing_reason),
        Rule("covid_death_disposition", "Covid Death but not Deceased", _death_disposition(words)),
        Rule("reported_before_episode", "Early PHACReported", _report_before_episode(words)),
        Rule(
            "future_dates",
            "Future Date",
            _each_date(lambda d: d > today, " is in the future? spooky!", words),
        ),
        Rule(
            "dates_before_min",
            f"Before {min_date} Date",
            _each_date(lambda d: d < earliest, f" is before {min_date}", words),
        ),
        Rule(
            "sick_long_time",
            "Sick Long time",
            _open_long("onsetdate", "Onset Date", today, open_days, words),
        ),
        Rule(
            "reported_long_ago",
            "Reported Long time ago.",
            _open_long("reporteddate", words.reported, today, open_days, words),
        ),
        Rule("age_range", "age out of range", _age_range(words)),
    ]


def _checks(df: DataFrame, chosen: list[Rule]) -> list[tuple[str, Column, Column]]:
    """Type, condition and message of everything the rules check."""
    return [(rule.typ, cond, err) for rule in chosen for cond, err in rule.hits(df)]


#: Cases in one range of the ordered report: what a task sorts does not grow with the table.
RANGE_CASES = 200_000

#: Conditions in one number of a bit mask; few enough for one compiled method.
_BITS = 16


def marked_cases(df: DataFrame, chosen: list[Rule]) -> tuple[DataFrame, list[tuple[str, Column, Column]]]:
    """Cases with a hit, with bit masks of what they hit in ``__hits``; and the checks, now conditions on these bits.

    The conditions are evaluated where the cases are read, and cases without a hit go no further.
    """
    checks = _checks(df, chosen)
    masks, tests = [], []
    for k in range(0, len(checks), _BITS):
        part = checks[k : k + _BITS]
        bits = [F.when(cond, F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, cond, _) in enumerate(part)]
        name = f"m{k // _BITS}"
        masks.append(reduce(lambda a, b: a.bitwiseOR(b), bits).alias(name))
        own = F.col("__hits").getField(name)
        tests += [(typ, own.bitwiseAND(F.lit(1 << i)) != 0, err) for i, (typ, _, err) in enumerate(part)]
    if not masks:
        return df.withColumn("__hits", F.lit(None)).where(F.lit(False)), []
    names = [f"m{k}" for k in range(len(masks))]
    # a projection of its own computes the masks once; the filter that follows cannot be moved before it
    listed = df.withColumn("__hits", F.array(F.struct(*masks)))
    some = F.filter("__hits", lambda m: reduce(lambda a, b: a.bitwiseOR(b), [m[n] for n in names]) != 0)
    marked = listed.select(*[F.col(f"`{c}`") for c in df.columns], F.explode_outer(some).alias("__hits"))
    return marked.where("__hits IS NOT NULL"), tests


def with_errors(df: DataFrame, checks: list[tuple[str, Column, Column]], keep: list[str]) -> DataFrame:
    """One row per (input row, hit): the kept columns plus ``typ`` and ``err``."""
    hits = [F.when(cond, F.struct(F.lit(typ).alias("typ"), err.alias("err"))) for typ, cond, err in checks]
    if not hits:
        return df.select(*keep, F.lit("").alias("typ"), F.lit("").alias("err")).where(F.lit(False))
    if not small_methods(df.sparkSession):
        found = F.explode(F.array_compact(F.array(*hits)))
        return df.select(*keep, found.alias("hit")).select(*keep, "hit.typ", "hit.err")
    # a projection of its own compiles the rules; with very large methods that would be slower
    listed = df.select(*keep, F.array(*hits).alias("hits"))
    found = F.explode_outer(F.array_compact("hits"))
    return (
        listed.select(*keep, found.alias("hit")).where("hit is not null").select(*keep, "hit.typ", "hit.err")
    )


def rule_errors(
    df: DataFrame, name: str, *, asof, min_date="2020-01-01", id_col: str = "phacid", words: Wording = RECOVERY
) -> DataFrame:
    """Errors of a single rule: ``(id, err, typ)``."""
    rule = next(r for r in rules(asof, min_date, words=words) if r.name == name)
    hits = rule.hits(df)
    if len(hits) == 1:
        cond, err = hits[0]
        return df.where(cond).select(id_col, err.alias("err"), F.lit(rule.typ).alias("typ"))
    return with_errors(df, _checks(df, [rule]), [id_col]).select(id_col, "err", "typ")


# The case columns of the report.
REPORT_COLUMNS = ["phacid", "pt", "ptcaseid", "classification", "phacreporteddate"]


def error_report(
    df: DataFrame, *, asof, min_date="2020-01-01", ordered: bool = True, names: list[str] | None = None,
    words: Wording = RECOVERY, check_unique: bool = False,
) -> DataFrame:
    """All errors of the default rules, or of the named ones, newest reports first.

    The ordered report counts the cases before the call returns: a range of them has so many that a task can sort them.
    With ``check_unique`` a repeated id raises an error, by a job before the call returns.
    """
    if check_unique:
        assert_unique(df, "phacid")
    catalogue = rules(asof, min_date, words=words)
    chosen = [r for r in catalogue if (r.default if names is None else r.name in names)]
    columns = ["phacid", "pt", "ptcaseid", "typ", "classification", "phacreporteddate", "err"]
    if not ordered:
        return with_errors(df, _checks(df, chosen), REPORT_COLUMNS).select(*columns)
    # cases with a hit are dealt in order, with the values that messages name; the messages are made where they belong
    marked, tests = marked_cases(df, chosen)
    ranges = -(-df.count() // RANGE_CASES)
    # a table of one range is left to adaptive execution; it would also fill a range by its bytes, however many cases these hold
    number = [max(ranges, df.sparkSession.sparkContext.defaultParallelism)] if ranges > 1 else []
    dealt = marked.repartitionByRange(*number, F.desc("phacreporteddate"), "phacid")
    out = with_errors(dealt, tests, REPORT_COLUMNS).select(*columns)
    return out.sortWithinPartitions(F.desc("phacreporteddate"), "phacid", "typ")
