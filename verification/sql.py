"""Building blocks for the DuckDB side of the checks, written apart from the library."""

from __future__ import annotations

import hashlib

from .fixture import CASES_SQL, SECOND_SQL, SYMPTOMS_SQL

WITH_CASES = f"WITH cases AS (\n{CASES_SQL}\n)"
WITH_SYMPTOMS = f"WITH symptoms AS (\n{SYMPTOMS_SQL}\n)"
WITH_BOTH = f"{WITH_CASES}, symptoms AS (\n{SYMPTOMS_SQL}\n)"
WITH_SOURCES = (
    f"WITH cases_fixture AS (\n{CASES_SQL}\n), a AS (SELECT * FROM cases_fixture WHERE k % 103 <> 0), "
    f"b AS (\n{SECOND_SQL}\n)"
)

_count = 0


def let(value: str, body) -> str:
    """Bind a value to a name inside one SQL expression."""
    global _count
    _count += 1
    v = f"v{_count}"
    return f"list_transform([{value}], lambda {v}: {body(v)})[1]"


def title(x: str) -> str:
    """First letter of each word in capitals; the title form of a sharp s is ``Ss``."""
    global _count
    _count += 1
    w = f"w{_count}"
    return (
        f"array_to_string(list_transform(string_split({x}, ' '), "
        f"lambda {w}: replace(upper({w}[1]), 'ẞ', 'Ss') || lower({w}[2:])), ' ')"
    )


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(13))"


def squeeze(x: str) -> str:
    return f"regexp_replace({x}, '[ ]+', ' ', 'g')"


def clean(x: str, na: str = "", blank: str = "", repl: str = " ") -> str:
    s = squeeze(rf"regexp_replace(CAST({x} AS VARCHAR), '\p{{P}}', {q(repl)}, 'g')")
    s = f"coalesce(nullif({title(s)}, 'Na'), {q(na)})"
    s = f"coalesce(nullif({trim(s)}, ''), {q(blank)})"
    return title(s)


def category(x: str, good: list[str], other: str = "Unknown", blank: str = "") -> str:
    ok = ", ".join(q(g) for g in [*good, blank])
    return let(
        clean(x),
        lambda v: f"CASE WHEN {v} = '' THEN {q(blank)} WHEN {v} IN ({ok}) THEN {v} ELSE {q(other)} END",
    )


def yn(x: str) -> str:
    return category(x, ["Yes", "No"])


ICU = f"({yn('icu')} = 'Yes' OR icustartdate IS NOT NULL OR {yn('mechanicalvent')} = 'Yes' OR ventstartdate IS NOT NULL)"
HOSP = f"({yn('hosp')} = 'Yes' OR hospstartdate IS NOT NULL)"
HOSP_STATUS = (
    f"CASE WHEN {ICU} THEN 'Hospitalized - ICU' WHEN {HOSP} THEN 'Hospitalized - non-ICU' "
    f"WHEN {yn('hosp')} = 'No' THEN 'Not hospitalized' ELSE 'Unknown' END"
)
HOSPITALIZED = f"CASE WHEN {ICU} OR {HOSP} THEN 'Yes' WHEN {yn('hosp')} = 'No' THEN 'No' ELSE 'Unknown' END"
ICU_FLAG = f"CASE WHEN {ICU} THEN 'Yes' WHEN {yn('icu')} = 'No' THEN 'No' ELSE 'Unknown' END"
EPISODE = (
    "coalesce(nullif(onsetdate, DATE '1970-01-01'), nullif(earliestlabcollectiondate, DATE '1970-01-01'), "
    "nullif(earliestlabtestresultdate, DATE '1970-01-01'), earliestlabtestresultdate)"
)
EPISODE_TYPE = (
    "CASE WHEN onsetdate IS NOT NULL THEN 'Onset date' "
    "WHEN earliestlabcollectiondate IS NOT NULL THEN 'Lab specimen collection date' "
    "WHEN earliestlabtestresultdate IS NOT NULL THEN 'Lab test result date' ELSE '' END"
)
INDIGENOUS = let(
    clean("indigenous"),
    lambda v: f"CASE WHEN {v} = 'Yes' OR coalesce(regexp_matches({squeeze('''regexp_replace(indigenousgroup, '[^a-zA-Z0-9]', ' ', 'g')''')}, "
    f"'first nation|inuit|metis', 'i'), false) THEN 'Yes' ELSE {v} END",
)
SYMPTOMS = ["symcough", "symfever", "symother"]
_VALS = "[" + ", ".join(yn(c) for c in SYMPTOMS) + "]"
ASYMPTOMATIC = let(
    _VALS,
    lambda v: (
        f"CASE WHEN ({yn('asymptomatic')} = 'Yes' AND len(list_filter({v}, lambda z: z IN ('Yes', 'No'))) = 0) "
        f"OR ({v}[1] = 'No' AND {v}[2] = 'No' AND {v}[3] IN ('No', 'Unknown')) THEN 'Yes' "
        f"WHEN list_contains({v}, 'Yes') THEN 'No' ELSE 'Unknown' END"
    ),
)
DEATH = (
    f"CASE WHEN {yn('coviddeath')} = 'Yes' THEN 'Yes' "
    f"WHEN {clean('disposition')} IN ('Deceased', '', 'Unknown') THEN 'Unknown' ELSE 'No' END"
)
SEX = category("sex", ["Female", "Male", "Other"], blank="Not Stated")
OCCUPATION = f"coalesce(nullif({clean('occupationspec')}, ''), 'Not Stated')"
WORKER = category("healthcare_worker", ["Yes", "No", "Unknown"], blank="Not Stated")
RESIDENT = category("ltc_resident", ["Yes", "No", "Unknown"], blank="Not Stated")
ONSET_TEXT = "coalesce(CAST(onsetdate AS VARCHAR), 'Not Stated')"
DISPOSITION = let(
    clean("disposition"),
    lambda v: (
        f"CASE WHEN {v} IN ('Ill', 'Self Isolation', 'Stable') THEN 'Stable' "
        f"WHEN {v} IN ('Not Reported', 'Other', 'Pending', '') THEN 'Unknown' "
        f"WHEN {v} IN ('Recovered', 'Deceased') THEN {v} END"
    ),
)
RECOVERY = f"CASE WHEN {DISPOSITION} = 'Recovered' THEN recoverydate END"
_PLACES = f"[{clean('travelfromcountry1')}, {clean('traveltocountry1')}]"
COUNTRY = let(
    f"list_filter({_PLACES}, lambda z: z NOT IN ('Canada', ''))",
    lambda v: f"CASE WHEN len({v}) = 2 AND {v}[1] = {v}[2] THEN {v}[1] ELSE array_to_string({v}, ' ') END",
)
EXPOSURE = let(
    clean("exposure_cat"),
    lambda v: f"CASE WHEN {v} = '' THEN 'Missing' WHEN {v} ILIKE '%domestic%' THEN 'Domestic acquisition' ELSE {v} END",
)
WEEK = "CAST(floor((dayofyear({0}) - 1) / 7) + 1 AS INT)"

RULE_SQL = {
    # name: (typ, [(condition, message)])
    "residency_blank": (
        "Residency is unspecified, yet ResidenceCountry is not blank.",
        [("residency = '' AND length(residencecountry) > 0",
          "'Residency is unspecified, yet ResidenceCountry is not blank.'")],
    ),
    "residency_mismatch": (
        "Residency is Canadian, yet ResidenceCountry is not.",
        [("residency = 'Canadian resident' AND lower(residencecountry) <> 'canada'",
          "'Residency is Canadian, yet ResidenceCountry is not.'")],
    ),
    "age_group_unknown": (
        "Age group unkown, but known age",
        [("age IS NOT NULL AND (lower(agegroup10) = 'unknown' OR lower(agegroup20) = 'unknown')",
          "'Exact Age is given but Agegroup is listed as unkown.'")],
    ),
    "age_unit_missing": (
        "No Age units",
        [("age IS NOT NULL AND ageunit = ''", "'Exact Age is given but Age units are not.'")],
    ),
    "asymptomatic_with_symptoms": (
        "Asymptomatic but not",
        [(
            "lower(asymptomatic) = 'yes' AND len(sym) > 0",
            "'Asymptomatic is ''yes'' but ' || array_to_string(sym, ' + ')",
        )],
    ),
    "hosp_date": (
        "A hospital date is listed but Hosp is not Yes",
        [("lower(hosp) <> 'yes' AND (hospstartdate IS NOT NULL OR hospenddate IS NOT NULL)",
          "'A hospital date is listed but Hosp is not Yes'")],
    ),
    "icu_date": (
        "ICU",
        [("lower(icu) <> 'yes' AND (icustartdate IS NOT NULL OR icuenddate IS NOT NULL)",
          "'A ICU date is listed but ICU is not Yes'")],
    ),
    "isolation_date": (
        "Isolation",
        [("lower(isolation) <> 'yes' AND (isolationstartdate IS NOT NULL OR isolationenddate IS NOT NULL)",
          "'A Isolation date is listed but Isolation is not Yes'")],
    ),
    "vent_date": (
        "vent",
        [("lower(mechanicalvent) <> 'yes' AND (ventstartdate IS NOT NULL OR ventenddate IS NOT NULL)",
          "'A vent date is listed but MechanicalVent is not Yes'")],
    ),
    "recovered_date": (
        "Recovery date listed but not recovered",
        [("lower(disposition) <> 'recovered' AND recoverydate IS NOT NULL",
          "'Recovery date of ''' || recoverydate || ''' is listed but Disposition is ''' || disposition || ''''")],
    ),
    "death_date": (
        "Death date listed but not dead.",
        [("lower(disposition) <> 'deceased' AND deathdate IS NOT NULL",
          "'Death date of ''' || deathdate || ''' is listed but Disposition is ''' || disposition || ''''")],
    ),
    "travel_details": (
        "Travel",
        [("lower(travel) <> 'yes' AND len(trav) > 0",
          "'travel is not yes but ' || array_to_string(trav, ' and ')")],
    ),
    "close_contact_details": (
        "Close Contact",
        [("lower(closecontactcase) <> 'yes' AND closecontactcasespec <> ''",
          "'CloseContactCase is not yes but ''closecontactcasespec'' is ''' || closecontactcasespec || ''''")],
    ),
    "dead_and_alive": (
        "Both Death date and recovery date listed.",
        [("deathdate IS NOT NULL AND recoverydate IS NOT NULL",
          "'Both Death date ''' || deathdate || ''' and recovery date ''' || recoverydate || ''' listed.'")],
    ),
    "dead_before_onset": (
        "Early Dead",
        [("deathdate < onsetdate", "'Dead before Onset ''' || deathdate || ''' < ''' || onsetdate || ''''")],
    ),
    "recovered_before_onset": (
        "Early Recovered",
        [("recoverydate < onsetdate",
          "'Recovered before Onset ''' || recoverydate || ''' < ''' || onsetdate || ''''")],
    ),
    "testing_reason": (
        "Contact Testing Reason",
        [("testingreason = 'Contact of a case' AND closecontactcase <> 'Yes'",
          "'TestingReason ''' || testingreason || ''' disagrees with  CloseContactCase ''' || closecontactcase || ''''")],
    ),
    "covid_death_disposition": (
        "Covid Death but not Deceased",
        [(f"{clean('coviddeath')} = 'Yes' AND {clean('disposition')} <> 'Deceased'",
          f"'COVIDDeath ''' || {clean('coviddeath')} || ''' disagrees with  Disposition ''' || {clean('disposition')} || ''''")],
    ),
    "reported_before_episode": (
        "Early PHACReported",
        [(f"phacreporteddate < {EPISODE}",
          f"'PHACReported before EpisodeDate ''' || phacreporteddate || ''' < ''' || {EPISODE} || ''''")],
    ),
    "sick_long_time": (
        "Sick Long time",
        [("classification IN ('Confirmed', 'Probable') AND coalesce(disposition, '') NOT IN ('Deceased', 'Recovered') "
          "AND onsetdate <= DATE '2001-06-30' - 150",
          "'Onset Date ' || onsetdate || ' is ' || (DATE '2001-06-30' - onsetdate) || "
          "' days ago....Thats a lot, maybe verify this with the PT?'")],
    ),
    "reported_long_ago": (
        "Reported Long time ago.",
        [("classification IN ('Confirmed', 'Probable') AND coalesce(disposition, '') NOT IN ('Deceased', 'Recovered') "
          "AND reporteddate <= DATE '2001-06-30' - 150",
          "'ReportedDate ' || reporteddate || ' is ' || (DATE '2001-06-30' - reporteddate) || "
          "' days ago....Thats a lot, maybe verify this with the PT?'")],
    ),
    "age_range": ("age out of range", [("age < 0 OR age > 113", "'Age  ' || age || ' is  wrong'")]),
}
DATES = [
    "phacreporteddate", "reporteddate", "onsetdate", "earliestlabcollectiondate", "earliestlabtestresultdate",
    "episodedate", "hospstartdate", "hospenddate", "icustartdate", "icuenddate", "ventstartdate", "ventenddate",
    "isolationstartdate", "isolationenddate", "deathdate", "recoverydate", "travelstartdate1", "travelenddate1",
]
RULE_SQL["future_dates"] = (
    "Future Date",
    [(f"{d} > DATE '2001-06-30'", f"'{d} is in the future? spooky!'") for d in DATES],
)
RULE_SQL["dates_before_min"] = (
    "Before 1996-01-01 Date",
    [(f"{d} < DATE '1996-01-01'", f"'{d} is before 1996-01-01'") for d in DATES],
)

_SYM_COLS = ["symcough", "symfever", "symother", "symotherspec"]
_TRAVEL_COLS = ["travelfromcountry1", "traveltocountry1", "travelstartdate1", "travelenddate1"]
_SYM = ", ".join(
    f"CASE WHEN lower({c}) NOT IN ('', '.', 'no', 'unknown') THEN '{c}=' || {c} END" for c in _SYM_COLS
)
_TRAV = ", ".join(
    f"CASE WHEN CAST({c} AS VARCHAR) <> '' THEN '''{c}'' is ''' || {c} || '''' END" for c in _TRAVEL_COLS
)
WITH_RULES = (
    f"{WITH_CASES}, r AS (SELECT *, list_filter([{_SYM}], lambda z: z IS NOT NULL) AS sym, "
    f"list_filter([{_TRAV}], lambda z: z IS NOT NULL) AS trav FROM cases)"
)


def rule_sql(name: str, cols: str = "phacid") -> str:
    typ, hits = RULE_SQL[name]
    return "\nUNION ALL\n".join(
        f"SELECT {cols}, {msg} AS err, {q(typ)} AS typ FROM r WHERE {cond}" for cond, msg in hits
    )


def _round_numbers(seed: int, target: str, source: str) -> list[int]:
    text = hashlib.sha256(f"{seed} {target} from {source}".encode()).hexdigest()
    return [int(text[i : i + 16], 16) % 2147483647 for i in range(0, 64, 16)]


def impute_sql(
    targets: list[str], sources: list[str], *, cte: str, base: str, group: str = "pt", final: str,
    seed: int = 0, suppress: bool = True,
) -> str:
    """Reference form of the imputation: number the donors, pick one by position."""
    pairs = [(t, s) for t in targets for s in sources if t not in s]
    long = "\n  UNION ALL ".join(
        f"SELECT phacid, {group} AS grp, k, '{t}' AS target, '{s}' AS source, {s} AS sday, {t} AS tday, "
        f"{s} - {t} AS gap, {', '.join(f'{c} AS c{i}' for i, c in enumerate(_round_numbers(seed, t, s)))} FROM {base}"
        for t, s in pairs
    )
    joins = "".join(
        f" LEFT JOIN pick p_{t} ON p_{t}.phacid = c.phacid AND p_{t}.target = '{t}'"
        f" LEFT JOIN bounds b_{t} ON b_{t}.grp = {group.replace('pt', 'c.pt')} AND b_{t}.target = '{t}'"
        for t in targets
    )
    out = []
    for t in targets:
        v = f"coalesce(c.{t}, p_{t}.day)"
        if suppress:
            v = f"CASE WHEN {v} BETWEEN b_{t}.first_day AND b_{t}.last_day THEN {v} END"
        out.append(f"{v} AS {t}_imputed")
    prime = 2147483647
    return f"""{cte}, raw AS (
  {long}
), r0 AS (SELECT *, CAST(k >> 31 AS BIGINT) % {prime} AS a0, CAST(k & 2147483647 AS BIGINT) % {prime} AS a1 FROM raw
), r1 AS (SELECT *, (a0 + (a1 + c0) % {prime} * ((a1 + c0) % {prime})) % {prime} AS a2 FROM r0
), r2 AS (SELECT *, (a1 + (a2 + c1) % {prime} * ((a2 + c1) % {prime})) % {prime} AS a3 FROM r1
), r3 AS (SELECT *, (a2 + (a3 + c2) % {prime} * ((a3 + c2) % {prime})) % {prime} AS a4 FROM r2
), r4 AS (SELECT *, (a3 + (a4 + c3) % {prime} * ((a4 + c3) % {prime})) % {prime} AS a5 FROM r3
), long AS (SELECT *, CAST(a5 AS HUGEINT) * 2147483648 + a4 AS bits FROM r4
), stats AS (
  SELECT grp, target, source, count(gap) AS donors FROM long GROUP BY grp, target, source
  HAVING (count(*) - count(gap)) * 2 < count(*)
), donor AS (
  SELECT grp, target, source, gap,
         row_number() OVER (PARTITION BY grp, target, source ORDER BY gap) AS rn
  FROM long JOIN stats USING (grp, target, source) WHERE gap IS NOT NULL
), filled AS (
  SELECT l.phacid, l.grp, l.target, l.source, l.sday, l.tday, l.gap, coalesce(l.gap, d.gap) AS fgap
  FROM long l JOIN stats s USING (grp, target, source)
  LEFT JOIN donor d ON d.grp = l.grp AND d.target = l.target AND d.source = l.source AND l.gap IS NULL
       AND d.rn = CAST(l.bits * s.donors // 4611686018427387904 AS BIGINT) + 1
), ranked AS (
  SELECT grp, target, source, row_number() OVER (PARTITION BY grp, target ORDER BY
         quantile_cont(fgap, 0.95) - quantile_cont(fgap, 0.05), source) AS rnk
  FROM filled GROUP BY grp, target, source
), pick AS (
  SELECT phacid, target, min_by(sday - CAST(fgap AS INT), rnk) AS day
  FROM filled JOIN ranked USING (grp, target, source)
  WHERE tday IS NULL AND sday IS NOT NULL GROUP BY phacid, target
), bounds AS (
  SELECT grp, target, min(tday) AS first_day, max(tday) AS last_day FROM long GROUP BY grp, target
), imputed AS (
  SELECT c.*, {", ".join(out)} FROM {base} c{joins}
)
{final}"""


def resolution_rules(asof: str, min_date: str) -> list[tuple[str, str, str]]:
    """(type, condition, message) of the report over the source layout with resolution dates, in lower-case text."""
    lines = []

    def add(typ: str, cond: str, message: str) -> None:
        lines.append((typ, cond, message))

    def fixed(typ: str, cond: str, text: str) -> None:
        add(typ, cond, q(text))

    fixed("Residency is unspecified, yet ResidenceCountry is not blank.", "residency = '' AND residencecountry <> ''",
          "Residency is unspecified, yet ResidenceCountry is not blank.")
    fixed("Residency is Canadian, yet ResidenceCountry is not.",
          "residency ILIKE 'canadian resident' AND residencecountry NOT ILIKE 'canada'",
          "Residency is Canadian, yet ResidenceCountry is not.")
    fixed("Age group unkown, but known age", "age IS NOT NULL AND 'Unknown' IN (agegroup10, agegroup20)",
          "Exact Age is given but Agegroup is listed as unkown.")
    fixed("No Age units", "age IS NOT NULL AND ageunit IS NULL", "Exact Age is given but Age units are not.")
    add("Asymptomatic but not", "asymptomatic ILIKE 'yes' AND len(sym) > 0",
        "concat('Asymptomatic is ''yes'' but ', array_to_string(sym, ' + '))")
    for flag, dates, typ, text in (
        ("hosp", "hospstartdate, hospenddate", "A hospital date is listed but Hosp is not Yes", "A hospital date is listed but Hosp is not Yes"),
        ("icu", "icustartdate, icuenddate", "ICU", "A ICU date is listed but ICU is not Yes"),
        ("isolation", "isolationstartdate, isolationenddate", "Isolation", "A Isolation date is listed but Isolation is not Yes"),
        ("mechanicalvent", "ventstartdate, ventenddate", "vent", "A vent date is listed but MechanicalVent is not Yes"),
    ):
        fixed(typ, f"{flag} NOT ILIKE 'yes' AND coalesce({dates}) IS NOT NULL", text)
    add("Resolution date listed but not resolved", "disposition <> 'resolved' AND resolutiondate IS NOT NULL",
        "format('Resolution date of ''{}'' is listed but disposition is ''{}''', resolutiondate, disposition)")
    add("Death date listed but not dead.", "disposition <> 'deceased' AND deathdate IS NOT NULL",
        "format('Death date of ''{}'' is listed but disposition is ''{}''', deathdate, disposition)")
    add("Travel", "travel NOT ILIKE 'yes' AND len(trav) > 0", "concat('travel is not yes but ', array_to_string(trav, ' and '))")
    add("Both Death date and resolution date listed.", "deathdate IS NOT NULL AND resolutiondate IS NOT NULL",
        "format('Both Death date ''{}'' and resolution date ''{}'' listed.', deathdate, resolutiondate)")
    add("Early Dead", "deathdate < onsetdate", "format('Dead before Onset ''{}'' < ''{}''', deathdate, onsetdate)")
    add("Early resolution", "resolutiondate < onsetdate",
        "format('Resolved before Onset ''{}'' < ''{}''', resolutiondate, onsetdate)")
    add("Contact Testing Reason", "testingreason ILIKE 'contact of a case' AND closecontactcase NOT ILIKE 'yes'",
        "format('TestingReason ''{}'' disagrees with  CloseContactCase ''{}''', testingreason, closecontactcase)")
    add("Covid Death but not Deceased", "coviddeath ILIKE 'yes' AND disposition <> 'deceased'",
        "format('coviddeath ''{}'' disagrees with  disposition ''{}''', coviddeath, disposition)")
    add("Early PHACReported", "phacreporteddate < episodedate",
        "format('PHACReported before episodedate ''{}'' < ''{}''', phacreporteddate, episodedate)")
    for day in (
        "phacreporteddate", "reporteddate", "onsetdate", "earliestlabcollectiondate", "earliestlabtestresultdate",
        "episodedate", "hospstartdate", "hospenddate", "icustartdate", "icuenddate", "ventstartdate", "ventenddate",
        "isolationstartdate", "isolationenddate", "deathdate", "resolutiondate", "travelstartdate1", "travelenddate1",
    ):
        fixed("Future Date", f"{day} > DATE '{asof}'", f"{day} is in the future? spooky!")
        fixed(f"Before {min_date} Date", f"{day} < DATE '{min_date}'", f"{day} is before {min_date}")
    open_case = "classification IN ('confirmed', 'probable') AND coalesce(disposition NOT IN ('deceased', 'resolved'), true)"
    ending = "days ago....Thats a lot, maybe verify this with the pt?"
    add("Sick Long time", f"{open_case} AND date_diff('day', onsetdate, DATE '{asof}') >= 150",
        f"format('Onset Date {{}} is {{}} {ending}', onsetdate, date_diff('day', onsetdate, DATE '{asof}'))")
    add("Reported Long time ago.", f"{open_case} AND date_diff('day', reporteddate, DATE '{asof}') >= 150",
        f"format('reporteddate {{}} is {{}} {ending}', reporteddate, date_diff('day', reporteddate, DATE '{asof}'))")
    add("age out of range", "age NOT BETWEEN 0 AND 113", "format('age  {} is  wrong', age)")
    return lines


def checksum(cols: list[str], relation: str) -> str:
    """Row count and a sum over the rows' digests; columns by name, missing cells as blanks."""
    cells = ", ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), '')" for c in sorted(cols))
    return (
        f"count(*) AS n_rows, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {cells})), 1, 8) AS BIGINT)) AS BIGINT) "
        f"AS checksum FROM {relation}"
    )
