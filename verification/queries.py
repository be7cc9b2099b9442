"""Queries over the case line list, with their SQL."""

from __future__ import annotations

import contextlib
import datetime as dt
from functools import reduce
from itertools import chain

from pyspark.sql import functions as F

from caseloom.functions import categories as cat
from caseloom.functions import dates, text
from caseloom.operators import clean, curves, derive, diff, impute, quality, rates, reports, summary
from caseloom.plans import extracts, partials, publish
from caseloom.plans.sizing import materialise, remove_path, scratch_path
from caseloom.sources import sinks, store, tables

from . import fixture as fx
from . import sql as S
from .registry import ORACLES, QUERIES, add

ASOF, MIN_DATE = fx.ASOF, fx.MIN_DATE
W = S.WITH_CASES

_TEXT_COLS = [
    "phacid", "pt", "ptcaseid", "classification", "ageunit", "agegroup20", "agegroup10", "sex", "asymptomatic",
    "symcough", "symfever", "symother", "symotherspec", "rfdiabetes", "rfcardiacdisease", "hosp", "icu",
    "mechanicalvent", "isolation", "disposition", "coviddeath", "travel", "travelfromcountry1",
    "traveltocountry1", "exposure_cat", "closecontactcase", "closecontactcasespec", "testingreason", "residency",
    "residencecountry", "indigenous", "indigenousgroup", "occupationspec", "healthcare_worker", "ltc_resident",
]
_FIRST_COLS = ["k", "age", *_TEXT_COLS, *S.DATES]


def row_query(name: str, out: str, column, sql: str, *inputs: str) -> None:
    """A column derived row by row."""

    def run(spark, sf):
        df = fx.cases(spark, sf)
        return df.select("phacid", *inputs, column(df).alias(out))

    cols = "".join(f"{c}, " for c in inputs)
    add(name, run, f"{W}\nSELECT phacid, {cols}{sql} AS {out} FROM cases")


# ---- sources and sinks ------------------------------------------------------------

def _load_cases(spark, sf):
    """The whole table, through the cache: read, read again from it, and read anew."""
    t = tables.Tables(spark, sf)
    first = t.get("orders")
    assert t.get("orders") is first and t.get("orders", refresh=True) is not first
    return t.get("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


add("load_cases", _load_cases, "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders")


def _serial(spark, sf):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date"))
    raw = fx.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 13 != 0, F.concat(days.cast("string"), F.lit(".5"))).alias("OnsetDate"),
        F.col("o_orderdate").alias("ReportedDate"),
        F.col("o_orderstatus").alias("updated"),
    )
    return dates.flat_dates(raw)


add(
    "flat_cases_serial_dates",
    _serial,
    'SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS "OnsetDate", '
    'CAST(o_orderdate AS DATE) AS "ReportedDate", o_orderstatus AS updated FROM orders',
)


def _text_dates(spark, sf):
    text_only = fx.cases(spark, sf).select(
        *[F.col(c).cast("string").alias(c) for c in ("phacid", "onsetdate", "deathdate")],
        F.concat(F.col("reporteddate").cast("string"), F.lit(" 10:30:00")).alias("reporteddate"),
        F.when(F.col("k") % 7 == 0, F.lit("not a date")).otherwise(F.col("recoverydate").cast("string")).alias(
            "recoverydate"),
        F.lit("2020-01-01").alias("earliestdatetype"),
    )
    return dates.parse_dates(text_only)


add(
    "parse_text_dates",
    _text_dates,
    f"{W} SELECT phacid, onsetdate, deathdate, reporteddate, CASE WHEN k % 7 <> 0 THEN recoverydate END AS recoverydate, "
    "'2020-01-01' AS earliestdatetype FROM cases",
)


def _sql_extract(spark, sf):
    fx.cases(spark, sf).createOrReplaceTempView("caseloom_all_cases")
    found = tables.SqlExtracts(spark)
    sql = "select phacid, pt, classification, onsetdate from caseloom_all_cases where age >= 65;"
    return found.get(sql)


add("sql_extract", _sql_extract, f"{W} SELECT phacid, pt, classification, onsetdate FROM cases WHERE age >= 65")


def _stored_extract(spark, sf):
    """The third answer: one was computed, one was stored anew, this one is read."""
    folder = scratch_path(spark, "store")
    fx.cases(spark, sf).createOrReplaceTempView("caseloom_stored_cases")
    sql = "select pt, classification, count(*) as n, max(age) as oldest from caseloom_stored_cases group by pt, classification"
    try:
        kept = store.ResultStore(spark, folder)
        kept.get(sql)
        kept.get(sql, refresh=True)
        kept.prune()
        return materialise(kept.get(sql))
    finally:
        remove_path(spark, folder)


add(
    "stored_extract",
    _stored_extract,
    f"{W} SELECT pt, classification, count(*) AS n, max(age) AS oldest FROM cases GROUP BY pt, classification",
)

def _balanced_ranges(spark, sf):
    """Rows of orders in each of 12 ranges of the day, and how often ranges overlap; some days are missing, one is hot."""
    orders = fx.table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 11 == 0, None).when(F.col("o_orderkey") % 3 == 0, F.lit("1996-02-29").cast("date"))
        .otherwise(F.col("o_orderdate").cast("date")).alias("day")
    )
    histogram = orders.groupBy(F.col("day").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    met = [F.coalesce(F.expr(p), F.lit(False)) for p in tables.balanced_predicates(histogram, 12, "day")]
    hits = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(met)]))
    rows = orders.select(F.explode(hits).alias("range_no"), F.size(hits).alias("times"), "day")
    return rows.groupBy("range_no").agg(
        F.count(F.lit(1)).alias("n"), F.max("times").alias("times"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.count_if(F.col("day").isNull()).alias("without_day"),
    )


add(
    "balanced_ranges",
    _balanced_ranges,
    """WITH o AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN DATE '1996-02-29'
        ELSE CAST(o_orderdate AS DATE) END AS day FROM orders),
h AS (SELECT day, count(*) AS n, sum(count(*)) OVER (ORDER BY day) AS upto, sum(count(*)) OVER () AS total
      FROM o WHERE day IS NOT NULL GROUP BY day),
r AS (SELECT day, least(CAST(2 * upto - n AS HUGEINT) * 12 // CAST(2 * total AS HUGEINT), 11) AS range FROM h),
d AS (SELECT day, dense_rank() OVER (ORDER BY range) - 1 AS range_no FROM r)
SELECT CAST(coalesce(range_no, 0) AS INTEGER) AS range_no, count(*) AS n, 1 AS times, min(o.day) AS first_day,
  max(o.day) AS last_day, count(*) - count(o.day) AS without_day
FROM o LEFT JOIN d ON o.day = d.day GROUP BY coalesce(range_no, 0)""",
)


def _latin1(spark, sf):
    """Texts as an old database stores them, a byte for each letter, and what they were meant to be."""
    docs = fx.table(spark, sf, "documents").select("doc_id", F.encode("text", "ISO-8859-1").cast("string").alias("text"))
    return text.latin1_text(docs)


add("latin1_text", _latin1, "SELECT doc_id, regexp_replace(text, '[^\\x{0}-\\x{FF}]', '?', 'g') AS text FROM documents")

_RESUMED = {"by_region": "pt", "by_sex": "sex", "by_class": "classification", "by_unit": "ageunit"}


def _resumed_batch(spark, sf):
    """Four reports of which the third fails at first; how often each was made, and what readers find."""
    out, cases, made = scratch_path(spark, "batch"), fx.cases(spark, sf), []

    def report(name, col):
        def source(_):
            made.append(name)
            if made == ["by_region", "by_sex", "by_class"]:
                raise InterruptedError(name)
            return cases.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))

        return extracts.Extract(name, source, f"{out}/{name}", saving_func="save_parquet")

    config = [report(n, c) for n, c in _RESUMED.items()]
    manifest = publish.Manifest(spark, f"{out}/manifest")
    try:
        for _ in range(2):
            with contextlib.suppress(InterruptedError):
                extracts.run_due(spark, config, dt.date.fromisoformat(ASOF), manifest=manifest)
        found = [
            spark.read.parquet(e.path).select(F.lit(e.nm).alias("nm"), "value", "n", F.lit(made.count(e.nm)).alias("times_made"))
            for e in config
        ]
        return materialise(reduce(lambda a, b: a.unionByName(b), found))
    finally:
        remove_path(spark, out)


add(
    "resumed_batch",
    _resumed_batch,
    f"{W} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS nm, {c} AS value, count(*) AS n, {1 + (n == 'by_class')} AS times_made FROM cases GROUP BY {c}"
        for n, c in _RESUMED.items()
    ),
)

_CSV = ["phacid", "pt", "sex", "occupationspec", "onsetdate", "age"]


def _csv(spark, sf):
    path = scratch_path(spark, "csv")
    df = fx.cases(spark, sf)
    try:
        sinks.save_csv(df, path)
        return materialise(tables.read_csv(spark, path, df.schema))
    finally:
        remove_path(spark, path)


add(
    "csv_roundtrip",
    _csv,
    f"{W} SELECT " + ", ".join(f"nullif({c}, '') AS {c}" if c in _TEXT_COLS else c for c in _FIRST_COLS) + " FROM cases",
)


def _truncated(spark, sf):
    df = fx.cases(spark, sf).select(
        "phacid", F.col("age").alias("age_of_the_case_in_completed_years_at_report")
    )
    return sinks.truncate_names(df)


add("truncate_names", _truncated, f"{W} SELECT phacid, age AS age_of_the_case_in_completed_yea FROM cases")


def _table(spark, sf):
    path = scratch_path(spark, "table")
    name = "caseloom_" + path.rsplit("-", 1)[1]
    try:
        sinks.save_table(fx.cases(spark, sf), name, path=path)
        return materialise(spark.table(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_path(spark, path)


add("table_roundtrip", _table, f"{W} SELECT * FROM cases")


def _parquet(spark, sf):
    path = scratch_path(spark, "parquet")
    try:
        sinks.save_parquet(fx.cases(spark, sf), path)
        return materialise(spark.read.parquet(path))
    finally:
        remove_path(spark, path)


add("parquet_roundtrip", _parquet, f"{W} SELECT * FROM cases")


def _config(spark, sf):
    """One schedule row per customer: a week of flags that are filled, blank or punctuation."""
    k = F.col("c_custkey")
    flags = []
    for i, day in enumerate(extracts.WEEKDAYS):
        v = F.when((k + i) % 5 == 0, F.lit("x")).when((k + i) % 5 == 1, F.lit(" - "))
        flags.append(v.when((k + i) % 5 == 2, F.lit("")).when((k + i) % 5 == 3, F.lit("yes")).alias(day))
    return fx.table(spark, sf, "customer").select(F.col("c_name").alias("nm"), *flags)


add(
    "due_extracts",
    lambda spark, sf: extracts.due(_config(spark, sf), ASOF),
    # 30 June 2001 is a Saturday, the sixth weekday column
    "SELECT c_name AS nm FROM customer WHERE (c_custkey + 5) % 5 IN (0, 3)",
)


_MODEL_COLS = ["phacid", "hospstatus", "sexgender2", "occupation2"]


def _contents(df, name):
    """Rows and a sum over the rows' digests: columns by name, missing cells as blanks."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(df.columns)]
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("long")
    return df.agg(F.lit(name).alias("nm"), F.count(F.lit(1)).alias("n_rows"), F.sum(digest).alias("checksum"))


_BATCH_VIEWS = {
    "all_cases": _CSV, "all_cases_web": clean.WEB_COLUMNS, "who": clean.TREND_COLUMNS, "statscan": clean.WEEKLY_COLUMNS,
    "modelling_data": _MODEL_COLS,
}


def _run_extract(spark, sf):
    out = scratch_path(spark, "extracts")
    try:
        return _batch(spark, sf, out)
    finally:
        remove_path(spark, out)


def _batch(spark, sf, out):
    line_list, views = fx.cases(spark, sf).columns, _BATCH_VIEWS | {"data_hub": HUB_COLS}
    # every extract reads some of these columns, so they are made once
    kept = reports.keep_columns(published(spark, sf), [*line_list, *chain(*views.values())], f"{out}/published")
    cases = kept.select(*line_list)
    cases.createOrReplaceTempView("caseloom_run_cases")
    sql = "select * from caseloom_run_cases"
    reports.publish_views(kept, views)
    config = [
        *extracts.report_extracts(out, {"WHO": {"Mon": "x"}}),
        extracts.Extract("all", sql, f"{out}/all", saving_func="save_parquet", copy_path=f"{out}/copy"),
        extracts.Extract("no_ids", sql, f"{out}/no_ids", adjust_func="remove_pt_cols", copy_path=f"{out}/no_ids_copy"),
        extracts.Extract("regions", lambda s: cases.select("pt").distinct(), f"{out}/regions"),
        extracts.Extract("weekdays_only", sql, f"{out}/never", days={"Mon": "x", "Sat": " "}),
    ]
    written = extracts.end_of_day(
        spark, cases, config, out, asof=dt.date.fromisoformat(ASOF), min_date=MIN_DATE,
        after=["ijn", "count_summary"], days={"count_summary": {"Fri": "x"}}, share=False,
    )
    frames = []
    for name, path in [*written.items(), ("copy", f"{out}/copy"), ("no_ids_copy", f"{out}/no_ids_copy")]:
        reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        frames.append(_contents(spark.read.parquet(path) if name in ("all", "copy") else reader.csv(path), name))
    return materialise(reduce(lambda a, b: a.unionByName(b), frames))


_DEFAULT_RULES = [n for n in S.RULE_SQL if n != "close_contact_details"]
_ALL_ERRORS = "\nUNION ALL\n".join(
    S.rule_sql(n, "phacid, pt, ptcaseid, classification, phacreporteddate") for n in _DEFAULT_RULES
)
_DATE_OK = "CASE WHEN {0} >= phacreporteddate - 16 THEN {0} END"
_TRAVEL_SQL = f"""
  SELECT phacreporteddate, pt, ptcaseid, phacid, {S.EPISODE} AS episodedate, {S.EPISODE_TYPE} AS episodetype, age, sex,
         residency, travelfromcountry1, traveltocountry1,
         {_DATE_OK.format('travelstartdate1')} AS travelstartdate1,
         {_DATE_OK.format('travelenddate1')} AS travelenddate1, exposure_cat, classification
  FROM cases
  WHERE classification IN ('Confirmed', 'Probable') AND exposure_cat = 'International travel'
    AND phacreporteddate BETWEEN DATE '{{asof}}' - {{reported}} AND DATE '{{asof}}' - 1
    AND {S.EPISODE} BETWEEN DATE '{{asof}}' - {{episode}} AND DATE '{{asof}}' + 1
    AND CASE WHEN travelstartdate1 IS NULL AND travelenddate1 IS NULL THEN {S.EPISODE} >= phacreporteddate - 16
        ELSE travelstartdate1 >= phacreporteddate - 16 OR travelenddate1 >= phacreporteddate - 16 END"""

REPORT_CONFIG = [
    clean.Cleaning("weekly", "PHACID", "no"),
    clean.Cleaning("weekly", "PT", "Yes", "Do Not", "", "str_to_lower"),
    clean.Cleaning("weekly", "occupationspec", "yes", "-", "not stated", "str_to_upper"),
    clean.Cleaning("weekly", "exposure_cat", "YES", "", "missing", "str_to_title"),
    clean.Cleaning("weekly", "sex", " yes ", "Do Not", "not stated", "str_to_same"),
    clean.Cleaning("weekly", "onsetdate", "yes"),
    clean.Cleaning("weekly", "age", "yes"),
    clean.Cleaning("other", "age"),
]
add(
    "report_columns",
    lambda spark, sf: clean.select_report(fx.cases(spark, sf), REPORT_CONFIG, "weekly"),
    f"{W} SELECT phacid, pt, occupationspec, exposure_cat, sex, onsetdate, age FROM cases",
)
add(
    "final_clean_report",
    lambda spark, sf: clean.final_clean(
        fx.cases(spark, sf), "weekly", clean.report_columns(REPORT_CONFIG, "weekly"), REPORT_CONFIG
    ),
    f"""{W} SELECT phacid, trim(lower({S.squeeze('pt')})) AS pt,
  trim(upper({S.squeeze("coalesce(nullif(regexp_replace(occupationspec, '[[:punct:]]', '-', 'g'), ''), 'not stated')")})) AS occupationspec,
  trim({S.title(S.squeeze("coalesce(nullif(regexp_replace(exposure_cat, '[[:punct:]]', '', 'g'), ''), 'missing')"))}) AS exposure_cat,
  trim({S.squeeze("coalesce(nullif(sex, ''), 'not stated')")}) AS sex, onsetdate, age FROM cases""",
)

_DERIVED = {
    "episodetype": S.EPISODE_TYPE, "hospstatus": S.HOSP_STATUS, "sexgender2": S.SEX, "occupation2": S.OCCUPATION,
    "healthcare_worker2": S.WORKER, "ltc_resident2": S.RESIDENT, "asymptomatic2": S.ASYMPTOMATIC,
    "disposition2": S.DISPOSITION, "resolutiondate2": S.RECOVERY, "exposure_cat2": S.EXPOSURE,
    "exposurecountry": S.COUNTRY,
}
_PUBLISHED_EXTRA = {
    "age_years": "age", "gender": "sex", "sexgender": "sex", "sex_excunk": "nullif(sex, '')",
    "earliestdate": "least(onsetdate, earliestlabcollectiondate, earliestlabtestresultdate)",
    "earliestdatetype": "CASE WHEN onsetdate IS NULL THEN 'lab' ELSE 'onset' END",
    "last_refreshed": f"DATE '{ASOF}'", "mincontactcaseid": "phacid",
}
_EXTRA_SQL = ", ".join(f"{v} AS {k}" for k, v in _PUBLISHED_EXTRA.items())
_DERIVED_SQL = ", ".join(f"{v} AS {k}" for k, v in _DERIVED.items())
WITH_PUBLISHED = f"{W}, published AS (SELECT *, {_EXTRA_SQL}, {_DERIVED_SQL} FROM cases)"


def published(spark, sf):
    df = reports.all_cases(fx.cases(spark, sf))
    return df.selectExpr("*", *[f"{v} AS {k}" for k, v in _PUBLISHED_EXTRA.items()])


# data_hub columns that the given tables can fill; the SQL lists them on its own
HUB_COLS = [c for c in clean.DATA_HUB_COLUMNS if c not in (
    "symchills", "symsorethroat", "symrunnynose", "symshortnessofbreath", "symnausea", "symheadache",
    "symweakness", "sympain", "symirritability", "symdiarrhea",
)]
_HUB_SQL = (
    "phacid, pt, episodedate, classification, sexgender2, agegroup10, age, occupation2, healthcare_worker2, ltc_resident, "
    "asymptomatic2, onsetdate, reporteddate, symcough, symfever, symother, symotherspec, hospstatus, disposition2, "
    "resolutiondate2, exposure_cat2"
)


def _hcdaily(spark, sf):
    return reports.report({"data_hub": published(spark, sf).select(*HUB_COLS)}, "HCDaily")


add(
    "report_hcdaily",
    _hcdaily,
    f"{WITH_PUBLISHED} SELECT {_HUB_SQL.replace('pt, ', '', 1)} FROM published",
)
_HUB_LIST = _HUB_SQL.split(", ")
_KEPT = [c for c in _FIRST_COLS if c not in clean.IDENTIFIER_COLUMNS]
_IJN = [
    "phacreporteddate", "pt", "ptcaseid", "phacid", "episodedate", "episodetype", "age", "sex", "residency",
    "travelfromcountry1", "traveltocountry1", "travelstartdate1", "travelenddate1", "exposure_cat", "classification",
]


def _written() -> dict[str, str]:
    """What the batch of 30 June 2001, a Saturday, writes: the count summary and WHO are not due."""
    head = (
        f"(SELECT DATE '{ASOF}' AS asof, c AS n_cases, d AS n_deaths, 'Total Confirmed & Probable cases in database on "
        f"{ASOF} EOD is ''' || format('{{:,}}', c) || ''' while Deaths are ''' || format('{{:,}}', d) || '''' AS message "
        "FROM (SELECT count(*) AS c, count(*) FILTER (lower(coviddeath) = 'yes') AS d FROM cases "
        "WHERE classification <> 'Suspect'))"
    )
    return {
        "daily_headline": S.checksum(["asof", "n_cases", "n_deaths", "message"], head),
        "db_errs": S.checksum(["phacid", "pt", "ptcaseid", "typ", "classification", "phacreporteddate", "err"], "errs"),
        "stats_can": S.checksum(clean.WEEKLY_COLUMNS, "published"),
        "data_hub": S.checksum(_HUB_LIST, "published"),
        "hc_daily": S.checksum([c for c in _HUB_LIST if c != "pt"], "published"),
        "domestic_surveillance": S.checksum(_MODEL_COLS, "published"),
        "qry_allcases_web": S.checksum(clean.WEB_COLUMNS, "published"),
        "qry_allcases": S.checksum(_CSV, "published"),
        "all": S.checksum(_FIRST_COLS, "cases"), "copy": S.checksum(_FIRST_COLS, "cases"),
        "no_ids": S.checksum(_KEPT, "cases"), "no_ids_copy": S.checksum(_KEPT, "cases"),
        "regions": S.checksum(["pt"], "(SELECT DISTINCT pt FROM cases)"),
        "ijn": S.checksum(_IJN, "ijn"),
    }


add(
    "run_extract",
    _run_extract,
    f"""{S.WITH_RULES}, published AS (SELECT *, {_EXTRA_SQL}, {_DERIVED_SQL} FROM cases),
errs AS ({_ALL_ERRORS}), ijn AS ({_TRAVEL_SQL.format(asof=ASOF, reported=7, episode=14)})
""" + " UNION ALL ".join(f"SELECT '{n}' AS nm, {body}" for n, body in _written().items()),
)

# ---- text and categories ----------------------------------------------------------


def doc_query(name: str, out: str, column, sql: str) -> None:
    add(
        name,
        lambda spark, sf: fx.table(spark, sf, "documents").select("doc_id", column(None).alias(out)),
        f"SELECT doc_id, {sql} AS {out} FROM documents",
    )


doc_query("clean_str", "cleaned", lambda df: text.clean_str("text"), S.clean("text"))
doc_query("clean_str_b", "cleaned", lambda df: text.clean_str_b("text"), S.trim(S.title(S.squeeze("text"))))
doc_query("number_to_id", "id_text", lambda df: text.number_to_id("text"), "replace(text, ' ', '-')")
row_query(
    "clean_str_defaults", "cleaned",
    lambda df: text.clean_str("occupationspec", na_replace="NULL or BLANK", blank_replace="NULL or BLANK"),
    S.clean("occupationspec", na="NULL or BLANK", blank="NULL or BLANK"),
)
row_query(
    "clean_categorical", "sex_clean",
    lambda df: cat.clean_categorical("sex", ["male", "female"], bad_value_replace="not stated", other_replace="other"),
    S.category("sex", ["Male", "Female"], other="Other", blank="Not Stated"), "sex",
)
row_query("clean_yes_no", "fever", lambda df: cat.clean_yes_no("symfever"), S.yn("symfever"), "symfever")
row_query(
    "clean_yes_no_mapped", "fever", lambda df: cat.clean_yes_no("symfever", map_yn=True),
    S.yn("CASE lower(symfever) WHEN 'y' THEN 'yes' WHEN 'n' THEN 'no' ELSE symfever END"), "symfever",
)
row_query("clean_up", "value", lambda df: text.clean_up("hosp"),
          "coalesce(CASE WHEN lower(trim(hosp)) IN ('unknown', 'unk', 'not asked') THEN '' "
          "ELSE lower(trim(hosp)) END, '')", "hosp")
row_query("insert_str", "id_text", lambda df: text.insert_str("ptcaseid", "-", after=2),
          "substr(ptcaseid, 1, 2) || '-' || substr(ptcaseid, 3)")


def _top_n(spark, sf):
    df = fx.cases(spark, sf).select("phacid", "disposition")
    return cat.clean_categorical_top_n(df, "disposition", 3, out="disposition_top")


add(
    "clean_categorical_top_n",
    _top_n,
    f"""{W}, c AS (SELECT phacid, disposition, {S.clean('disposition')} AS v FROM cases),
t AS (SELECT v FROM c GROUP BY v ORDER BY count(*) DESC, v LIMIT 3)
SELECT phacid, disposition, CASE WHEN v = '' OR v IN (SELECT v FROM t) THEN v ELSE 'Unknown' END AS disposition_top
FROM c""",
)


def _names(spark, sf):
    df = fx.cases(spark, sf)
    messy = df.select(
        F.col("phacid").alias("PHACID"), F.col("ptcaseid").alias("PTCaseID"),
        F.col("onsetdate").alias("Onset Date"), F.col("age").alias("% age"), F.col("k").alias("onset.date"),
    )
    return text.clean_names(messy)


add(
    "clean_names",
    _names,
    f"{W} SELECT phacid, ptcaseid AS pt_case_id, onsetdate AS onset_date, age AS percent_age, k AS onset_date_2 FROM cases",
)
add(
    "number_labels",
    lambda spark, sf: fx.cases(spark, sf).groupBy("pt").agg(
        F.count(F.lit(1)).alias("n"), F.count("onsetdate").alias("m")
    ).select("pt", text.thousands("n").alias("n_label"),
             text.percent_label(F.col("m") / F.col("n")).alias("share_label")),
    f"{W} SELECT pt, format('{{:,}}', count(*)) AS n_label, "
    "CAST(CAST(round_even(100 * count(onsetdate) / count(*), 0) AS BIGINT) AS VARCHAR) || '%' AS share_label "
    "FROM cases GROUP BY pt",
)

# ---- derived columns --------------------------------------------------------------

row_query(
    "first_good_value", "value", lambda df: derive.first_good_value(["icuenddate", "hospenddate", "deathdate"], derive.EPOCH),
    "coalesce(icuenddate, hospenddate, deathdate)",
)
row_query(
    "first_good_label", "label", lambda df: derive.first_good_label(["icu", "hosp", "symotherspec"], ["a", "b", "c"]),
    "CASE WHEN icu <> '' THEN 'a' WHEN hosp <> '' THEN 'b' WHEN symotherspec <> '' THEN 'c' ELSE '' END",
)
row_query("episode_date", "episode_date", lambda df: derive.episode_date(), S.EPISODE)
row_query("episode_type", "episode_type", lambda df: derive.episode_type(), S.EPISODE_TYPE)
row_query("hosp_status", "hospstatus", lambda df: derive.hosp_status(), S.HOSP_STATUS)
row_query("hospitalized", "hospitalized", lambda df: derive.hospitalized(), S.HOSPITALIZED)
row_query("icu_flag", "intensivecareunit", lambda df: derive.icu_flag(), S.ICU_FLAG)
row_query("indigenous2", "indigenous2", lambda df: derive.indigenous2(), S.INDIGENOUS)
row_query("asymptomatic2", "asymptomatic2", derive.asymptomatic2, S.ASYMPTOMATIC)
row_query("death_flag", "death", lambda df: derive.death_flag(), S.DEATH)
row_query("sex2", "sex2", lambda df: derive.sex2(), S.SEX)
row_query("occupation2", "occupation2", lambda df: derive.occupation2(), S.OCCUPATION)
row_query("healthcare_worker2", "healthcare_worker2", lambda df: derive.healthcare_worker2(), S.WORKER)
row_query("ltc_resident2", "ltc_resident2", lambda df: derive.ltc_resident2(), S.RESIDENT)
row_query("onset_date_text", "onsetdate2", lambda df: derive.onset_date_text(), S.ONSET_TEXT)
row_query("disposition2", "disposition2", lambda df: derive.disposition2(), S.DISPOSITION)
row_query("recovery_date2", "recoverydate2", lambda df: derive.recovery_date2(), S.RECOVERY)
row_query("exposure_country", "exposurecountry", derive.exposure_country, S.COUNTRY)
row_query("exposure_cat2", "exposure_cat2", lambda df: derive.exposure_cat2(), S.EXPOSURE)
row_query(
    "age_group10", "age_band", lambda df: derive.age_group10("age", "agegroup10"),
    "CASE WHEN age <= 19 OR agegroup10 = '0-19' THEN '0 to 19' "
    + " ".join(f"WHEN age <= {n + 9} OR agegroup10 = '{n}-{n + 9}' THEN '{n} to {n + 9}'" for n in range(20, 80, 10))
    + " WHEN age >= 80 OR agegroup10 = '80+' THEN '80 or plus' ELSE 'unknown' END",
)


def _comorbidity(spark, sf):
    df = fx.cases(spark, sf)
    return df.select("phacid", *[c.alias(n) for n, c in derive.comorbidity_columns(df).items()])


add(
    "comorbidity",
    _comorbidity,
    f"""{W}, v AS (SELECT phacid, {S.yn('rfdiabetes')} AS a, {S.yn('rfcardiacdisease')} AS b FROM cases)
SELECT phacid, CASE WHEN a = 'Yes' OR b = 'Yes' THEN 'Yes' ELSE '' END AS comorbidityyes,
  CASE WHEN a = 'No' AND b = 'No' THEN 'No' ELSE '' END AS comorbidityno,
  CAST((CASE WHEN a = 'Yes' THEN 1 ELSE 0 END) + (CASE WHEN b = 'Yes' THEN 1 ELSE 0 END) AS DOUBLE) AS countrf,
  CASE WHEN a = 'Yes' OR b = 'Yes' THEN 'Yes' WHEN a = 'No' AND b = 'No' THEN 'No' ELSE 'Unknown' END AS comorbidity
FROM v""",
)

# ---- cleaning and projection jobs -------------------------------------------------


def _projection(name: str, adjust, cols: list[str]) -> None:
    add(
        name,
        lambda spark, sf: published(spark, sf).transform(adjust),
        f"{WITH_PUBLISHED} SELECT {', '.join(cols)} FROM published",
    )


_projection("keep_trend_cols", clean.keep_trend_cols, clean.TREND_COLUMNS)
_projection("keep_web_cols", clean.keep_web_cols, clean.WEB_COLUMNS)
_projection("keep_weekly_cols", clean.keep_weekly_cols, clean.WEEKLY_COLUMNS)
_VARIANT = {"variantid": "k % 5", "variantidentified": "nullif(sex, '')",
            "variantscreenresult": "hosp", "variantsequenceresult": "icu"}
add(
    "keep_trend_variant_cols",
    lambda spark, sf: clean.keep_trend_variant_cols(
        published(spark, sf).selectExpr("*", *[f"{v} AS {k}" for k, v in _VARIANT.items()])
    ),
    f"{WITH_PUBLISHED} SELECT {', '.join(clean.TREND_COLUMNS)}, "
    f"{', '.join(f'{v} AS {k}' for k, v in _VARIANT.items())} FROM published",
)
add(
    "drop_identifiers",
    lambda spark, sf: clean.drop_identifiers(published(spark, sf).select(*HUB_COLS)),
    f"{WITH_PUBLISHED} SELECT {', '.join(c for c in HUB_COLS if c not in clean.IDENTIFIER_COLUMNS)} FROM published",
)
add(
    "drop_retired",
    lambda spark, sf: clean.drop_retired(published(spark, sf).select("phacid", "mincontactcaseid", "age")),
    f"{WITH_PUBLISHED} SELECT phacid, age FROM published",
)
add(
    "adjust_registry",
    lambda spark, sf: published(spark, sf)
    .select("phacid", F.col("age").alias("AgeYears"), "mincontactcaseid")
    .transform(extracts.by_name(extracts.ADJUSTERS, "remove_retired_cols", extracts.do_nothing))
    .transform(extracts.by_name(extracts.ADJUSTERS, "no such name", extracts.do_nothing))
    .transform(extracts.by_name(extracts.ADJUSTERS, "", text.clean_names)),
    f"{WITH_PUBLISHED} SELECT phacid, age AS age_years FROM published",
)


def _one_time_sql() -> str:
    parts = ["k", "age"]
    for c in _TEXT_COLS:
        v = f"coalesce({S.trim('lower(' + S.squeeze(c) + ')')}, '')"
        v = f"replace({v}, ' ', '-')" if c == "phacid" else f"upper({v})" if c == "pt" else v
        parts.append(f"{v} AS {c}")
    parts += [f"strftime({d}, '%Y-%m-%d') AS {d}" for d in S.DATES]
    return f"{W} SELECT {', '.join(parts)} FROM cases"


add("one_time_clean", lambda spark, sf: clean.one_time_clean(fx.cases(spark, sf)), _one_time_sql())

# ---- imputation -------------------------------------------------------------------

SOURCES = [c for c in impute.SOURCES if c != "earliestdate"]
add(
    "impute_dates",
    lambda spark, sf: impute.impute_dates(fx.cases(spark, sf), sources=SOURCES, key=F.col("k")).select(
        "phacid", "pt", *impute.TARGETS, *[f"{t}_imputed" for t in impute.TARGETS]
    ),
    S.impute_sql(
        impute.TARGETS, SOURCES, cte=W, base="cases",
        final="SELECT phacid, pt, onsetdate, episodedate, reporteddate, onsetdate_imputed, episodedate_imputed, "
        "reporteddate_imputed FROM imputed",
    ),
)
add(
    "imputed_date",
    lambda spark, sf: impute.imputed_date(
        fx.cases(spark, sf), "reporteddate", ["onsetdate", "earliestlabcollectiondate", "earliestlabtestresultdate"],
        key=F.col("k"), seed=11, suppress_out_of_range=False,
    ).select("phacid", "reporteddate_imputed"),
    S.impute_sql(
        ["reporteddate"], ["onsetdate", "earliestlabcollectiondate", "earliestlabtestresultdate"], cte=W,
        base="cases", group="''", seed=11, suppress=False, final="SELECT phacid, reporteddate_imputed FROM imputed",
    ),
)
add(
    "date_deltas",
    lambda spark, sf: impute.date_deltas(
        fx.cases(spark, sf), "onsetdate", SOURCES, group="pt", key=F.col("k"), seed=5
    ),
    S.impute_sql(
        ["onsetdate"], SOURCES, cte=W, base="cases", seed=5,
        final="SELECT phacid, grp AS pt, source, CAST(fgap AS INT) AS gap, gap IS NULL AS drawn FROM filled",
    ),
)
_HUB_IMPUTED = ", ".join(f"{t}_imputed" for t in impute.TARGETS)
add(
    "data_hub",
    lambda spark, sf: reports.data_hub(published(spark, sf), cols=HUB_COLS, key=F.col("k")),
    S.impute_sql(
        impute.TARGETS, SOURCES, cte=WITH_PUBLISHED, base="published",
        final=f"SELECT {_HUB_SQL}, {_HUB_IMPUTED} FROM imputed",
    ),
)
HUB_CONFIG = [
    clean.Cleaning("DataHub", "phacid", "no"),
    clean.Cleaning("DataHub", "pt", "yes", "Do Not", "", "str_to_lower"),
    clean.Cleaning("DataHub", "EpisodeDate"),
    clean.Cleaning("DataHub", "occupation2", "yes", " ", "not stated", "str_to_lower"),
    *[clean.Cleaning("DataHub", c, "no") for c in (
        "healthcare_worker2", "asymptomatic2", "onsetdate2", "hospstatus", "disposition2", "recoverydate2",
        "exposure_cat2", "onsetdate_imputed", "episodedate_imputed",
    )],
]
_FULL = f"""{W}, hub AS (SELECT phacid, pt, k, phacreporteddate, reporteddate, onsetdate, earliestlabcollectiondate,
  earliestlabtestresultdate, {S.EPISODE} AS episodedate, {S.OCCUPATION} AS occupation2, {S.WORKER} AS healthcare_worker2,
  {S.ASYMPTOMATIC} AS asymptomatic2, {S.ONSET_TEXT} AS onsetdate2, {S.HOSP_STATUS} AS hospstatus,
  {S.DISPOSITION} AS disposition2, {S.RECOVERY} AS recoverydate2, {S.EXPOSURE} AS exposure_cat2
  FROM cases WHERE classification = 'Confirmed')"""
add(
    "data_hub_full",
    lambda spark, sf: reports.data_hub_full(fx.cases(spark, sf), HUB_CONFIG, key=F.col("k"), seed=3),
    S.impute_sql(
        ["onsetdate", "episodedate"], SOURCES, cte=_FULL, base="hub", seed=3, suppress=False,
        final="SELECT phacid, lower(pt) AS pt, episodedate, trim(lower(" + S.squeeze(
            "regexp_replace(occupation2, '[[:punct:]]', '', 'g')") + ")) AS occupation2, healthcare_worker2, "
        "asymptomatic2, onsetdate2, hospstatus, disposition2, recoverydate2, exposure_cat2, onsetdate_imputed, "
        "episodedate_imputed FROM imputed",
    ),
)

# ---- report tables ----------------------------------------------------------------

add(
    "missing_fraction",
    lambda spark, sf: summary.missing_fraction(fx.cases(spark, sf), _FIRST_COLS),
    f"{W}, m AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS colnm, (count(*) - count({c})) / count(*) AS missing_fraction FROM cases"
        for c in _FIRST_COLS
    )
    + ") SELECT * FROM m WHERE missing_fraction > 0",
)
add(
    "onset_month_counts",
    lambda spark, sf: summary.onset_month_counts(fx.cases(spark, sf)),
    f"{W} SELECT pt, CAST(month(onsetdate) AS INT) AS month_onset, exposure_cat, count(*) AS n FROM cases GROUP BY ALL",
)
add(
    "report_delay_hist",
    lambda spark, sf: summary.report_delay_hist(fx.cases(spark, sf)),
    f"""{W}, s AS (SELECT *, count(*) OVER (PARTITION BY pt) AS size FROM cases)
SELECT pt, CAST(reporteddate - onsetdate AS INT) AS report_delay, count(*) AS n FROM s
WHERE size >= 1000 AND agegroup20 <> 'Unknown' AND reporteddate - onsetdate BETWEEN -3 AND 21 GROUP BY ALL""",
)
add(
    "daily_headline",
    lambda spark, sf: summary.daily_headline(fx.cases(spark, sf), asof=ASOF),
    f"""{W}, h AS (SELECT count(*) AS n_cases, count(*) FILTER (lower(coviddeath) = 'yes') AS n_deaths FROM cases
  WHERE classification IN ('Confirmed', 'Probable'))
SELECT DATE '{ASOF}' AS asof, n_cases, n_deaths,
  'Total Confirmed & Probable cases in database on {ASOF} EOD is ''' || format('{{:,}}', n_cases) ||
  ''' while Deaths are ''' || format('{{:,}}', n_deaths) || '''' AS message FROM h""",
)
add(
    "recent_travel_cases",
    # a wider window than the daily one, so that small tables give rows too
    lambda spark, sf: summary.recent_travel_cases(
        fx.cases(spark, sf), asof=ASOF, reported_days=400, episode_days=410
    ),
    f"{W} {_TRAVEL_SQL.format(asof=ASOF, reported=400, episode=410)}",
)

# punctuation is removed where the configuration says so, and a cell that holds nothing else is empty
_COMPLETE_CONFIG = [clean.Cleaning(summary.COMPLETENESS, c, "yes", " ") for c in ("symcough", "ltc_resident", "Sex")]


def _complete_input(spark, sf):
    return fx.cases(spark, sf).withColumnRenamed("sex", "Sex")


def _complete_long(where: str = "") -> str:
    cells = {c: f"coalesce(CAST({c} AS VARCHAR), '')" for c in _FIRST_COLS if c not in ("phacid", "pt")}
    for c in ("symcough", "ltc_resident", "sex"):
        cells[c] = f"regexp_replace({cells[c]}, '[[:punct:] ]', '', 'g')"
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS colnm, pt, count(*) FILTER ({v} <> '') AS has_data, count(*) FILTER ({v} = '') AS no_data, "
        "count(*) AS total FROM kept GROUP BY pt"
        for c, v in cells.items()
    )
    return f"{W}, kept AS (SELECT * FROM cases WHERE classification IN ('Confirmed', 'Probable'){where}), long AS ({long})"


add(
    "completeness_long",
    lambda spark, sf: summary.completeness(_complete_input(spark, sf), config=_COMPLETE_CONFIG),
    f"{_complete_long()} SELECT *, has_data / total AS fraction_complete FROM long",
)
_PTS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
add(
    "completeness_wide",
    lambda spark, sf: summary.completeness_wide(_complete_input(spark, sf), config=_COMPLETE_CONFIG),
    _complete_long() + " SELECT colnm, "
    + ", ".join(
        f'max({v}) FILTER (pt = \'{p}\') AS "{m}_{p}"'
        for m, v in (("has_data", "has_data"), ("no_data", "no_data"), ("total", "total"),
                     ("fraction_complete", "has_data / total"))
        for p in _PTS
    )
    + " FROM long GROUP BY colnm",
)


def _suggestion_sql() -> str:
    cols = [c for c in _TEXT_COLS if c not in ("phacid", "pt", "ptcaseid")]
    cells = "\n UNION ALL ".join(
        f"SELECT phacid, pt, ptcaseid, phacreporteddate, '{c}' AS varname, {c} AS old_value FROM cases "
        "WHERE classification IN ('Confirmed', 'Probable')"
        for c in cols
    )
    return f"""{W}, cells AS ({cells}),
spelled AS (SELECT varname, old_value, count(*) AS n, {S.clean('old_value')} AS cleaned FROM cells
  GROUP BY varname, old_value),
best AS (SELECT varname, cleaned, old_value AS new_value FROM spelled
  QUALIFY row_number() OVER (PARTITION BY varname, cleaned
    ORDER BY n DESC, old_value IS NULL, old_value COLLATE C) = 1)
SELECT c.phacid, c.pt, c.ptcaseid, c.phacreporteddate, c.varname, c.old_value, b.new_value, '' AS approved
FROM cells c JOIN spelled s ON s.varname = c.varname AND s.old_value = c.old_value
JOIN best b ON b.varname = c.varname AND b.cleaned = s.cleaned
WHERE c.old_value <> b.new_value AND b.new_value <> ''"""


add("suggest_value_fixes", lambda spark, sf: summary.suggest_value_fixes(fx.cases(spark, sf)),
    _suggestion_sql().replace(" COLLATE C", ""))


def _summary_sql(strats: tuple[str, str] = ("pt", "agegroup10")) -> str:
    s1, s2 = strats
    plain = [c for c in ["k", "age", *_TEXT_COLS]
             if c not in ("phacid", "ptcaseid", *strats) and not c.endswith("spec")]
    label = "NULL or BLANK STRING"
    cells = [
        f"SELECT '{c}' AS name, {S.clean(c, na=label, blank=label)} AS value, {s1}, {s2} FROM cases" for c in plain
    ]
    for d in S.DATES:
        for suffix, e in (("month", f"month({d})"), ("week", S.WEEK.format(d)), ("dow", f"dayofweek({d}) + 1")):
            cells.append(
                f"SELECT '{d}_{suffix}' AS name, coalesce(CAST({e} AS VARCHAR), {S.q(S_LABEL)}) AS value, {s1}, {s2} "
                "FROM cases"
            )
    joined = "\n UNION ALL ".join(cells)
    return f"""{W}, cells AS ({joined}),
g AS (SELECT name, value, {s1}, {s2}, count(*) AS n FROM cells GROUP BY ALL),
few AS (SELECT name FROM g GROUP BY name HAVING count(DISTINCT value) <= 60)
SELECT name, value, {s1}, {s2}, n, CAST(sum(n) OVER w AS BIGINT) AS n_all_strats, n / sum(n) OVER w AS f_all_strats,
  CAST(sum(n) OVER v1 AS BIGINT) AS n_{s1}, CAST(sum(n) OVER d1 AS BIGINT) AS d_{s1},
  sum(n) OVER v1 / sum(n) OVER d1 AS f_{s1},
  CAST(sum(n) OVER v2 AS BIGINT) AS n_{s2}, CAST(sum(n) OVER d2 AS BIGINT) AS d_{s2},
  sum(n) OVER v2 / sum(n) OVER d2 AS f_{s2}
FROM g JOIN few USING (name)
WINDOW w AS (PARTITION BY name, {s1}, {s2}), v1 AS (PARTITION BY name, value, {s1}), d1 AS (PARTITION BY name, {s1}),
  v2 AS (PARTITION BY name, value, {s2}), d2 AS (PARTITION BY name, {s2})"""


S_LABEL = "Null Or Blank String"
add("count_summary", lambda spark, sf: summary.count_summary(fx.cases(spark, sf)), _summary_sql())

# ---- two sources ------------------------------------------------------------------

add(
    "symptoms_wide",
    lambda spark, sf: diff.symptoms_wide(fx.symptoms(spark, sf)),
    f"{S.WITH_SYMPTOMS} SELECT phacid, "
    + ", ".join(
        f"max(symptomvalue) FILTER (symptomid = {i}) AS {n}"
        for i, n in (
            (1, "asymptomatic"), (2, "symcough"), (3, "symfever"), (4, "symchills"), (5, "symsorethroat"),
            (6, "symrunnynose"), (7, "symshortnessofbreath"), (8, "symnausea"), (9, "symheadache"), (10, "symweakness"),
            (11, "sympain"), (12, "symirritability"), (13, "symdiarrhea"), (35, "symother"), (-1, "symna"),
        )
    )
    + " FROM symptoms GROUP BY phacid",
)


def _diagnoses(spark, sf):
    """Names come from a lookup table, which has none for the numbers 6 and 7."""
    long = fx.symptoms(spark, sf).select(
        "phacid", F.col("symptomid").alias("diagnosisid"), F.col("symptomvalue").alias("diagnosisvalue")
    )
    lookup = fx.table(spark, sf, "nation").where("n_nationkey BETWEEN 1 AND 5")
    return diff.diagnoses_wide(long, lookup.selectExpr("n_nationkey AS diagnosisid", "replace(n_name, '_', ' ') AS diagnosisname"))


add(
    "diagnoses_wide",
    _diagnoses,
    f"{S.WITH_SYMPTOMS} SELECT phacid, "
    + ", ".join(f"max(symptomvalue) FILTER (symptomid = {i}) AS dxnation_{i}" for i in range(1, 6))
    + ", max(symptomvalue) FILTER (symptomid > 5) AS dxna FROM symptoms GROUP BY phacid",
)
_REPORT = "phacid, pt, ptcaseid, phacreporteddate, classification"
add(
    "repeated_keys",
    lambda spark, sf: diff.repeated_keys(fx.symptoms(spark, sf), ["phacid", "symptomid"]),
    f"{S.WITH_SYMPTOMS} SELECT phacid, symptomid, count(*) AS n FROM symptoms GROUP BY ALL HAVING count(*) > 1",
)
add(
    "ambiguous_keys",
    lambda spark, sf: diff.ambiguous_keys(
        fx.symptoms(spark, sf), fx.symptoms(spark, sf).where("symptomvalue <> 'no'"), ["phacid", "symptomid"]
    ),
    f"{S.WITH_SYMPTOMS} SELECT phacid, symptomid, count(*) AS n_first, count(*) FILTER (symptomvalue <> 'no') AS n_second "
    "FROM symptoms GROUP BY ALL HAVING count(*) > 1",
)
add(
    "rows_missing_right",
    lambda spark, sf: diff.missing_rows(fx.first_source(spark, sf), fx.second_source(spark, sf)),
    f"{S.WITH_SOURCES} SELECT {_REPORT} FROM a WHERE NOT EXISTS "
    "(SELECT 1 FROM b WHERE b.pt = a.pt AND b.ptcaseid = a.ptcaseid)",
)
add(
    "rows_missing_left",
    lambda spark, sf: diff.missing_rows(fx.second_source(spark, sf), fx.first_source(spark, sf)),
    f"{S.WITH_SOURCES} SELECT {_REPORT} FROM b WHERE NOT EXISTS "
    "(SELECT 1 FROM a WHERE b.pt = a.pt AND b.ptcaseid = a.ptcaseid)",
)
_SECOND_COLS = [
    "phacid", "pt", "ptcaseid", "k", "classification", "phacreporteddate", "reporteddate", "onsetdate", "episodedate",
    "age", "agegroup20", "sex", "disposition", "symcough", "symfever", "coviddeath",
]
add(
    "columns_diff",
    lambda spark, sf: diff.columns_diff(
        fx.first_source(spark, sf), fx.second_source(spark, sf).withColumn("source", F.col("pt"))
    ),
    f"{S.WITH_SOURCES}, f AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS colname, count({c}) AS filled_first FROM a" for c in _FIRST_COLS)
    + "), s AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS colname, count({c}) AS filled_second FROM b" for c in _SECOND_COLS)
    + " UNION ALL SELECT 'source', count(pt) FROM b) SELECT colname, CASE WHEN f.colname IS NULL THEN 'second only' "
    "WHEN s.colname IS NULL THEN 'first only' ELSE 'both' END AS found_in, filled_first, filled_second "
    "FROM f FULL JOIN s USING (colname)",
)
_DIFF_COLS = [c for c in _SECOND_COLS if c not in ("phacid", "pt", "ptcaseid")]
add(
    "cell_diff",
    lambda spark, sf: diff.cell_diff(fx.first_source(spark, sf), fx.second_source(spark, sf)),
    f"{S.WITH_SOURCES} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS colname, a.phacid AS phacid_orig, b.phacid AS phacid_meta, a.pt, a.ptcaseid, "
        f"{S.clean(f'a.{c}')} AS value_orig, {S.clean(f'b.{c}')} AS value_meta "
        f"FROM a JOIN b ON a.pt = b.pt AND a.ptcaseid = b.ptcaseid WHERE a.{c} <> b.{c}"
        for c in _DIFF_COLS
    ),
)


def _normalised(spark, sf):
    a = diff.normalise_first(fx.first_source(spark, sf)).select(
        "phacid", F.col("pt").alias("pt_first"), F.col("sex").alias("sex_first")
    )
    b = diff.normalise_second(fx.second_source(spark, sf)).select(
        F.lower("phacid").alias("phacid"), F.col("sex").alias("sex_second"),
        F.col("disposition").alias("disposition_second"),
    )
    return a.join(b, "phacid")


add(
    "diff_normalise",
    _normalised,
    f"""{S.WITH_SOURCES} SELECT lower(a.phacid) AS phacid, lower(a.pt) AS pt_first, lower(a.sex) AS sex_first,
  CASE WHEN b.sex = 'not collected' THEN '' ELSE b.sex END AS sex_second,
  CASE WHEN b.disposition IN ('unknown', 'not collected') THEN '' ELSE b.disposition END AS disposition_second
FROM a JOIN b USING (phacid)""",
)

# the normalised tables, cut from the wide fixture; the same text runs in both engines
_NORMAL = {
    "cases_n": "SELECT phacid, pt, lower(classification) AS classification, lower(sex) AS sex, age, "
    "agegroup10 AS agegrouping, occupationspec AS occupation, healthcare_worker AS occupationhcw, ltc_resident, "
    "onsetdate FROM {cases}",
    "severity_n": "SELECT phacid, lower(hosp) AS hosp, hospstartdate, lower(icu) AS icu, icustartdate, mechanicalvent, "
    "ventstartdate, lower(disposition) AS disposition, recoverydate FROM {cases} WHERE k % 97 <> 0",
    "exposures_n": "SELECT phacid, CASE WHEN k % 5 = 0 THEN 'yes' END AS closecontacttravel, "
    "lower(closecontactcase) AS closecontactcase FROM {cases} WHERE k % 3 <> 2",
    "lab_n": "SELECT phacid, earliestlabcollectiondate AS labspecimencollectiondate, earliestlabtestresultdate AS "
    "labtestresultdate FROM {cases} UNION ALL SELECT phacid, reporteddate, phacreporteddate FROM {cases} WHERE k % 2 = 0",
    "travel_n": "SELECT phacid, lower(travelfromcountry1) AS travel_international_loc FROM {cases} WHERE "
    "travelfromcountry1 IS NOT NULL UNION ALL SELECT phacid, lower(traveltocountry1) FROM {cases} WHERE "
    "traveltocountry1 IS NOT NULL",
}
# numbers above seven, and the text of number 35, are made from the last digit of the id
_VIEW_SYMPTOMS = (
    "SELECT phacid, CASE WHEN symptomid = 5 THEN 5 + CAST(right(phacid, 1) AS INT) % 9 WHEN symptomid = 6 THEN 35 "
    "WHEN symptomid = 7 THEN 6 ELSE symptomid END AS symptomid, symptomvalue, CASE WHEN symptomid = 6 AND symptomvalue = 'yes' "
    "THEN concat('spec ', right(phacid, 1)) END AS symptomspec FROM {symptoms}"
)


def _case_view(spark, sf):
    cases = fx.cases(spark, sf)
    t = {name: spark.sql(sql, cases=cases) for name, sql in _NORMAL.items()}
    symptoms = spark.sql(_VIEW_SYMPTOMS, symptoms=fx.symptoms(spark, sf))
    return diff.case_view(t["cases_n"], symptoms, t["severity_n"], t["exposures_n"], t["lab_n"], t["travel_n"])


_VIEW_NAMES = {
    2: "symcough", 3: "symfever", 4: "symchills", 5: "symsorethroat", 6: "symrunnynose", 7: "symshortnessofbreath",
    8: "symnausea", 9: "symheadache", 10: "symweakness", 11: "sympain", 12: "symirritability", 13: "symdiarrhea",
    35: "symother",
}
add(
    "case_view_sql",
    _case_view,
    # every table is brought to one row per case before anything is joined
    f"""{S.WITH_BOTH}, {', '.join(f'{n} AS ({q.format(cases="cases")})' for n, q in _NORMAL.items())},
seen AS ({_VIEW_SYMPTOMS.format(symptoms="symptoms")}),
per_case AS (SELECT phacid, list(symptomid) FILTER (symptomvalue = 'yes') AS yes, list(symptomid) AS asked,
  max(symptomvalue) FILTER (symptomid = 1) AS none_said, max(symptomspec) FILTER (symptomid = 35) AS symotherspec,
  {', '.join(f'max(symptomvalue) FILTER (symptomid = {i}) AS {n}' for i, n in _VIEW_NAMES.items())}
  FROM seen GROUP BY phacid),
tested AS (SELECT phacid, min(labspecimencollectiondate) AS taken, min(labtestresultdate) AS result FROM lab_n GROUP BY phacid),
places AS (SELECT phacid, list(DISTINCT travel_international_loc) AS locs FROM travel_n GROUP BY phacid),
aged AS (SELECT *, least(CASE WHEN age >= 80 THEN 80 WHEN age >= 20 THEN age - age % 10 WHEN age < 20 THEN 10 ELSE 99 END,
  CASE agegrouping WHEN '0-19' THEN 10 WHEN '80+' THEN 80
  ELSE coalesce(TRY_CAST(string_split(agegrouping, '-')[1] AS INT), 99) END) AS band FROM cases_n),
sick AS (SELECT *, coalesce('yes' IN (icu, mechanicalvent), false) OR coalesce(icustartdate, ventstartdate) IS NOT NULL AS care,
  MAP {{'yes': 'hospitalized - non-icu', 'no': 'not hospitalized'}}[hosp] AS stay FROM severity_n)
SELECT c.phacid, c.pt, coalesce(onsetdate, taken, result) AS episodedate, c.classification,
  coalesce(nullif(sex, ''), 'not stated') AS sex2,
  if(band = 99, 'unknown', if(band = 80, '80 or plus', if(band = 10, '0 to 19', format('{{}} to {{}}', band, band + 9)))) AS agegroup10,
  age, coalesce(nullif(occupation, ''), 'not stated') AS occupation2,
  coalesce(nullif(occupationhcw, ''), 'not stated') AS healthcare_worker2,
  coalesce(nullif(ltc_resident, ''), 'not stated') AS ltc_resident2,
  if(len(list_filter(coalesce(yes, []), lambda i: i > 1 AND i < 35)) > 0, 'no',
    if(list_contains(asked, 1), none_said, 'unknown')) AS asymptomatic2,
  onsetdate, {', '.join(_VIEW_NAMES.values())}, symotherspec,
  if(care, 'hospitalized - icu', if(hospstartdate IS NOT NULL, 'hospitalized - non-icu', coalesce(stay, 'unknown'))) AS hospstatus,
  coalesce(MAP {{'ill': 'stable', 'self isolation': 'stable', 'not reported': 'unknown', 'other': 'unknown',
    'pending': 'unknown', '': 'unknown'}}[disposition], disposition) AS disposition2,
  if(disposition = 'recovered', recoverydate, NULL) AS recoverydate2,
  CASE WHEN len(list_filter(coalesce(locs, []), lambda z: z NOT IN ('canada', 'unclassifiable', 'pei', 'not collected'))) > 0
      OR pt = 'repatriate' THEN 'international travel'
    WHEN closecontacttravel = 'yes' OR closecontactcase IS NOT NULL OR list_contains(locs, 'canada') THEN 'domestic acquisition'
    WHEN pt = 'on' THEN 'information pending' END AS exposure_cat2
FROM aged c LEFT JOIN per_case USING (phacid) LEFT JOIN sick USING (phacid) LEFT JOIN exposures_n USING (phacid)
LEFT JOIN tested USING (phacid) LEFT JOIN places USING (phacid) WHERE c.classification = 'confirmed'""",
)

# ---- quality rules ----------------------------------------------------------------


# in the fixture no case has intensive-care or ventilation dates without the status: blank some statuses
_UNSTATED = {"icu": "CASE WHEN k % 4 = 0 THEN 'unknown' ELSE icu END",
             "mechanicalvent": "CASE WHEN k % 4 = 0 THEN '' ELSE mechanicalvent END"}
_REPLACED = ", ".join(f"{v} AS {k}" for k, v in _UNSTATED.items())


def _rule(name: str) -> None:
    unstated = name in ("icu_date", "vent_date")

    def run(spark, sf):
        df = fx.cases(spark, sf)
        if unstated:
            df = df.withColumns({k: F.expr(v) for k, v in _UNSTATED.items()})
        return quality.rule_errors(df, name, asof=ASOF, min_date=MIN_DATE)

    rows = f", r2 AS (SELECT * REPLACE ({_REPLACED}) FROM r)\n" if unstated else "\n"
    sql = S.rule_sql(name).replace("FROM r ", "FROM r2 " if unstated else "FROM r ")
    add(f"dq_{name}", run, S.WITH_RULES + rows + sql)


for _name in S.RULE_SQL:
    _rule(_name)


def dq_report(spark, sf):
    return quality.error_report(fx.cases(spark, sf), asof=ASOF, min_date=MIN_DATE)


add("dq_report", dq_report, f"{S.WITH_RULES}\n{_ALL_ERRORS}")


# the other source layout: lower-case values, resolution instead of recovery, an episode date of its own, and columns
# that are named like dates but are not checked as such
_LAYOUT = {
    "disposition": "CASE WHEN disposition = 'Recovered' THEN 'resolved' ELSE lower(disposition) END",
    "ageunit": "nullif(ageunit, '')", "classification": "lower(classification)",
    "episodedate": "CASE WHEN k % 9 = 0 THEN episodedate + 5 ELSE episodedate END",
}
_NOT_CHECKED = {"detectedatentry": "DATE '2030-01-01'", "weekdate": "DATE '1950-01-01'"}


def _resolution_report(spark, sf):
    df = fx.cases(spark, sf).withColumns({c: F.expr(v) for c, v in _LAYOUT.items()})
    df = df.withColumnRenamed("recoverydate", "resolutiondate").withColumns({c: F.expr(v) for c, v in _NOT_CHECKED.items()})
    return quality.error_report(df, asof=ASOF, min_date=MIN_DATE, words=quality.RESOLUTION, check_unique=True)


add(
    "dq_report_resolution",
    _resolution_report,
    f"{S.WITH_RULES}, r3 AS (SELECT * REPLACE ({', '.join(f'{v} AS {c}' for c, v in _LAYOUT.items())}), "
    "recoverydate AS resolutiondate FROM r)\n"
    + "\nUNION ALL\n".join(
        f"SELECT phacid, pt, ptcaseid, classification, phacreporteddate, {message} AS err, {S.q(typ)} AS typ FROM r3 WHERE {cond}"
        for typ, cond, message in S.resolution_rules(ASOF, MIN_DATE)
    ),
)

# ---- curves and rates -------------------------------------------------------------

_LUMP = 0.195  # a share that some regions of the test tables miss
SINCE = "2000-12-30"


def _curve_sql(date: str, color: str, share: float, name: str = "curve") -> str:
    """CTEs ending in ``name``: counts with shares for one date and colour."""
    return f"""{name}_b AS (SELECT {date} AS date, {S.clean(color, blank='Unknown')} AS color, pt FROM cases
  WHERE classification IN ('Confirmed', 'Probable') AND {date} IS NOT NULL),
{name}_s AS (SELECT pt, count(*) / sum(count(*)) OVER () AS share FROM {name}_b GROUP BY pt),
{name}_r AS (SELECT pt FROM {name}_s WHERE share <= {share} AND (SELECT count(*) FROM {name}_s WHERE share <= {share}) > 1),
{name}_l AS (SELECT date, color, CASE WHEN pt IN (SELECT pt FROM {name}_r) THEN 'Other' ELSE pt END AS facet FROM {name}_b),
{name}_n AS (SELECT date, color, facet, count(*) AS n FROM {name}_l GROUP BY ALL),
{name} AS (SELECT date, color, facet, n, CAST(sum(n) OVER () AS BIGINT) AS total,
  100 * sum(n) OVER (PARTITION BY color) / sum(n) OVER () AS color_percent,
  100 * sum(n) OVER (PARTITION BY facet) / sum(n) OVER () AS facet_percent,
  max(n) OVER (PARTITION BY facet) AS facet_max, CAST(sum(n) OVER (PARTITION BY facet) AS BIGINT) AS facet_total
  FROM {name}_n)"""


def _curve(spark, sf, **kw):
    return curves.epi_curve_counts(fx.cases(spark, sf), "onsetdate", "exposure_cat", min_share=_LUMP, **kw)


def _counts(spark, sf):
    return curves.curve_counts(fx.cases(spark, sf), "onsetdate", "exposure_cat", min_share=_LUMP)


_CURVE = f"{W}, {_curve_sql('onsetdate', 'exposure_cat', _LUMP)}"
add("epi_curve_counts", lambda spark, sf: _curve(spark, sf, since=SINCE),
    f"{_CURVE} SELECT * FROM curve WHERE date >= DATE '{SINCE}'")
_DIGITS = "CASE WHEN {0} >= 99.5 THEN '100' ELSE printf('%.2g', {0}) END"
add(
    "epi_curve_labels",
    lambda spark, sf: curves.with_labels(_curve(spark, sf)).select("color_lbl", "facet_lbl").distinct(),
    f"{_CURVE} SELECT DISTINCT color || ' (' || {_DIGITS.format('color_percent')} || '%)' AS color_lbl, "
    f"facet || chr(10) || {_DIGITS.format('facet_percent')} || '%' || chr(10) || 'Peak:' || format('{{:,}}', facet_max) || "
    "chr(10) || 'Total:' || format('{:,}', facet_total) AS facet_lbl FROM curve",
)


def _lump(spark, sf):
    counts = fx.cases(spark, sf).groupBy("pt").agg(F.count(F.lit(1)).alias("n"))
    return curves.lump_rare(counts, "pt", [], 0.2).groupBy("pt").agg(F.sum("n").alias("n"))


add(
    "lump_rare",
    _lump,
    f"""{W}, s AS (SELECT pt, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM cases GROUP BY pt)
SELECT CASE WHEN share <= 0.2 AND (SELECT count(*) FROM s WHERE share <= 0.2) > 1 THEN 'Other' ELSE pt END AS pt,
  CAST(sum(n) AS BIGINT) AS n FROM s GROUP BY 1""",
)
_ROLL = f"""{_CURVE}, daily AS (SELECT facet, date, CAST(sum(n) AS BIGINT) AS n FROM curve GROUP BY ALL),
rolled AS (SELECT facet, date, n, CASE WHEN count(*) OVER w = 7 THEN avg(n) OVER w END AS roll_mean FROM daily
  WINDOW w AS (PARTITION BY facet ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""
add(
    "epi_rolling_mean",
    lambda spark, sf: curves.rolling_mean(_counts(spark, sf), since=SINCE),
    f"{_ROLL} SELECT * FROM rolled WHERE date >= DATE '{SINCE}'",
)
add(
    "epi_rolling_mean_scaled",
    lambda spark, sf: curves.rolling_mean(_counts(spark, sf), normalise=True),
    f"{_ROLL} SELECT facet, date, n / max(n) OVER (PARTITION BY facet) AS n, "
    "roll_mean / max(roll_mean) OVER (PARTITION BY facet) AS roll_mean FROM rolled",
)
add(
    "epi_percent_fill",
    lambda spark, sf: curves.percent_fill(_counts(spark, sf)).select("date", "color", "facet", "n", "share"),
    f"{_CURVE} SELECT date, color, facet, n, n / sum(n) OVER (PARTITION BY date, facet) AS share FROM curve",
)
add(
    "reporting_lag_ribbon",
    lambda spark, sf: curves.reporting_lag_ribbon(
        fx.cases(spark, sf), "reporteddate", "hosp", asof=ASOF, min_share=_LUMP
    ),
    f"""{W}, {_curve_sql('reporteddate', 'hosp', _LUMP)},
f_s AS (SELECT pt, count(*) / sum(count(*)) OVER () AS share, max(phacreporteddate) AS m FROM cases GROUP BY pt),
fog AS (SELECT CASE WHEN share <= {_LUMP} AND (SELECT count(*) FROM f_s WHERE share <= {_LUMP}) > 1 THEN 'Other'
  ELSE pt END AS facet, max(m) - 3 AS start FROM f_s GROUP BY 1),
shown AS (SELECT facet, date, CAST(sum(n) AS BIGINT) AS n FROM curve WHERE date >= DATE '{SINCE}' GROUP BY ALL),
peak AS (SELECT facet, max(n) AS ymax FROM shown GROUP BY facet),
days AS (SELECT facet, unnest(generate_series(start, (SELECT max(date) FROM shown), INTERVAL 1 DAY)) AS d FROM fog)
SELECT facet, CAST(d AS DATE) AS date, CAST(0 AS BIGINT) AS ymin, ymax FROM days JOIN peak USING (facet)""",
)
_BATCH = [("onsetdate", "sex"), ("onsetdate", "hosp"), ("reporteddate", "disposition")]
add(
    "epi_curve_batch",
    lambda spark, sf: curves.epi_curve_batch(fx.cases(spark, sf), _BATCH, min_share=_LUMP),
    W + ", " + ", ".join(_curve_sql(d, c, _LUMP, f"c{i}") for i, (d, c) in enumerate(_BATCH)) + " "
    + " UNION ALL ".join(
        f"SELECT '{d}' AS date_col, '{c}' AS color_col, * FROM c{i}" for i, (d, c) in enumerate(_BATCH)
    ),
)


_BATCH_CTE = W + ", " + ", ".join(
    _curve_sql(d, c, _LUMP, f"c{i}") for i, (d, c) in enumerate(_BATCH)
) + ", every AS (" + " UNION ALL ".join(
    f"SELECT '{d}' AS date_col, '{c}' AS color_col, * FROM c{i}" for i, (d, c) in enumerate(_BATCH)
) + ")"
add(
    "epi_batch_rolling",
    lambda spark, sf: curves.rolling_mean(
        curves.curve_counts_batch(fx.cases(spark, sf), _BATCH, min_share=_LUMP), by=curves.SERIES
    ),
    f"""{_BATCH_CTE}, daily AS (SELECT date_col, color_col, facet, date, CAST(sum(n) AS BIGINT) AS n FROM every GROUP BY ALL)
SELECT date_col, color_col, facet, date, n, CASE WHEN count(*) OVER w = 7 THEN avg(n) OVER w END AS roll_mean FROM daily
WINDOW w AS (PARTITION BY date_col, color_col, facet ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
add(
    "epi_batch_percent",
    lambda spark, sf: curves.percent_fill(
        curves.curve_counts_batch(fx.cases(spark, sf), _BATCH, min_share=_LUMP), by=curves.SERIES
    ).select(*curves.SERIES, "date", "facet", "color", "share"),
    f"{_BATCH_CTE} SELECT date_col, color_col, date, facet, color, "
    "n / sum(n) OVER (PARTITION BY date_col, color_col, date, facet) AS share FROM every",
)


def _usual_charts(spark, sf):
    """The chain of the daily charts: derive, impute the onset date, count."""
    df = reports.all_cases(fx.cases(spark, sf))
    return curves.epi_curve_batch(impute.impute_dates(df, ["onsetdate"], SOURCES, key=F.col("k")), min_share=_LUMP)


_CHARTS = [("onsetdate_imputed", c) for c in curves.CHART_COLORS]
add(
    "epi_usual_charts",
    _usual_charts,
    S.impute_sql(
        ["onsetdate"], SOURCES, cte=WITH_PUBLISHED, base="published",
        final=", " + ", ".join(
            _curve_sql(d, c, _LUMP, f"c{i}").replace("FROM cases", "FROM imputed") for i, (d, c) in enumerate(_CHARTS)
        ) + " " + " UNION ALL ".join(
            f"SELECT '{d}' AS date_col, '{c}' AS color_col, * FROM c{i}" for i, (d, c) in enumerate(_CHARTS)
        ),
    ),
)


def _age_counts(col: str, age: str, na: str = "") -> str:
    return (
        f"counts AS (SELECT pt, {age} AS age_group, TRY_CAST(regexp_extract({age}, '^[0-9A-Za-z]*') AS INT) AS min_age, "
        f"coalesce({col}, {S.q(na)}) AS nm, count(*) AS n FROM cases GROUP BY ALL)"
    )


add(
    "value_counts_by_age",
    lambda spark, sf: rates.value_counts_by_age(fx.cases(spark, sf), "hosp", age_group="agegroup20"),
    f"{W}, {_age_counts('hosp', 'agegroup20')} SELECT * FROM counts",
)


def _rates_sql(col: str, age: str, na: str = "") -> str:
    """CTEs up to ``every``: recorded counts with the national rows."""
    up = "CASE WHEN lower(trim(nm)) IN ('unknown', 'unk', 'not asked') THEN '' ELSE lower(trim(nm)) END"
    return f"""{W}, {_age_counts(col, age, na)},
own AS (SELECT pt, age_group, min_age, nm, nm <> '' AS is_recorded, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT pt, age_group, min_age, {S.clean(up)} AS nm, n FROM counts) GROUP BY ALL),
pos AS (SELECT nm FROM own WHERE is_recorded GROUP BY nm ORDER BY nm = 'Yes' DESC, sum(n) DESC, nm LIMIT 1),
every AS (SELECT pt, age_group, min_age, nm, is_recorded, n FROM own UNION ALL
  SELECT 'CANADA', age_group, min_age, CASE WHEN nm = (SELECT nm FROM pos) THEN 'Yes' ELSE 'No' END, is_recorded, n
  FROM own),
rec AS (SELECT pt, coalesce(sum(n) FILTER (is_recorded), 0) / sum(n) AS is_recorded_fraction,
  CAST(coalesce(sum(n) FILTER (is_recorded), 0) AS DOUBLE) AS sample_size FROM every GROUP BY pt)"""


add(
    "recorded_by_region",
    lambda spark, sf: rates.recorded_by_region(
        rates.with_national(rates.recorded_counts(fx.cases(spark, sf), [("symcough", "agegroup20", "")])),
        min_fraction=0.67,
    ),
    f"{_rates_sql('symcough', 'agegroup20')} SELECT * FROM rec "
    "WHERE (is_recorded_fraction >= 0.67 AND sample_size > 100) OR pt = 'CANADA'",
)

# Clopper-Pearson limits by bisection on the binomial tail, in SQL
_LOG_PMF = (
    "lgamma(m + 1) - lgamma(i + 1) - lgamma(m - i + 1) + i * ln(p) + (m - i) * ln(1 - p)"
)


def _limits_sql(source: str) -> str:
    """CTE ``lim(x, tot, lower_ci, upper_ci)`` for the distinct pairs of ``source(x, tot)``."""
    low = (
        f"(SELECT coalesce(sum(exp({_LOG_PMF})), 0) FROM (SELECT unnest(generate_series(bis.x, bis.tot)) AS i, "
        "bis.tot AS m, (bis.llo + bis.lhi) / 2 AS p))"
    )
    up = (
        f"(SELECT coalesce(sum(exp({_LOG_PMF})), 0) FROM (SELECT unnest(generate_series(0, bis.x)) AS i, "
        "bis.tot AS m, (bis.ulo + bis.uhi) / 2 AS p))"
    )
    return f"""pairs AS (SELECT DISTINCT CAST(x AS BIGINT) AS x, CAST(tot AS BIGINT) AS tot FROM {source} WHERE tot > 0),
bis AS (SELECT 0 AS step, x, tot, 0.0::DOUBLE AS llo, 1.0::DOUBLE AS lhi, 0.0::DOUBLE AS ulo, 1.0::DOUBLE AS uhi
  FROM pairs UNION ALL
  SELECT step + 1, x, tot, CASE WHEN lt < 0.025 THEN (llo + lhi) / 2 ELSE llo END,
    CASE WHEN lt < 0.025 THEN lhi ELSE (llo + lhi) / 2 END,
    CASE WHEN ut > 0.025 THEN (ulo + uhi) / 2 ELSE ulo END, CASE WHEN ut > 0.025 THEN uhi ELSE (ulo + uhi) / 2 END
  FROM (SELECT *, {low} AS lt, {up} AS ut FROM bis WHERE step < 40)),
lim AS (SELECT x, tot, CASE WHEN x = 0 THEN 0.0 ELSE round((llo + lhi) / 2, 6) END AS lower_ci,
  CASE WHEN x = tot THEN 1.0 ELSE round((ulo + uhi) / 2, 6) END AS upper_ci FROM bis WHERE step = 40)"""


def _ci(spark, sf):
    counts = fx.cases(spark, sf).groupBy("pt", "agegroup10", "classification").agg(
        F.count(F.when(F.col("coviddeath") == "yes", 1)).alias("deaths"), F.count(F.lit(1)).alias("n")
    )
    return rates.exact_binomial_ci(counts, "deaths", "n")


add(
    "exact_binomial_ci",
    _ci,
    f"""{W.replace('WITH ', 'WITH RECURSIVE ', 1)}, src AS (SELECT pt, agegroup10, classification,
  count(*) FILTER (coviddeath = 'yes') AS x, count(*) AS tot FROM cases GROUP BY ALL), {_limits_sql('src')}
SELECT pt, agegroup10, classification, x AS deaths, tot AS n, x / tot AS mean_ci, lower_ci, upper_ci
FROM src JOIN lim USING (x, tot)""",
)
_PCT = "CAST(CAST(round_even({0} * 100, 0) AS BIGINT) AS VARCHAR) || '%'"


def _positivity_sql(col: str, age: str, na: str, canada: bool) -> str:
    keep = " OR pt = 'CANADA'" if canada else ""
    return f"""{_rates_sql(col, age, na).replace('WITH ', 'WITH RECURSIVE ', 1)},
overall AS (SELECT pt, sum(n) FILTER (nm = 'Yes') / sum(n) FILTER (nm IN ('Yes', 'No')) AS o FROM every
  WHERE is_recorded GROUP BY pt),
src AS (SELECT pt, age_group, min_age, CAST(coalesce(sum(n) FILTER (nm = 'Yes'), 0) AS BIGINT) AS x,
  CAST(coalesce(sum(n) FILTER (nm IN ('Yes', 'No')), 0) AS BIGINT) AS tot FROM every
  WHERE is_recorded AND age_group <> 'Unknown' GROUP BY ALL), {_limits_sql('src')}
SELECT pt, age_group, min_age, x AS nm_yes, tot - x AS nm_no, tot AS nm_total, x / tot AS nm_frac_yes, x / tot AS mean_ci,
  lower_ci, upper_ci, ' (' || {_PCT.format('lower_ci')} || '-' || {_PCT.format('upper_ci')} || ')' AS nm_per_yes,
  pt || ' recorded=' || {_PCT.format('is_recorded_fraction')} || chr(10) || '{col.upper()}=' || {_PCT.format('o')} ||
  chr(10) || 'N=' || format('{{:,}}', CAST(sample_size AS BIGINT)) AS lbl
FROM src JOIN lim USING (x, tot) JOIN rec USING (pt) JOIN overall USING (pt)
WHERE (is_recorded_fraction >= 0.9 AND sample_size > 100){keep}"""


add(
    "positivity_by_age",
    lambda spark, sf: rates.positivity_by_age(
        fx.cases(spark, sf), "icu", age_group="agegroup10", include_canada=True, min_fraction=0.9
    ),
    _positivity_sql("icu", "agegroup10", "", True),
)
add(
    "positivity_batch",
    lambda spark, sf: rates.positivity_batch(fx.cases(spark, sf)),
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{age}' AS age_col, * FROM ({_positivity_sql(c, age, na, False)})"
        for c, na in rates.CHARTED
        for age in rates.AGE_GROUPS
    ),
)

__all__ = ["ORACLES", "QUERIES"]


# ---- counts kept by day ------------------------------------------------------------


def _by_day(df, count, finish):
    """A report from counts of three runs, of which the second counts a month again."""
    spark, folder = df.sparkSession, scratch_path(df.sparkSession, "days")
    first, last = df.agg(F.min("phacreporteddate"), F.max("phacreporteddate")).first()
    try:
        kept = partials.DayCounts(spark, folder, count)
        for part, again in ((3, 0), (2, 30), (1, 0)):
            kept.update(df, last - (last - first) * (part - 1) // 3, again=again)
        kept.prune()
        return materialise(finish(kept.merged()))
    finally:
        remove_path(spark, folder)


add(
    "count_summary_by_day",
    lambda spark, sf: _by_day(
        fx.cases(spark, sf), lambda df, by: summary.summary_counts(df, by=tuple(by)), lambda c: summary.summary_of(c, merge=True)
    ),
    ORACLES["count_summary"],
)
add(
    "completeness_by_day",
    lambda spark, sf: _by_day(
        _complete_input(spark, sf).withColumn("phacreporteddate", F.to_date("phacreporteddate")),
        lambda df, by: summary.completeness_counts(df, config=_COMPLETE_CONFIG, by=tuple(by)),
        lambda c: summary.completeness_of(c, merge=True),
    ),
    ORACLES["completeness_long"],
)
add(
    "epi_curve_by_day",
    lambda spark, sf: _by_day(
        fx.cases(spark, sf), lambda df, by: curves.curve_parts(df, _BATCH, by=tuple(by)),
        lambda c: curves.with_shares(curves.curve_of(c, min_share=_LUMP)),
    ),
    ORACLES["epi_curve_batch"],
)
