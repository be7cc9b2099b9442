import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseloom.operators import quality
from caseloom.plans.sizing import assert_unique
from verification import fixture as fx

from .conftest import values

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cases(spark):
    return fx.cases(spark, SF)


def one(spark, cases, **change):
    """A single clean case with some columns replaced."""
    base = {f.name: F.lit(None).cast(f.dataType) for f in cases.schema.fields}
    base |= {"phacid": F.lit("1"), "classification": F.lit("Confirmed")}
    base |= {k: F.lit(v) if not isinstance(v, str) or "date" not in k else F.lit(v).cast("date") for k, v in change.items()}
    return spark.range(1).select(*[c.cast(cases.schema[n].dataType).alias(n) for n, c in base.items()])


def errors(df, name):
    return [r[0] for r in quality.rule_errors(df, name, asof="2021-01-01").select("err").collect()]


def test_null_status_is_not_flagged(spark, cases):
    assert errors(one(spark, cases, hospstartdate="2020-03-01"), "hosp_date") == []
    assert len(errors(one(spark, cases, hospstartdate="2020-03-01", hosp="no"), "hosp_date")) == 1
    assert errors(one(spark, cases, hospenddate="2020-03-01", hosp="YES"), "hosp_date") == []


def test_symptom_text(spark, cases):
    df = one(spark, cases, asymptomatic="Yes", symcough="yes", symfever="No", symother=".", symotherspec="tired")
    assert errors(df, "asymptomatic_with_symptoms") == ["Asymptomatic is 'yes' but symcough=yes + symotherspec=tired"]
    assert errors(one(spark, cases, asymptomatic="yes", symcough=""), "asymptomatic_with_symptoms") == []


def test_finding_a_hit_makes_no_text(cases):
    for name in ("travel_details", "asymptomatic_with_symptoms"):
        rule = next(r for r in quality.rules("2021-01-01") if r.name == name)
        [(cond, _)] = rule.hits(cases)
        plan = cases.where(cond)._jdf.queryExecution().optimizedPlan().toString()
        assert "is '" not in plan and "symcough=" not in plan


def test_travel_text_and_close_contact(spark, cases):
    df = one(spark, cases, travel="no", travelfromcountry1="France", travelstartdate1="2020-02-02", traveltocountry1="")
    assert errors(df, "travel_details") == [
        "travel is not yes but 'travelfromcountry1' is 'France' and 'travelstartdate1' is '2020-02-02'"
    ]
    df = one(spark, cases, closecontactcase="no", closecontactcasespec="home")
    assert len(errors(df, "close_contact_details")) == 1


def test_long_open_case(spark, cases):
    df = one(spark, cases, onsetdate="2020-08-04")
    assert errors(df, "sick_long_time") == [
        "Onset Date 2020-08-04 is 150 days ago....Thats a lot, maybe verify this with the PT?"
    ]
    assert errors(one(spark, cases, onsetdate="2020-08-05"), "sick_long_time") == []
    assert errors(one(spark, cases, onsetdate="2020-01-01", disposition="Recovered"), "sick_long_time") == []


def test_date_rules_report_each_column(spark, cases):
    df = one(spark, cases, onsetdate="2021-01-02", deathdate="2021-02-01", reporteddate="2021-01-01")
    assert sorted(errors(df, "future_dates")) == [
        "deathdate is in the future? spooky!", "onsetdate is in the future? spooky!",
    ]
    assert errors(one(spark, cases, onsetdate="2019-12-31"), "dates_before_min") == ["onsetdate is before 2020-01-01"]


@pytest.mark.parametrize(("age", "n"), [(-1, 1), (0, 0), (113, 0), (114, 1)])
def test_age_range(spark, cases, age, n):
    assert len(errors(one(spark, cases, age=age), "age_range")) == n


def test_report_is_the_union_of_the_rules(spark, cases):
    assert_unique(cases, "phacid")
    report = quality.error_report(cases, asof=fx.ASOF, min_date=fx.MIN_DATE)
    parts = None
    for r in quality.rules(fx.ASOF, fx.MIN_DATE):
        if r.default:
            e = quality.rule_errors(cases, r.name, asof=fx.ASOF, min_date=fx.MIN_DATE)
            parts = e if parts is None else parts.unionByName(e)
    assert sorted(values(report, "phacid", "err", "typ")) == sorted(values(parts, "phacid", "err", "typ"))


def test_report_order(cases):
    rows = quality.error_report(cases, asof=fx.ASOF, min_date=fx.MIN_DATE).collect()
    first = dt.date.min
    keys = [(-((r.phacreporteddate or first).toordinal()), r.phacid, r.typ) for r in rows]
    assert keys == sorted(keys)


def test_report_scans_once(cases):
    df = quality.error_report(cases, asof=fx.ASOF, min_date=fx.MIN_DATE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 1
    assert "SortMergeJoin" not in plan and "BatchEvalPython" not in plan


def test_unique_check(spark):
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(spark.createDataFrame([("a",), ("a",)], "phacid string"), "phacid")


def test_both_plan_forms_agree(spark, cases):
    def report():
        df = quality.error_report(cases, asof=fx.ASOF, min_date=fx.MIN_DATE, ordered=False)
        return sorted(values(df, "phacid", "typ", "err"))

    key = "spark.sql.codegen.hugeMethodLimit"
    first, old = report(), spark.conf.get(key)
    spark.conf.set(key, 65535)
    try:
        assert report() == first
    finally:
        spark.conf.set(key, old)


def test_resolution_layout(spark, cases):
    df = one(spark, cases, disposition="ill", recoverydate="2020-03-01", age=5).withColumnRenamed(
        "recoverydate", "resolutiondate"
    )
    out = quality.error_report(df, asof="2021-01-01", words=quality.RESOLUTION)
    assert sorted(values(out, "typ", "err")) == [
        ("No Age units", "Exact Age is given but Age units are not."),
        (
            "Resolution date listed but not resolved",
            "Resolution date of '2020-03-01' is listed but disposition is 'ill'",
        ),
    ]


def resolution(spark, cases, **change):
    df = one(spark, cases, ageunit="years", **change).withColumnRenamed("recoverydate", "resolutiondate")
    return df.withColumn("classification", F.lower("classification"))


def texts(df):
    return sorted(values(quality.error_report(df, asof="2021-01-01", words=quality.RESOLUTION), "err"))


def test_resolution_layout_skips_columns_that_hold_no_date(spark, cases):
    df = resolution(spark, cases, onsetdate="2021-02-01")
    for c in ("detectedatentry", "weekdate", "earliestdatetype"):
        df = df.withColumn(c, F.lit("2030-01-01").cast("date"))
    assert texts(df) == ["onsetdate is in the future? spooky!"]


def test_resolution_layout_has_its_own_episode_date(spark, cases):
    df = resolution(spark, cases, phacreporteddate="2020-12-05", episodedate="2020-12-09", onsetdate="2020-12-01")
    assert texts(df) == ["PHACReported before episodedate '2020-12-05' < '2020-12-09'"]


def test_resolution_layout_wording(spark, cases):
    df = resolution(spark, cases, reporteddate="2020-06-01", age=200, coviddeath="yes", disposition="ill")
    assert texts(df) == [
        "age  200 is  wrong", "coviddeath 'yes' disagrees with  disposition 'ill'",
        "reporteddate 2020-06-01 is 214 days ago....Thats a lot, maybe verify this with the pt?",
    ]


def test_repeated_ids_are_reported(spark, cases):
    with pytest.raises(ValueError, match="not unique"):
        quality.error_report(cases.limit(3).union(cases.limit(3)), asof=fx.ASOF, check_unique=True)


def test_report_moves_cases_not_messages(cases):
    df = quality.error_report(cases, asof=fx.ASOF, min_date=fx.MIN_DATE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    own = cases._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1
    assert plan.count("Exchange hashpartitioning") == own.count("Exchange hashpartitioning")
    assert plan.index("Generate explode") < plan.index("Exchange rangepartitioning")


def test_cases_without_a_hit_do_not_move(spark, cases):
    """Only marked cases reach the exchange, with the columns of the report and of the messages."""
    chosen = [r for r in quality.rules(fx.ASOF, fx.MIN_DATE) if r.default and r.name in ("age_range", "future_dates")]
    marked, tests = quality.marked_cases(cases, chosen)
    hit = quality.error_report(cases, asof=fx.ASOF, min_date=fx.MIN_DATE, ordered=False, names=[r.name for r in chosen])
    want = {r.phacid for r in hit.select("phacid").distinct().collect()}
    assert 0 < len(want) < cases.count()
    assert sorted(values(marked, "phacid")) == sorted(want)
    plan = quality.error_report(cases, asof=fx.ASOF, min_date=fx.MIN_DATE)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange rangepartitioning") :]
    assert "__hits" in below and "Filter isnotnull(__hits" in below


def test_more_conditions_than_bits_of_a_mask(spark, cases):
    """Hits in every mask, alone and together, give the messages of the rules."""
    chosen = [r for r in quality.rules(fx.ASOF, fx.MIN_DATE) if r.default]
    marked, tests = quality.marked_cases(cases, chosen)
    assert len(tests) > 2 * quality._BITS
    n = len({f for f in marked.schema["__hits"].dataType.names})
    assert n == -(-len(tests) // quality._BITS)
    got = quality.with_errors(marked, tests, ["phacid"])
    want = quality.error_report(cases, asof=fx.ASOF, min_date=fx.MIN_DATE, ordered=False)
    assert sorted(values(got, "phacid", "typ", "err")) == sorted(values(want, "phacid", "typ", "err"))


def test_report_of_no_rules_is_empty(cases):
    assert quality.error_report(cases, asof=fx.ASOF, names=[]).count() == 0


def test_ranges_of_the_report_hold_so_many_cases(spark, monkeypatch):
    monkeypatch.setattr(quality, "RANGE_CASES", 100)
    df = fx.cases(spark, SF)
    out = quality.error_report(df, asof=fx.ASOF, min_date=fx.MIN_DATE)
    assert out.rdd.getNumPartitions() == -(-df.count() // 100)
    got = values(out, "phacreporteddate", "phacid", "typ")
    assert len(got) > 0 and got == sorted(got, key=lambda r: (r[0] is None, -r[0].toordinal() if r[0] else 0, r[1], r[2]))
