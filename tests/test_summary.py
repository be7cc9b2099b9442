import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseloom.operators import clean, summary
from verification import fixture as fx

from .conftest import values

SF = "/root/testdata/sf0.001"


def test_count_summary_sums_to_the_rows(spark):
    df = fx.cases(spark, SF)
    out = summary.count_summary(df)
    assert values(out.groupBy("name").agg(F.sum("n").alias("n")).select("n").distinct()) == [df.count()]
    names = set(values(out.select("name").distinct()))
    assert "onsetdate_week" in names and "sex" in names
    assert not names & {"k", "phacid", "ptcaseid", "occupationspec", "symotherspec", "pt", "onsetdate"}


def test_count_summary_limit_is_exact(spark):
    rows = [("x", "a", f"v{i % 5}", f"w{i % 6}") for i in range(60)]
    df = spark.createDataFrame(rows, "pt string, agegroup10 string, five string, six string")
    assert set(values(summary.count_summary(df, max_unique=5), "name")) == {"five"}


def test_wide_columns_are_dropped_before_the_shuffle(spark):
    df = spark.range(20_000).select(
        F.col("id").cast("string").alias("wide"),
        F.repeat(F.lit("."), (F.col("id") % 5000).cast("int")).alias("one_after_cleaning"),
        (F.col("id") % 3).cast("string").alias("few"),
    )
    assert summary.few_valued(df, df.columns, 60) == ["one_after_cleaning", "few"]


def test_completeness_adds_up(spark):
    out = summary.completeness(fx.cases(spark, SF))
    assert out.where("has_data + no_data <> total").count() == 0
    assert out.where("colnm = 'classification' and fraction_complete <> 1").count() == 0


def test_completeness_wide_levels(spark):
    df = spark.createDataFrame(
        [("1", "a", "confirmed", ""), ("2", "b", "Probable", "x"), ("3", "b", "suspect", "x")],
        "phacid string, pt string, classification string, v string",
    )
    row = summary.completeness_wide(df.select("phacid", "pt", "classification", "v")).where("colnm = 'v'").first()
    assert (row.has_data_a, row.no_data_a, row.total_b, row.fraction_complete_b) == (0, 1, 1, 1.0)


def test_completeness_cleans_first(spark):
    schema = "PHACID string, pt string, classification string, v string, w string"
    df = spark.createDataFrame([("1", "a", "confirmed", " . ", " . "), ("2", "a", "confirmed", "x", None)], schema)
    config = [clean.Cleaning(summary.COMPLETENESS, "V", "yes", " ")]
    out = summary.completeness(df, config=config)
    assert sorted(values(out.where("colnm IN ('v', 'w')"), "colnm", "has_data", "no_data")) == [("v", 1, 1), ("w", 1, 1)]


def test_regions_without_kept_cases_get_no_columns(spark):
    df = spark.createDataFrame(
        [("1", "a", "confirmed", "x"), ("2", "b", "suspect", "x")], "phacid string, pt string, classification string, v string"
    )
    assert summary.completeness_wide(df).columns == ["colnm", "has_data_a", "no_data_a", "total_a", "fraction_complete_a"]
    with pytest.raises(ValueError, match="regions"):
        summary.completeness_wide(df, only_classified=False, max_levels=1)


def test_occupancy_is_one_scan(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(5000).mapInPandas(count, "id long")
    df = df.select(F.col("id").cast("string").alias("wide"), (F.col("id") % 3).alias("few"), (F.col("id") - 2500).alias("number"))
    assert summary.few_valued(df, df.columns, 60) == ["few"] and seen.value == 5000


def test_report_delay_counts_all_rows_of_a_region(spark):
    d = dt.date(2020, 1, 1)
    rows = [("big", d, d, "0-19")] * 3 + [("big", None, d, "0-19"), ("big", d, d, "Unknown"), ("small", d, d, "0-19")]
    df = spark.createDataFrame(rows, "pt string, reporteddate date, onsetdate date, agegroup20 string")
    assert values(summary.report_delay_hist(df, min_cases=5)) == [("big", 0, 3)]


def test_recent_travel(spark):
    schema = (
        "phacid string, pt string, classification string, exposure_cat string, phacreporteddate date, onsetdate date, "
        "travel string, travelstartdate1 date, travelenddate1 date"
    )
    d = dt.date
    rep = d(2021, 1, 28)
    ok = ("x", "confirmed", "International travel")
    rows = [
        ("one recent", *ok, rep, d(2021, 1, 25), "yes", d(2021, 1, 1), d(2021, 1, 20)),
        ("none recent", *ok, rep, d(2021, 1, 25), "yes", d(2021, 1, 1), None),
        ("undated", *ok, rep, d(2021, 1, 25), "yes", None, None),
        ("old episode", *ok, rep, d(2021, 1, 10), "yes", None, None),
        ("reported today", *ok, d(2021, 1, 30), d(2021, 1, 25), "yes", None, None),
        ("not reported", *ok, None, d(2021, 1, 25), "yes", None, None),
        ("domestic", "x", "confirmed", "other", rep, d(2021, 1, 25), "yes", None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    out = summary.recent_travel_cases(df, asof="2021-01-30", episode_cols=["onsetdate"], episode_labels=["Onset"])
    assert sorted(values(out, "phacid", "travelstartdate1", "travelenddate1")) == [
        ("one recent", None, d(2021, 1, 20)), ("undated", None, None),
    ]
    assert "travel" not in out.columns


def test_spelling_suggestions(spark):
    rows = [(str(i), "x", "confirmed", v) for i, v in enumerate(["male", "male", "MALE", "Male.", "f", None, ""])]
    df = spark.createDataFrame(rows, "phacid string, pt string, classification string, sex string")
    out = summary.suggest_value_fixes(df, ["sex"])
    assert sorted(values(out, "old_value", "new_value")) == [("MALE", "male"), ("Male.", "male")]


def test_suggestions_join_by_shuffle_too(spark, monkeypatch):
    df = fx.cases(spark, SF)
    first = sorted(values(summary.suggest_value_fixes(df)), key=str)
    monkeypatch.setattr(summary, "broadcast_if_small", lambda t: t)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert sorted(values(summary.suggest_value_fixes(df)), key=str) == first
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_nothing_to_suggest(spark):
    df = spark.createDataFrame([("1", "x", "confirmed", "a")], "phacid string, pt string, classification string, sex string")
    assert summary.suggest_value_fixes(df).count() == 0


def test_occupancy_of_some_rows(spark):
    one, none = spark.range(1000).agg(
        summary._occupancy(F.col("id"), F.col("id") < 5), summary._occupancy(F.col("id"), F.lit(False))
    ).first()
    assert (one, none) == (5, 0)


def test_rows_of_a_part_meet_before_they_become_cells(spark):
    """Else nearly every cell of a table with many parts is shuffled by itself."""
    d = dt.date(2021, 1, 31)
    rows = [
        ("1", "a", "x", "male", d, 1), ("2", "a", "x", " MALE.", None, None), ("3", None, "x", None, d, 1),
        ("4", "b", None, "", dt.date(2020, 2, 29), 2), ("4", "b", None, "", dt.date(2020, 2, 29), 2),
    ]
    df = spark.createDataFrame(rows, "phacid string, pt string, agegroup10 string, sex string, onsetdate date, dose int")
    out = summary.summary_counts(df.withColumn("part", F.col("phacid")), by=("part",))
    assert "REBALANCE" in out._jdf.queryExecution().executedPlan().toString()
    keys = ["name", "value", "pt", "agegroup10"]
    summed = out.groupBy(*keys).agg(F.sum("n").alias("n"))
    assert sorted(values(summed, *keys, "n"), key=str) == sorted(values(summary.summary_counts(df), *keys, "n"), key=str)
