import datetime as dt

from pyspark.sql import functions as F

from caseloom.functions import dates
from caseloom.operators import derive

from .conftest import values

D = dt.date


def test_first_good_value(spark):
    df = spark.createDataFrame(
        [(D(2020, 1, 2), None), (D(1970, 1, 1), D(2020, 5, 5)), (None, None), (None, D(1970, 1, 1))],
        "a date, b date",
    )
    got = values(df.select(derive.first_good_value(["a", "b"], derive.EPOCH).alias("v")))
    assert got == [D(2020, 1, 2), D(2020, 5, 5), None, D(1970, 1, 1)]


def test_first_good_label(spark):
    df = spark.createDataFrame([("x", None), ("", "y"), (None, "")], "a string, b string")
    assert values(df.select(derive.first_good_label(["a", "b"], ["A", "B"]).alias("v"))) == ["A", "B", ""]


def test_hospital_status(spark):
    schema = "icu string, mechanicalvent string, hosp string, icustartdate date, hospstartdate date, ventstartdate date"
    rows = [
        ("yes", None, "no", None, None, None),
        ("no", "no", "no", None, None, D(2020, 1, 1)),
        ("no", None, "Yes.", None, None, None),
        (None, None, "no", None, D(2020, 1, 1), None),
        ("no", None, "NO", None, None, None),
        (None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema).select(
        derive.hosp_status().alias("a"), derive.hospitalized().alias("b"), derive.icu_flag().alias("c")
    )
    assert values(df) == [
        ("Hospitalized - ICU", "Yes", "Yes"),
        ("Hospitalized - ICU", "Yes", "Yes"),
        ("Hospitalized - non-ICU", "Yes", "No"),
        ("Hospitalized - non-ICU", "Yes", "Unknown"),
        ("Not hospitalized", "No", "No"),
        ("Unknown", "Unknown", "Unknown"),
    ]


def test_asymptomatic(spark):
    schema = "asymptomatic string, symcough string, symother string, symotherspec string"
    rows = [
        ("yes", "", None, "x"),        # stated, nothing known
        ("no", "no", "unknown", None),  # all absent, an unknown other symptom counts as absent
        ("yes", "yes", "no", None),     # a symptom is present
        ("yes", "no", "", None),        # partly known
        (None, "unknown", "no", None),
    ]
    df = spark.createDataFrame(rows, schema)
    assert values(df.select(derive.asymptomatic2(df).alias("v"))) == ["Yes", "Yes", "No", "Unknown", "Unknown"]


def test_comorbidity(spark):
    df = spark.createDataFrame(
        [("yes", "no", "q"), ("no", "No", "q"), (None, "no", "q")], "rfa string, rfb string, rfaspec string"
    )
    got = values(df.select(*[c.alias(n) for n, c in derive.comorbidity_columns(df).items()]))
    assert got == [("Yes", "", 1.0, "Yes"), ("", "No", 0.0, "No"), ("", "", 0.0, "Unknown")]


def test_disposition_and_recovery(spark):
    rows = [("ILL",), ("self-isolation",), (None,), ("recovered",), ("deceased",), ("moved",)]
    df = spark.createDataFrame(rows, "disposition string").withColumn("recoverydate", F.lit("2020-02-02").cast("date"))
    got = values(df.select(derive.disposition2().alias("d"), derive.recovery_date2().alias("r")))
    assert got == [
        ("Stable", None), ("Stable", None), ("Unknown", None), ("Recovered", D(2020, 2, 2)), ("Deceased", None),
        (None, None),
    ]


def test_exposure(spark):
    schema = "travelfromcountry1 string, traveltocountry1 string, travelfromcountry2 string, exposure_cat string"
    rows = [
        ("france", "CANADA", "u.s.a.", "domestic contact"), ("France", "france", None, ""),
        (None, None, None, "travel, intl"),
    ]
    df = spark.createDataFrame(rows, schema)
    got = values(df.select(derive.exposure_country(df).alias("c"), derive.exposure_cat2().alias("e")))
    assert got == [("France U S A", "Domestic acquisition"), ("France", "Missing"), ("", "Travel Intl")]


def test_indigenous(spark):
    rows = [("no", "First-Nation"), ("yes", None), ("", "other"), (None, "INUIT!")]
    df = spark.createDataFrame(rows, "indigenous string, indigenousgroup string")
    assert values(df.select(derive.indigenous2().alias("v"))) == ["Yes", "Yes", "", "Yes"]


def test_death(spark):
    rows = [("yes", "x"), ("no", "Deceased"), (None, None), ("no", "stable")]
    df = spark.createDataFrame(rows, "coviddeath string, disposition string")
    assert values(df.select(derive.death_flag().alias("v"))) == ["Yes", "Unknown", "Unknown", "No"]


def test_age_bands(spark):
    df = spark.createDataFrame([(5, None), (None, "30-39"), (79, None), (80, ""), (None, None)], "age int, agegrouping string")
    assert values(df.select(derive.age_group10().alias("v"))) == [
        "0 to 19", "30 to 39", "70 to 79", "80 or plus", "unknown",
    ]


def test_serial_dates_and_weeks(spark):
    df = spark.createDataFrame([("43831", True, "43831"), ("x", None, "y")], "OnsetDate string, SomeDate boolean, updated string")
    assert values(dates.flat_dates(df)) == [
        (D(2020, 1, 1), D(1899, 12, 31), "43831"), (None, None, "y"),
    ]
    days = spark.createDataFrame([(D(2021, 1, 1),), (D(2020, 12, 31),), (D(2021, 1, 8),)], "d date")
    assert values(days.select(dates.week_of_year(F.col("d")).alias("w"))) == [1, 53, 2]


def test_parse_dates(spark):
    df = spark.createDataFrame(
        [("2020-01-05", "2020-01-05 11:00:00", "2020-01-05", "yes"), ("x", None, "2020-01-05", "no")],
        "onsetdate string, reporteddate string, earliestdatetype string, detectedatentry string",
    )
    assert values(dates.parse_dates(df)) == [
        (D(2020, 1, 5), D(2020, 1, 5), "2020-01-05", "yes"), (None, None, "2020-01-05", "no"),
    ]
