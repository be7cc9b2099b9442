import pytest
from pyspark.sql import functions as F

from caseloom.functions import categories as cat
from caseloom.functions import text

from .conftest import values


def run(spark, column, *inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, x string")
    return values(df.orderBy("i").select(column.alias("y")))


def test_clean_str(spark):
    got = run(spark, text.clean_str("x"), "  heLLo,  world!", None, "na", " na", "...", "x-ray", "a+b", "\tend\n")
    assert got == ["Hello World", "", "", "Na", "", "X Ray", "A+b", "End"]


def test_clean_str_recases_replacements(spark):
    c = text.clean_str("x", na_replace="NULL or BLANK STRING", blank_replace="NULL or BLANK STRING")
    assert run(spark, c, None, " - ", "na", "b") == ["Null Or Blank String"] * 3 + ["B"]


def test_clean_str_options(spark):
    assert run(spark, text.clean_str("x", strip_punct=False, case=F.lower), "A-B.  C") == ["a-b. c"]
    assert run(spark, text.clean_str("x", replacement="-", na_replace="Not Stated"), "2020/01/05", None) == [
        "2020-01-05", "Not Stated",
    ]
    assert run(spark, text.clean_str("x", na_replace="zz", replace_na_text=False), "na") == ["Na"]


def test_clean_str_b_keeps_punctuation(spark):
    assert run(spark, text.clean_str_b("x"), " a.b   c ", None) == ["A.b C", ""]


def test_clean_up(spark):
    assert run(spark, text.clean_up("x"), " UNK ", "Not Asked", None, " Yes\t", "unknown") == ["", "", "", "yes", ""]


def test_small_helpers(spark):
    assert run(spark, text.number_to_id("x"), "48 12 3") == ["48-12-3"]
    assert run(spark, text.insert_str("x", "-", after=2), "48123", "4") == ["48-123", "4-"]
    assert run(spark, text.na_text("x"), None, "a") == ["NA", "a"]
    assert run(spark, text.percent_label(F.col("x").cast("double")), "0.417", "0.125", "1") == ["42%", "12%", "100%"]


def test_categorical(spark):
    c = cat.clean_categorical("x", ["male", "female"], bad_value_replace="not stated")
    assert run(spark, c, "MALE", " female.", "", None, "robot") == [
        "Male", "Female", "Not Stated", "Not Stated", "Unknown",
    ]


def test_yes_no_leaves_single_letters_unknown(spark):
    assert run(spark, cat.clean_yes_no("x"), "yes", "NO", "y", None, "") == ["Yes", "No", "Unknown", "", ""]
    assert run(spark, cat.clean_yes_no("x", map_yn=True), "y", "N.") == ["Yes", "No"]


def test_top_n_ties_go_to_the_first_value(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "B!", "a", "c", "", ""]], "x string")
    got = sorted(values(cat.clean_categorical_top_n(df, "x", 2)))
    # blank, A and B occur twice each: blank and A are kept
    assert got == ["", "", "A", "A", "Unknown", "Unknown", "Unknown"]


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("PTCaseID", "pt_case_id"), ("EpisodeDate", "episode_date"), ("% done", "percent_done"),
        ("2nd", "x2nd"), ("a.b c", "a_b_c"), ("nm_frac_yes2", "nm_frac_yes2"),
    ],
)
def test_snake_case(name, expected):
    assert text.snake_case(name) == expected


def test_snake_names_are_unique():
    assert text.snake_names(["a b", "A.B", "c"]) == ["a_b", "a_b_2", "c"]


def test_matching_ignores_case_by_default():
    names = ["OnsetDate", "updated", "SymOtherSpec", "symcough"]
    assert text.matching(names, "date") == ["OnsetDate", "updated"]
    assert text.matching(names, "Date", ignore_case=False) == ["OnsetDate"]
    assert text.matching(names, r"^sym.*(?<!spec)$") == ["symcough"]
