from pyspark.sql import functions as F

from caseloom.operators import diff
from verification import fixture as fx

from .conftest import values

SF = "/root/testdata/sf0.001"


def test_table_equals_itself(spark):
    a = fx.first_source(spark, SF)
    assert diff.cell_diff(a, a.select("*")).count() == 0
    assert diff.missing_rows(a, a.select("*")).count() == 0


def test_cells_need_both_values(spark):
    schema = "phacid string, pt string, ptcaseid string, v string, w int"
    a = spark.createDataFrame([("1", "x", "1", "a.b", 1), ("2", "x", None, "same", None), ("3", "x", "9", "only", 1)], schema)
    b = spark.createDataFrame([("7", "x", "1", "c", 2), ("8", "x", None, "other", 5)], schema)
    got = sorted(values(diff.cell_diff(a, b)))
    assert got == [
        ("v", "1", "7", "x", "1", "A B", "C"), ("v", "2", "8", "x", None, "Same", "Other"),
        ("w", "1", "7", "x", "1", "1", "2"),
    ]


def test_missing_rows_match_null_keys(spark):
    schema = "phacid string, pt string, ptcaseid string, phacreporteddate date, classification string"
    a = spark.createDataFrame([("1", "x", None, None, "c"), ("2", "x", "2", None, "c")], schema)
    b = spark.createDataFrame([("9", "x", None, None, "c")], schema)
    assert values(diff.missing_rows(a, b), "phacid") == ["2"]


def test_normalise(spark):
    df = spark.createDataFrame([("not collected", "unknown", "unknown")], "Sex string, disposition string, hosp string")
    assert values(diff.normalise_second(df)) == [("", "", "unknown")]
    first = diff.normalise_first(spark.createDataFrame([("ABC", 1)], "PT string, Age int"))
    assert first.columns == ["pt", "age"] and values(first) == [("abc", 1)]


def test_names_from_lookup(spark):
    df = spark.createDataFrame([(2, "Fever"), (1, "Sore throat")], "symptomid int, symptomname string")
    assert diff.names_from_lookup(df, "symptomid", "symptomname") == {1: "Sore throat", 2: "Fever"}


def test_long_to_wide_has_no_pivot_job(spark):
    wide = diff.symptoms_wide(fx.symptoms(spark, SF))
    assert wide.columns[:3] == ["phacid", "asymptomatic", "symcough"]
    assert "pivotfirst" not in wide._jdf.queryExecution().executedPlan().toString().lower()


def test_missing_keys_may_stay_apart(spark):
    schema = "phacid string, pt string, ptcaseid string, v string"
    a = spark.createDataFrame([("1", "x", None, "a"), ("2", "x", "2", "a")], schema)
    b = spark.createDataFrame([("3", "x", None, "b"), ("4", "x", "2", "b")], schema)
    assert diff.cell_diff(a, b).count() == 2
    assert values(diff.cell_diff(a, b, match_missing=False), "phacid_orig") == ["2"]
    assert values(diff.repeated_keys(a.union(a).where("ptcaseid = '2'")), "n") == [2]


def test_repeated_and_missing_keys_never_multiply(spark):
    """10,000 rows without a key on each side, and a key that repeats on one side."""
    null = F.lit(None).cast("string")

    def source(name, rows):
        many = spark.range(10_000).select(F.concat(F.lit(name), F.col("id").cast("string")).alias("phacid"), F.lit("x").alias("pt"), null.alias("ptcaseid"), F.lit(name).alias("v"))
        return many.union(spark.createDataFrame(rows, "phacid string, pt string, ptcaseid string, v string"))

    a = source("a", [("1", "x", "1", "p"), ("2", "x", "2", "p"), ("3", "x", "2", "p"), ("4", None, None, "p")])
    b = source("b", [("5", "x", "1", "q"), ("6", "x", "2", "q"), ("7", None, None, "q")])
    assert sorted(values(diff.cell_diff(a, b), "phacid_orig", "phacid_meta")) == [("1", "5"), ("4", "7")]
    assert sorted(values(diff.ambiguous_keys(a, b)), key=str) == [("x", "2", 2, 1), ("x", None, 10_000, 10_000)]


def test_ambiguous_keys_by_shuffle(spark, monkeypatch):
    schema = "phacid string, pt string, ptcaseid string, v string"
    a = spark.createDataFrame([("1", "x", "1", "a"), ("2", "x", "1", "a"), ("3", "x", None, "a")], schema)
    b = spark.createDataFrame([("4", "x", "1", "b"), ("5", "x", None, "b")], schema)
    monkeypatch.setattr(diff, "is_small", lambda t: False)
    assert values(diff.cell_diff(a, b), "phacid_orig") == ["3"]


def test_missing_rows_need_no_distinct(spark):
    a = fx.first_source(spark, SF)
    plan = diff.missing_rows(a, fx.second_source(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_columns_without_counts_read_no_data(spark):
    a, b = fx.first_source(spark, SF), fx.second_source(spark, SF)
    quick = diff.columns_diff(a, b, counts=False)
    assert sorted(values(quick)) == sorted(values(diff.columns_diff(a, b), "colname", "found_in"))
    assert "parquet" not in quick._jdf.queryExecution().executedPlan().toString()


def test_items_without_a_name_are_kept(spark):
    df = spark.createDataFrame([("1", 9, "yes"), ("1", 77, "no"), ("2", 2, "no"), ("3", None, "odd")], "phacid string, symptomid int, symptomvalue string")
    got = {r["phacid"]: r for r in diff.symptoms_wide(df).collect()}
    assert got["1"]["symheadache"] == "yes" and got["1"]["symna"] == "no"
    assert got["2"]["symcough"] == "no" and got["2"]["symna"] is None and got["3"]["symna"] == "odd"
    lookup = spark.createDataFrame([(77, "Rash / hives"), (None, "x")], "symptomid int, symptomname string")
    wide = diff.long_to_wide(df, lookup, id_col="symptomid", value_col="symptomvalue", prefix="sym")
    assert wide.columns == ["phacid", "symrash_hives", "symna"]


def test_lookup_is_bounded(spark):
    import pytest

    with pytest.raises(ValueError, match="names in a lookup"):
        diff.names_from_lookup(spark.range(5).selectExpr("id", "string(id) AS n"), "id", "n", most=4)


def test_view_reduces_every_side(spark):
    """Two rows of each side for one case still give one row."""
    one = spark.createDataFrame([("1", "x", "confirmed", None, 5, None, None, None, None, None)],
                                "phacid string, pt string, classification string, sex string, age int, agegrouping string, "
                                "occupation string, occupationhcw string, ltc_resident string, onsetdate date")
    symptoms = spark.createDataFrame([("1", 35, "yes", "rash"), ("1", 13, "no", None)], "phacid string, symptomid int, symptomvalue string, symptomspec string")
    severity = spark.createDataFrame([("1", "no", None, "yes", None, None, None, "ill", None), ("1", "no", None, None, None, None, None, None, None)],
                                     "phacid string, hosp string, hospstartdate date, icu string, icustartdate date, mechanicalvent string, "
                                     "ventstartdate date, disposition string, recoverydate date")
    exposures = spark.createDataFrame([("1", None, None), ("1", "yes", None)], "phacid string, closecontacttravel string, closecontactcase string")
    lab = spark.createDataFrame([("1", None, None)] * 2, "phacid string, labspecimencollectiondate date, labtestresultdate date")
    travel = spark.createDataFrame([("1", "canada")] * 2, "phacid string, travel_international_loc string")
    rows = diff.case_view(one, symptoms, severity, exposures, lab, travel).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.symother, r.symotherspec, r.symdiarrhea, r.hospstatus, r.disposition2, r.exposure_cat2) == (
        "yes", "rash", "no", "hospitalized - icu", "stable", "domestic acquisition",
    )


def wide(spark, rows, change):
    """Rows with 40 columns of text; ``change`` is SQL for which of them differ."""
    cells = [F.concat(F.lit(f"c{j} "), F.col("id")).alias(f"c{j:02}") for j in range(40)]
    first = spark.range(rows).select(F.concat(F.lit("p"), "id").alias("phacid"), F.lit("x").alias("pt"), F.col("id").cast("string").alias("ptcaseid"), "id", *cells)
    return first, first.withColumn("c07", F.when(F.expr(change), F.lit("other")).otherwise(F.col("c07")))


def test_equal_sources_send_digests_only(spark):
    a, b = wide(spark, 5000, "false")
    plan = diff.cell_diff(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Range" not in plan
    # what meets in a shuffle is as narrow as a digest
    plan = diff.changed_keys(a, b)._jdf.queryExecution().optimizedPlan().toString()
    assert "c07" not in plan and diff.changed_keys(a, b).count() == 0


def test_only_changed_rows_are_joined(spark):
    a, b = wide(spark, 5000, "id % 1000 = 1")
    changed = diff.changed_keys(a, b, ranges=64)
    assert sorted(values(changed, "n_0", "n_1")) == [(1, 1)] * 5
    got = diff.cell_diff(a, b, ranges=64)
    assert sorted(values(got, "colname", "phacid_orig")) == [("c07", f"p{i}001" if i else "p1") for i in range(5)]


def test_swapped_rows_types_and_missing_values_differ(spark):
    """Values that change places between keys, numbers against text, floats, and nulls in several columns."""
    a = spark.createDataFrame(
        [("1", "x", "1", "u", "v", 1, 0.5), ("2", "x", "2", "v", "u", 2, 1.5), ("3", "x", "3", None, "w", 3, None), ("4", "x", "4", "k", "k", 4, 2.0)],
        "phacid string, pt string, ptcaseid string, p string, q string, n int, f double",
    )
    b = spark.createDataFrame(
        [("1", "x", "1", "v", "u", "1", 0.5), ("2", "x", "2", "u", "v", "7", 1.25), ("3", "x", "3", "w", None, "3", 9.0), ("4", "x", "4", "k", "k", "4", 2.0)],
        "phacid string, pt string, ptcaseid string, p string, q string, n string, f double",
    )
    got = sorted(values(diff.cell_diff(a, b), "colname", "ptcaseid"))
    assert got == [("f", "2"), ("n", "2"), ("p", "1"), ("p", "2"), ("q", "1"), ("q", "2")]


def test_keys_of_other_types_still_match(spark):
    a = spark.createDataFrame([("1", "x", 1, "a"), ("2", "x", 2, "a"), ("3", "x", None, "a")], "phacid string, pt string, ptcaseid int, v string")
    b = spark.createDataFrame([("1", "x", "01", "b"), ("2", "x", "2", "a"), ("3", "x", None, "c")], "phacid string, pt string, ptcaseid string, v string")
    assert sorted(values(diff.cell_diff(a, b), "phacid_orig")) == ["1", "3"]
