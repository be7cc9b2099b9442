import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.functions.binomial import exact_limits
from caseloom.operators import curves, rates
from verification import fixture as fx

from .conftest import values

SF = "/root/testdata/sf0.001"


def test_lumping_needs_two_rare_levels(spark):
    one = spark.createDataFrame([("a", 97), ("b", 1)], "f string, n long")
    assert sorted(values(curves.lump_rare(one, "f", [], 0.02), "f")) == ["a", "b"]
    two = spark.createDataFrame([("a", 97), ("b", 1), ("c", 2), (None, 1)], "f string, n long")
    assert sorted(values(curves.lump_rare(two, "f", [], 0.02), "f"), key=str) == [None, "Other", "Other", "a"]


def test_lumping_per_series(spark):
    df = spark.createDataFrame(
        [("s", "a", 97), ("s", "b", 1), ("s", "c", 1), ("t", "b", 50), ("t", "c", 50)], "k string, f string, n long"
    )
    got = sorted(values(curves.lump_rare(df, "f", ["k"], 0.02), "k", "f", "n"))
    assert got == [("s", "Other", 1), ("s", "Other", 1), ("s", "a", 97), ("t", "b", 50), ("t", "c", 50)]


def test_rolling_mean_counts_rows_not_days(spark):
    start = dt.date(2020, 1, 1)
    rows = [("x", start + dt.timedelta(days=3 * i), i) for i in range(9)]
    df = spark.createDataFrame(rows, "facet string, date date, n long")
    got = values(curves.rolling_mean(df).orderBy("date"), "roll_mean")
    assert got == [None] * 6 + [3.0, 4.0, 5.0]
    trimmed = curves.rolling_mean(df, since=start + dt.timedelta(days=18))
    assert sorted(values(trimmed, "roll_mean")) == [3.0, 4.0, 5.0]


def test_curve_shares(spark):
    df = fx.cases(spark, SF)
    out = curves.epi_curve_counts(df, "onsetdate", "sex")
    per_color = values(out.select("color", "color_percent").distinct())
    assert math.isclose(sum(p for _, p in per_color), 100)
    kept = df.where("classification <> 'Suspect' and onsetdate is not null").count()
    assert values(out.agg(F.sum("n").alias("n"))) == [kept]


def test_two_significant_digits(spark):
    want = {33.333: "33", 100.0: "100", 5.678: "5.7", 5.0: "5", 5.04: "5", 0.123: "0.12", 9.96: "10", 9.94: "9.9", 0.5: "0.5", 99.7: "100",
            0.0: "0", 0.0123: "0.012", 0.996: "1", 12.5001: "13"}
    df = spark.createDataFrame([(k,) for k in want], "x double")
    assert dict(values(df.select("x", curves.two_digits(F.col("x")).alias("t")))) == want


def test_labels(spark):
    rows = [("confirmed", "x", dt.date(2020, 1, 1), "a")] * 1 + [("confirmed", "x", dt.date(2020, 1, 1), "b")] * 2
    df = spark.createDataFrame(rows, "classification string, pt string, onsetdate date, sex string")
    out = curves.with_labels(curves.epi_curve_counts(df, "onsetdate", "sex"))
    assert sorted(values(out, "color_lbl", "facet_lbl")) == [
        ("A (33%)", "x\n100%\nPeak:2\nTotal:3"), ("B (67%)", "x\n100%\nPeak:2\nTotal:3"),
    ]


def test_six_months_before_clips_the_day(spark):
    assert values(spark.range(1).select(curves.six_months_before("2020-08-31").alias("d"))) == [dt.date(2020, 2, 29)]


def test_ribbon_without_days_is_empty(spark):
    d = dt.date
    rows = [("confirmed", "x", d(2020, 1, 1), d(2020, 3, 1), "a"), ("confirmed", "y", d(2020, 1, 1), d(2020, 1, 3), "a")]
    df = spark.createDataFrame(rows, "classification string, pt string, onsetdate date, phacreporteddate date, sex string")
    out = curves.reporting_lag_ribbon(df, "onsetdate", "sex", asof="2020-03-05")
    # x starts on 16 February, after the last day shown; y runs from 20 December to 1 January
    assert out.select("facet").distinct().collect()[0][0] == "y" and out.count() == 13


def _tail(x, n, p, upper):
    ks = range(x, n + 1) if upper else range(x + 1)
    return sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in ks)


@pytest.mark.parametrize(("x", "n"), [(1, 10), (5, 10), (9, 10), (3, 250), (120, 250), (0, 7), (7, 7)])
def test_exact_limits_solve_the_tail_equations(x, n):
    lower, upper = (v[0] for v in exact_limits(np.array([x]), np.array([n]), 0.05))
    assert lower == 0 if x == 0 else abs(_tail(x, n, lower, True) - 0.025) < 1e-9
    assert upper == 1 if x == n else abs(_tail(x, n, upper, False) - 0.025) < 1e-9


def test_exact_limits_for_large_and_empty_samples():
    lower, upper = exact_limits(np.array([5_000_000, 0]), np.array([10_000_000, 0]), 0.05)
    assert abs(lower[0] - 0.49969) < 1e-5 and abs(upper[0] - 0.50031) < 1e-5
    assert np.isnan(lower[1]) and np.isnan(upper[1])


def test_positive_value_is_the_most_frequent_without_yes(spark):
    rows = [("x", "0-19", "stable")] * 3 + [("x", "0-19", "ill"), ("x", "20-39", "unk")]
    df = spark.createDataFrame(rows, "pt string, agegroup10 string, d string")
    out = rates.positivity_by_age(df, "d", min_fraction=0.5, min_sample=1, include_canada=True)
    assert values(out.where("pt = 'CANADA'"), "age_group", "nm_yes", "nm_no") == [("0-19", 3, 1)]
    # the region's own values are neither Yes nor No
    assert values(out.where("pt = 'x'"), "nm_total", "nm_frac_yes") == [(0, None)]


def test_sample_size_must_exceed_the_minimum(spark):
    rows = [("a", True, 100), ("b", True, 101), ("CANADA", False, 5)]
    df = spark.createDataFrame(rows, "pt string, is_recorded boolean, n long")
    assert sorted(values(rates.recorded_by_region(df), "pt")) == ["CANADA", "b"]
    assert values(rates.recorded_by_region(df, include_canada=False), "pt") == ["b"]


def test_leading_age(spark):
    df = spark.createDataFrame([("p", a, "y") for a in ("0-19", "80+", "Unknown")], "pt string, agegroup20 string, v string")
    assert sorted(values(rates.value_counts_by_age(df, "v"), "age_group", "min_age"), key=str) == [
        ("0-19", 0), ("80+", 80), ("Unknown", None),
    ]


def test_limits_travel_without_the_package(tmp_path):
    """Executors have no copy of the package: the functions are pickled by value."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from caseloom.functions import binomial

    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(binomial.exact_limits))
    code = "import pickle, numpy as np; print(pickle.load(open('f.pkl', 'rb'))(np.array([0]), np.array([5]), 0.05)[0][0])"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "0.0", done.stderr
