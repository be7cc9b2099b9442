import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseloom.operators import curves, summary
from caseloom.plans.partials import DayCounts
from verification import fixture as fx

from .conftest import values

SF = "/root/testdata/sf0.001"
PAIRS = [("onsetdate", "sex"), ("reporteddate", "disposition")]
KINDS = {
    "completeness": (
        lambda df, by: summary.completeness_counts(df, by=tuple(by)),
        lambda c: summary.completeness_of(c, merge=True),
        summary.completeness,
    ),
    "count_summary": (
        lambda df, by: summary.summary_counts(df, by=tuple(by), max_unique=20),
        lambda c: summary.summary_of(c, merge=True, max_unique=20),
        lambda df: summary.count_summary(df, max_unique=20),
    ),
    "curves": (
        lambda df, by: curves.curve_parts(df, PAIRS, by=tuple(by)),
        lambda c: curves.with_shares(curves.curve_of(c)),
        lambda df: curves.epi_curve_batch(df, PAIRS),
    ),
}


def rows(df):
    return sorted(values(df.select(*sorted(df.columns))), key=str)


def cases(spark):
    """Cases of which some have no report day."""
    day = F.when(F.col("k") % 17 > 0, F.col("phacreporteddate")).alias("phacreporteddate")
    df = fx.cases(spark, SF)
    return df.select(*[day if c == "phacreporteddate" else F.col(c) for c in df.columns])


def days_of(df):
    return sorted(d for d in values(df.select("phacreporteddate").distinct()) if d)


@pytest.mark.parametrize("kind", KINDS)
def test_merged_equals_recomputed(spark, tmp_path, kind):
    """Three runs, of which one counts days again whose rows have changed, against one count of the last table."""
    count, finish, whole = KINDS[kind]
    df = cases(spark)
    days = days_of(df)
    a, b, c = days[len(days) // 3], days[2 * len(days) // 3], days[-1]
    kept = DayCounts(spark, f"{tmp_path}/counts", count)
    kept.update(df, a)
    # as of now the last days before were incomplete, and one of them is gone
    late = F.col("phacreporteddate").between(F.lit(a) - F.expr("interval 5 days"), F.lit(a))
    first = df.where(~F.coalesce(late, F.lit(False)) | (F.col("k") % 2 == 0)).where(~F.col("phacreporteddate").eqNullSafe(F.lit(a)))
    # days are counted again from the first of them on
    counted = kept.update(first, b, again=6)
    assert min(d for d in counted if d != "none") > (a - dt.timedelta(days=7)).isoformat()
    kept.update(first, c)
    assert rows(finish(kept.merged())) == rows(whole(first))
    kept.compact()
    kept.prune()
    assert len([n for n in kept.files.names(kept.folder) if n.startswith("run=")]) == 1
    assert rows(finish(kept.merged())) == rows(whole(first))


def test_days_in_the_middle_and_many_runs(spark, tmp_path):
    """Days before the last run are counted again without losing those after them; runs are written together at times."""
    df, days = cases(spark), days_of(cases(spark))
    kept = DayCounts(spark, f"{tmp_path}/counts", KINDS["completeness"][0], most_runs=3)
    for upto in (days[10], days[40], days[-1]):
        kept.update(df, upto)
    gone = df.where(~F.coalesce(F.col("phacreporteddate") == F.lit(days[20]), F.lit(False)))
    kept.update(gone, days[25], again=(days[-1] - days[15]).days)
    assert len({r["run"] for r in kept.state()["runs"]}) == 1
    assert rows(summary.completeness_of(kept.merged(), merge=True)) == rows(summary.completeness(gone))
    assert kept.state()["upto"] == days[-1].isoformat()


def test_a_run_reads_new_days_only(spark, tmp_path):
    df = cases(spark)
    df.select("phacid", "pt", "classification", "age", "phacreporteddate").write.parquet(f"{tmp_path}/in")
    table, seen = spark.read.parquet(f"{tmp_path}/in"), []

    def count(part, by):
        seen.append(part)
        return summary.completeness_counts(part, by=tuple(by))

    days = days_of(df)
    kept = DayCounts(spark, f"{tmp_path}/counts", count)
    kept.update(table, days[-20])
    assert len(kept.update(table, days[-1])) == 20
    plan = seen[1]._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThan(phacreporteddate,{days[-20]})" in plan.replace("\n", "")
    # nothing is new: rows without a day are counted again, once
    assert kept.update(table, days[-1]) == ["none"]
    assert rows(summary.completeness_of(kept.merged(), merge=True)) == rows(summary.completeness(table))


def test_a_run_that_dies_changes_nothing(spark, tmp_path):
    df, days = cases(spark), days_of(cases(spark))
    kept = DayCounts(spark, f"{tmp_path}/counts", KINDS["completeness"][0])
    kept.update(df, days[9])
    before = rows(kept.merged())
    dies = DayCounts(spark, f"{tmp_path}/counts", lambda d, by: summary.completeness_counts(d, by=tuple(by)).where(F.raise_error(F.lit("dies"))))
    with pytest.raises(Exception, match="dies"):
        dies.update(df, days[-1])
    assert rows(kept.merged()) == before and kept.state()["upto"] == days[9].isoformat()


def test_a_column_of_many_values_stays_out(spark, tmp_path):
    """Many values in days counted together: few in a later run do not bring the column back."""
    start = dt.date(2021, 1, 1)
    data = [(f"p{i}", "x", "a", start + dt.timedelta(days=i % 4), f"v{i if i % 4 < 2 else 0}", i % 3) for i in range(200)]
    df = spark.createDataFrame(data, "phacid string, pt string, agegroup10 string, phacreporteddate date, many string, few int")
    kept = DayCounts(spark, f"{tmp_path}/c", lambda d, by: summary.summary_counts(d, by=tuple(by), max_unique=10))
    for day in range(1, 4, 2):
        kept.update(df, start + dt.timedelta(days=day))
    got = summary.summary_of(kept.merged(), merge=True, max_unique=10)
    assert rows(got) == rows(summary.count_summary(df, max_unique=10))
    assert "many" not in values(got, "name") and "few" in values(got, "name")


def test_nothing_counted_and_empty_tables(spark, tmp_path):
    kept = DayCounts(spark, f"{tmp_path}/c", KINDS["completeness"][0])
    with pytest.raises(ValueError, match="counted"):
        kept.merged()
    assert kept.update(cases(spark).limit(0), dt.date(2021, 1, 1)) == []
    assert summary.completeness_of(kept.merged(), merge=True).count() == 0
