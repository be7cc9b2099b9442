import bisect
import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from caseloom.functions.expressions import first_above, halvings
from caseloom.operators import impute
from verification import fixture as fx

from .conftest import values

SF = "/root/testdata/sf0.001"
SOURCES = [c for c in impute.SOURCES if c != "earliestdate"]
IMPUTED = [f"{t}_imputed" for t in impute.TARGETS]


def place(k, seed, target, source, n):
    """The draw by hand: 62 mixed bits times n, whole sequences of bits above the lowest 62."""
    p, (lo, hi) = 2147483647, (k >> 31, k & 0x7FFFFFFF)
    lo, hi = lo % p, hi % p
    for c in impute.round_numbers(seed, target, source):
        lo, hi = hi, (lo + ((hi + c) % p) ** 2) % p
    return (hi << 31 | lo) * n >> 62


def run(df, **kw):
    out = impute.impute_dates(df, sources=SOURCES, key=F.col("k"), **kw)
    return sorted(values(out, "phacid", *IMPUTED), key=lambda r: r[0])


def test_sources_that_contain_the_target_name_are_left_out():
    assert impute.usable_sources("reporteddate", ["phacreporteddate", "reporteddate", "onsetdate"]) == ["onsetdate"]
    assert "reporteddate" in impute.usable_sources("phacreporteddate", ["reporteddate"])


def test_present_dates_are_kept_and_range_holds(spark):
    df = fx.cases(spark, SF)
    out = impute.impute_dates(df, sources=SOURCES, key=F.col("k"))
    for t in impute.TARGETS:
        assert out.where(F.col(t).isNotNull() & ~F.col(t).eqNullSafe(F.col(f"{t}_imputed"))).count() == 0
        bounds = df.groupBy("pt").agg(F.min(t).alias("lo"), F.max(t).alias("hi"))
        outside = out.join(bounds, "pt").where((F.col(f"{t}_imputed") < F.col("lo")) | (F.col(f"{t}_imputed") > F.col("hi")))
        assert outside.count() == 0
    assert out.where("onsetdate_imputed is not null").count() > df.where("onsetdate is not null").count()


def test_same_result_for_other_partitionings_and_seeds_differ(spark):
    df = fx.cases(spark, SF)
    first = run(df)
    assert run(df.repartition(7, "sex")) == first
    assert run(df, seed=99) != first


def test_shuffle_joins_give_the_same_result(spark, monkeypatch):
    df = fx.cases(spark, SF)
    first = run(df)
    monkeypatch.setattr(impute, "is_small", lambda t: False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert run(df) == first
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_draws_follow_the_observed_gaps(spark):
    """Brute force on one region: donors sorted, picked by position."""
    rows, start = [], dt.date(2020, 1, 1)
    for i in range(200):
        onset = None if i % 3 == 0 else start + dt.timedelta(days=i)
        reported = start + dt.timedelta(days=i + (i * i) % 9)
        rows.append((f"p{i}", "x", i, onset, reported))
    df = spark.createDataFrame(rows, "phacid string, pt string, k long, onsetdate date, reporteddate date")
    out = impute.impute_dates(
        df, ["onsetdate"], ["reporteddate"], key=F.col("k"), seed=4, suppress_out_of_range=False
    )
    got = dict(values(out, "phacid", "onsetdate_imputed"))
    donors = sorted((r[4] - r[3]).days for r in rows if r[3])
    for pid, _, k, onset, reported in rows:
        gap = donors[place(k, 4, "onsetdate", "reporteddate", len(donors))]
        assert got[pid] == (onset or reported - dt.timedelta(days=gap))


def test_source_with_half_missing_gaps_is_not_used(spark):
    rows = [(f"p{i}", "x", i, dt.date(2020, 1, 1) if i % 2 else None, dt.date(2020, 1, 3)) for i in range(10)]
    df = spark.createDataFrame(rows, "phacid string, pt string, k long, onsetdate date, reporteddate date")
    out = impute.impute_dates(df, ["onsetdate"], ["reporteddate"], key=F.col("k"))
    assert out.where("onsetdate is null and onsetdate_imputed is not null").count() == 0


def test_missing_region_gets_no_imputed_date(spark):
    rows = [("a", None, 1, dt.date(2020, 1, 1), dt.date(2020, 1, 2))]
    rows += [(f"b{i}", "x", i, dt.date(2020, 1, 1), dt.date(2020, 1, 2)) for i in range(4)]
    df = spark.createDataFrame(rows, "phacid string, pt string, k long, onsetdate date, reporteddate date")
    got = dict(values(impute.impute_dates(df, ["onsetdate"], ["reporteddate"], key=F.col("k")), "phacid", "onsetdate_imputed"))
    assert got["a"] is None and got["b1"] == dt.date(2020, 1, 1)


def test_one_region_holding_most_rows(spark):
    """Each row comes back exactly once."""
    df = fx.cases(spark, SF).withColumn("pt", F.when(F.col("k") % 10 == 0, F.col("pt")).otherwise(F.lit("BIG")))
    out = impute.impute_dates(df, sources=SOURCES, key=F.col("k"))
    assert out.count() == df.count()
    assert max(Counter(values(out, "phacid")).values()) == 1


def test_default_key_is_the_hashed_id(spark):
    df = fx.cases(spark, SF)
    a = impute.imputed_date(df, "onsetdate", ["reporteddate"])
    b = impute.imputed_date(df.repartition(3), "onsetdate", ["reporteddate"])
    assert sorted(values(a, "phacid", "onsetdate_imputed"), key=str) == sorted(values(b, "phacid", "onsetdate_imputed"), key=str)


def test_result_adds_no_shuffle(spark):
    df = fx.cases(spark, SF)
    plan = impute.impute_dates(df, sources=SOURCES, key=F.col("k"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("target", impute.TARGETS)
def test_every_usable_gap_is_filled(spark, target):
    df = fx.cases(spark, SF)
    out = impute.date_deltas(df, target, SOURCES, group="pt", key=F.col("k"))
    counts = set(values(out.groupBy("pt", "source").count(), "pt", "count"))
    sizes = set(values(df.groupBy("pt").count(), "pt", "count"))
    assert counts and counts <= sizes


def two_unrelated(spark):
    """4,000 cases with two unrelated dates; either is missing on a third."""
    d = F.lit("2020-06-01").cast("date")
    k = F.col("k")

    def part(seed, n):
        return F.pmod(F.xxhash64(k, F.lit(seed)), F.lit(n)).cast("int")

    return spark.range(4000).withColumnRenamed("id", "k").select(
        "k", k.cast("string").alias("phacid"), F.lit("x").alias("pt"), d.alias("reporteddate"),
        F.when(part(1, 3) > 0, F.date_sub(d, part(2, 40))).alias("onsetdate"),
        F.when(part(3, 3) > 0, F.date_sub(d, part(4, 40))).alias("episodedate"),
    )


def test_draws_for_two_dates_are_unrelated(spark):
    df = two_unrelated(spark)
    out = impute.impute_dates(df, ["onsetdate", "episodedate"], ["reporteddate"], key=F.col("k"))
    both = out.where("onsetdate IS NULL AND episodedate IS NULL")
    gaps = both.select(F.datediff("reporteddate", "onsetdate_imputed").alias("a"), F.datediff("reporteddate", "episodedate_imputed").alias("b"))
    assert gaps.count() > 300
    assert abs(gaps.corr("a", "b")) < 0.15


def test_draws_are_uniform_over_the_donors(spark):
    df = two_unrelated(spark)
    out = impute.date_deltas(df, "onsetdate", ["reporteddate"], key=F.col("k"))
    shares = {}
    for drawn in (False, True):
        rows = out.where(F.col("drawn") == drawn).groupBy((F.col("gap") / 8).cast("int").alias("g")).count().collect()
        total = sum(r["count"] for r in rows)
        shares[drawn] = {r["g"]: r["count"] / total for r in rows}
    assert all(abs(shares[True].get(g, 0) - p) < 0.05 for g, p in shares[False].items())


def test_shuffled_histograms_move_the_table_once(spark, monkeypatch):
    monkeypatch.setattr(impute, "is_small", lambda t: False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = fx.cases(spark, SF)
        plan = impute.impute_dates(df, sources=SOURCES, key=F.col("k"))._jdf.queryExecution().executedPlan().toString()
        own = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") - own.count("SortMergeJoin") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_positions_among_billions_of_donors(spark):
    """Every part of 6e9 donors, and of far more, is drawn from alike; the arithmetic is exact."""
    numbers = impute.round_numbers(0, "onsetdate", "reporteddate")
    for n in (1, 7, 6_000_000_000, (1 << 62) - 1):
        at = impute._position(F.col("id"), F.lit(n), numbers).alias("at")
        rows = values(spark.range(-1000, 19_000).select("id", at), "id", "at")
        assert all(at == place(k, 0, "onsetdate", "reporteddate", n) for k, at in rows)
        if n > 1000:
            parts = Counter(at * 16 // n for _, at in rows)
            assert set(parts) == set(range(16)) and all(abs(c - 1250) < 180 for c in parts.values())
            assert len({at for _, at in rows}) > 19_990


def test_gaps_from_a_histogram_of_six_billion_donors(spark):
    """Gaps are drawn in proportion, also those that only positions beyond 2**32 reach."""
    gaps = [(g, 600_000_000 * (g + 1)) for g in range(10)]
    h = F.struct(F.lit(6_000_000_000).alias("donors"), F.array(*[F.lit(e) for _, e in gaps]).alias("ends"), F.array(*[F.lit(g) for g, _ in gaps]).alias("gaps"))
    got = spark.range(20_000).select(h.alias("h_a_b"), F.xxhash64("id").alias("key")).select(impute._gap(F.col("key"), 3, "a", "b").alias("g"))
    counts = dict(values(got.groupBy("g").count(), "g", "count"))
    assert set(counts) == set(range(10)) and all(abs(c - 2000) < 250 for c in counts.values())


def test_keys_above_31_bits_have_draws_of_their_own(spark):
    at = impute._position(F.col("id"), F.lit(1 << 60), impute.round_numbers(0, "a", "b"))
    shifted = spark.range(2000).select(F.explode(F.array(F.col("id"), F.col("id") + 2147483647, F.col("id") + (1 << 40))).alias("id"))
    assert shifted.select(at.alias("at")).distinct().count() > 5900


def test_a_search_takes_as_many_steps_as_its_list_needs(spark):
    sizes = [0, 1, 2, 3, 11, 64, 1000]
    df = spark.createDataFrame([(n, [2 * i for i in range(n)], at) for n in sizes for at in (-1, 0, 1, 5, n, 2 * n)], "n int, v array<int>, at int")
    steps = halvings(F.size("v"))
    for n, at, found, k in values(df.select("n", "at", first_above(F.col("v"), F.col("at"), steps).alias("i"), F.size(steps).alias("k"))):
        assert found == bisect.bisect_right([2 * i for i in range(n)], at) and k == n.bit_length()


def test_only_missing_gaps_are_drawn_for_the_ranks(spark):
    rows = impute._prepared(fx.cases(spark, SF), [*impute.TARGETS, *SOURCES], "pt", "phacid", F.col("k"))
    model = impute._Model(rows, impute.TARGETS, SOURCES, 0.5)
    tables = model.histograms()
    every, some = model.drawn(rows, tables, True, 0), model.drawn(rows, tables, True, 0, known=False)
    assert sorted(values(every.where("drawn")), key=str) == sorted(values(some), key=str)
