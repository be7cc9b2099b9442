import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from caseloom.operators import clean, reports
from caseloom.plans import extracts
from caseloom.plans.extracts import Extract
from caseloom.plans.publish import Manifest, publish_table
from caseloom.sources import sinks, tables
from caseloom.sources.files import Files
from caseloom.sources.store import ResultStore
from caseloom.streaming.quality import stream_errors
from verification import fixture as fx

from .conftest import values

SF = "/root/testdata/sf0.001"
MONDAY = dt.date(2021, 3, 1)


@pytest.mark.parametrize(("flag", "due"), [("x", True), (" . ", False), (None, False), ("na", False), ("yes", True)])
def test_due(spark, flag, due):
    e = Extract("r", "select 1", "unused", days={"Mon": flag})
    assert extracts.is_due(e, MONDAY) is due
    assert not extracts.is_due(e, MONDAY + dt.timedelta(days=1))
    config = spark.createDataFrame([("r", flag, "x")], "nm string, Mon string, Tue string")
    assert (extracts.due(config, MONDAY).count() == 1) is due


def test_run_due_writes_and_copies(spark, tmp_path):
    spark.range(5).select(F.col("id").alias("SomeId")).createOrReplaceTempView("t_src")
    config = [
        Extract("a", "select * from t_src;", f"{tmp_path}/a", "clean_names", "save_parquet", f"{tmp_path}/copy"),
        Extract("b", "select * from t_src", f"{tmp_path}/b", days={"Tue": "x"}),
    ]
    done = extracts.run_due(spark, config, MONDAY)
    assert [e.nm for e in done] == ["a"]
    assert spark.read.parquet(f"{tmp_path}/a").columns == ["some_id"]
    assert spark.read.parquet(f"{tmp_path}/copy").count() == 5
    assert not (tmp_path / "b").exists()


def test_unknown_functions_fall_back():
    assert extracts.by_name(extracts.ADJUSTERS, "nope", extracts.do_nothing) is extracts.do_nothing
    assert extracts.by_name(extracts.ADJUSTERS, None, extracts.do_nothing) is extracts.do_nothing


def test_truncated_names_must_stay_distinct(spark):
    df = spark.range(1).select(F.lit(1).alias("abc"), F.lit(2).alias("abd"))
    assert sinks.truncate_names(df, 3).columns == ["abc", "abd"]
    with pytest.raises(ValueError, match="collide"):
        sinks.truncate_names(df, 2)


def test_csv_keeps_text(spark, tmp_path):
    rows = [(1, ' a "quoted", text\nnext line '), (2, ""), (3, None), (4, "é")]
    df = spark.createDataFrame(rows, "i int, v string")
    sinks.save_csv(df.coalesce(1), f"{tmp_path}/c")
    back = dict(values(tables.read_csv(spark, f"{tmp_path}/c", "i int, v string")))
    assert back == {1: rows[0][1], 2: None, 3: None, 4: "é"}


def test_one_column_keeps_its_rows(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,), ("",), ('q"x',)], "v string")
    sinks.save_csv(df.coalesce(1), f"{tmp_path}/c")
    assert values(tables.read_csv(spark, f"{tmp_path}/c", "v string"), "v") == ["a", None, None, 'q"x']
    numbers = spark.createDataFrame([(1,), (None,)], "n int")
    sinks.save_csv(numbers.coalesce(1), f"{tmp_path}/n")
    assert values(tables.read_csv(spark, f"{tmp_path}/n", "n int"), "n") == [1, None]


def test_latin1(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("i,v\n1,Montréal\n".encode("latin-1"))
    df = tables.read_csv(spark, str(tmp_path / "x.csv"), "i int, v string", encoding="ISO-8859-1")
    assert values(df, "v") == ["Montréal"]


def test_tables_are_read_once(spark):
    t = tables.Tables(spark, SF)
    assert t.get("orders") is t.get("orders")
    old = t.get("orders")
    assert t.get("orders", refresh=True) is not old
    assert spark.table("region").count() == 5 if t.get("region") else False


def test_sql_extracts_share_equal_text(spark):
    s = tables.SqlExtracts(spark)
    assert s.get("select 1 as a") is s.get("select 1 as a")
    s.clear()


def test_final_clean(spark):
    config = [
        clean.Cleaning("r", "A", "yes", "$1", "none", "str_to_upper"), clean.Cleaning("r", "A", "yes", "Do Not"),
        clean.Cleaning("r", "B", "no"), clean.Cleaning("other", "B"),
    ]
    df = spark.createDataFrame([("a.b", "x.y", 1), ("", "", 2), (None, None, 3)], "A string, B string, c int")
    assert values(clean.final_clean(df, "r", ["B", "A"], config)) == [
        ("x.y", "A$1B"), ("", "NONE"), (None, "NONE"),
    ]


def test_hcdaily_drops_the_region(spark):
    hub = spark.range(1).select(F.lit("x").alias("pt"), F.lit(1).alias("n"))
    assert reports.report({"data_hub": hub}, "HCDaily").columns == ["n"]
    assert reports.report({"data_hub": hub}, "DataHub").columns == ["pt", "n"]


def test_end_of_day(spark, tmp_path):
    cases = fx.cases(spark, SF)
    cases.createOrReplaceTempView("t_cases")
    config = [Extract("weekly", "select phacid, pt from t_cases", f"{tmp_path}/weekly", "", "")]
    written = extracts.end_of_day(
        spark, cases, config, str(tmp_path), asof=dt.date.fromisoformat(fx.ASOF), min_date=fx.MIN_DATE
    )
    assert list(written) == ["daily_headline", "db_errs", "weekly", "ijn"]
    assert spark.read.option("header", True).csv(written["weekly"]).count() == cases.count()


def test_every_report_of_the_day_follows_the_schedule(spark, tmp_path):
    cases = fx.cases(spark, SF).limit(50)
    saturday = dt.date.fromisoformat(fx.ASOF)
    weekdays = dict.fromkeys(extracts.WEEKDAYS[:5], "x")
    written = extracts.end_of_day(
        spark, cases, [], str(tmp_path), asof=saturday, min_date=fx.MIN_DATE, after=["ijn", "completness", "count_summary"],
        days={"db_errs": weekdays, "ijn": weekdays, "count_summary": weekdays, "completness": {"Sat": "x"}},
    )
    assert list(written) == ["daily_headline", "completness"]
    assert not (tmp_path / "db_errs").exists()


def test_a_function_is_run_only_when_due(spark, tmp_path):
    ran = []

    def source(s):
        ran.append(1)
        return s.range(3)

    e = Extract("f", source, f"{tmp_path}/f", saving_func="save_parquet", copy_path=f"{tmp_path}/copy", days={"Mon": "x"})
    assert extracts.run_due(spark, [e], MONDAY + dt.timedelta(days=1)) == [] and not ran
    extracts.run_due(spark, [e], MONDAY)
    assert len(ran) == 1 and spark.read.parquet(f"{tmp_path}/copy").count() == 3


def test_copies_are_made_from_the_first_files(spark, tmp_path):
    """The result is computed once, whatever the writer, and nothing stays in storage."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(10).coalesce(1).mapInPandas(count, "id long")

    def own(d, path):
        d.write.json(path)

    for k, save in enumerate((sinks.save_csv, sinks.save_parquet, own)):
        before = seen.value
        extracts.write_twice(df, save, f"{tmp_path}/{k}", f"{tmp_path}/{k}copy")
        assert seen.value - before == 10
        assert not df.is_cached
    assert spark.read.json(f"{tmp_path}/2copy").count() == 10
    assert sorted(values(spark.read.option("header", True).csv(f"{tmp_path}/0copy"), "id")) == sorted(map(str, range(10)))


def test_csv_extracts_and_copies_are_small(spark, tmp_path):
    """Parts are compressed unless the configuration asks for plain ones; every cell is the same either way."""
    odd = F.when(F.col("id") % 100 == 0, F.lit(' a "quoted", text\nnext line ')).when(F.col("id") % 3 > 0, F.lit("unknown"))
    cases = spark.range(3000).repartition(2).select("id", odd.alias("odd"), *[F.lit("Not stated").alias(f"c{i}") for i in range(9)])
    config = [
        Extract(n, lambda _: cases, f"{tmp_path}/{n}", saving_func=save, copy_path=f"{tmp_path}/{n}_copy")
        for n, save in (("usual", None), ("named", "save_azure"), ("plain", "save_csv_plain"))
    ]
    extracts.run_due(spark, config, MONDAY)
    size = {p.name: sum(f.stat().st_size for f in p.glob("part-*")) for p in tmp_path.iterdir()}
    assert set(size) == {f"{e.nm}{end}" for e in config for end in ("", "_copy")}
    for name in size:
        assert sorted(values(tables.read_csv(spark, f"{tmp_path}/{name}", cases.schema))) == sorted(values(cases))
        kind = "*.csv" if name.startswith("plain") else "*.csv.gz"
        assert size[name] == sum(f.stat().st_size for f in (tmp_path / name).glob(f"part-{kind}"))
        assert name.startswith("plain") or size[name] * 4 < size["plain"]


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for d in folders for f in Path(d.getPath()).rglob("shuffle_*")}


def test_shuffles_of_a_batch_go_with_each_write(spark, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, old = shuffle_files(spark), spark.conf.get(setting)
    dealt = spark.range(20_000).repartition(4, "id").withColumn("v", F.col("id") % 7)

    def own(d, path):
        assert spark.conf.get(setting) == "true"
        d.write.json(path)

    reports.keep_columns(dealt, ["id"], f"{tmp_path}/kept")
    extracts.write_twice(dealt, sinks.save_csv, f"{tmp_path}/a", None)
    extracts.write_twice(dealt, sinks.save_parquet, f"{tmp_path}/b", f"{tmp_path}/b_copy")
    extracts.write_twice(dealt, own, f"{tmp_path}/c", None)
    # files are removed after the write has returned
    for _ in range(100):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(setting) == old
    for path in ("kept", "b", "b_copy"):
        assert spark.read.parquet(f"{tmp_path}/{path}").distinct().count() == 20_000
    assert spark.read.json(f"{tmp_path}/c").distinct().count() == 20_000

    def broken(d, path):
        raise ValueError("no place")

    with pytest.raises(ValueError, match="no place"):
        extracts.write_twice(dealt, broken, f"{tmp_path}/d", None)
    assert spark.conf.get(setting) == old


def test_equal_sql_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    spark.range(10).coalesce(1).mapInPandas(count, "id long").createOrReplaceTempView("t_counted")
    config = [Extract(n, "select * from t_counted", f"{tmp_path}/{n}") for n in ("a", "b", "c")]
    extracts.run_due(spark, config, MONDAY)
    assert seen.value == 10
    extracts.run_due(spark, config, MONDAY, share=False)
    assert seen.value == 40


def test_rules_on_a_stream(spark, tmp_path):
    cases = fx.cases(spark, SF)
    cases.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(cases.schema).parquet(f"{tmp_path}/in")
    q = stream_errors(stream, f"{tmp_path}/out", f"{tmp_path}/state", asof=fx.ASOF, min_date=fx.MIN_DATE)
    q.awaitTermination(120)
    from caseloom.operators.quality import error_report

    batch = error_report(cases, asof=fx.ASOF, min_date=fx.MIN_DATE, ordered=False)
    assert spark.read.parquet(f"{tmp_path}/out").count() == batch.count()


def test_named_reports(spark, tmp_path):
    hub = spark.range(3).select(F.lit("x").alias("pt"), F.col("id").alias("n"))
    reports.publish_views(hub, {"all_cases_web": ["n"]})
    config = extracts.report_extracts(str(tmp_path), {"StatsCan": {"Tue": "x"}})
    done = {e.nm: e for e in extracts.run_due(spark, config, MONDAY)}
    assert "stats_can" not in done and len(done) == 6
    assert spark.read.option("header", True).csv(done["hc_daily"].path).columns == ["n"]
    assert spark.read.option("header", True).csv(done["data_hub"].path).columns == ["pt", "n"]
    assert spark.read.option("header", True).csv(done["qry_allcases_web"].path).columns == ["n"]


def stored(spark, tmp_path):
    fx.cases(spark, SF).select("phacid", "pt", "age").write.mode("overwrite").parquet(f"{tmp_path}/in")
    spark.read.parquet(f"{tmp_path}/in").createOrReplaceTempView("store_in")
    return ResultStore(spark, f"{tmp_path}/kept")


def test_columns_of_several_reports_are_computed_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def slow(x):
        made.add(1)
        return None if x is None else f"{x}!"

    rows = [("1", "a", None), ("2", None, 3), ("2", None, 3)]
    df = spark.createDataFrame(rows, "phacid string, pt string, `odd.name` int").withColumn("derived", slow("pt"))
    kept = reports.keep_columns(df, ["phacid", "derived", "PHACID", "odd.name", "derived"], f"{tmp_path}/kept")
    assert kept.columns == ["PHACID", "derived", "odd.name"]
    reports.publish_views(kept, {"who": ["phacid", "derived"], "statscan": ["derived"]})
    config = [e for e in extracts.report_extracts(str(tmp_path)) if e.nm in ("who", "stats_can")]
    assert len(extracts.run_due(spark, config, MONDAY)) == 2
    assert made.value == 3
    assert sorted(kept.collect()) == sorted([("1", "a!", None), ("2", None, 3), ("2", None, 3)], key=lambda r: r[0])
    assert values(tables.read_csv(spark, f"{tmp_path}/who", "phacid string, derived string").orderBy("phacid")) == [
        ("1", "a!"), ("2", None), ("2", None),
    ]


@pytest.mark.parametrize("share", [True, False])
def test_a_batch_need_not_keep_shared_sql(spark, tmp_path, monkeypatch, share):
    spark.range(3).createOrReplaceTempView("t_twice")
    config = [Extract(n, "select id from t_twice", f"{tmp_path}/{n}", saving_func="save_parquet") for n in ("a", "b")]
    kept, get = [], tables.SqlExtracts.get

    def noting(self, sql, **kw):
        df = get(self, sql, **kw)
        kept.append(df.storageLevel.useMemory)
        return df

    monkeypatch.setattr(tables.SqlExtracts, "get", noting)
    extracts.end_of_day(spark, fx.cases(spark, SF), config, str(tmp_path), asof=MONDAY, before=[], after=[], share=share)
    assert kept == [share, share]
    assert [spark.read.parquet(f"{tmp_path}/{n}").count() for n in ("a", "b")] == [3, 3]


def test_results_outlive_a_session(spark, tmp_path):
    store, sql = stored(spark, tmp_path), "SELECT pt, count(*) AS n FROM store_in WHERE age > 40 GROUP BY pt;"
    first = sorted(values(store.get(sql)))
    (key,) = store.files.names(store.folder)
    assert len(store.versions(key)) == 1
    # another session, with views of its own
    other = spark.newSession()
    other.read.parquet(f"{tmp_path}/in").createOrReplaceTempView("store_in")
    again = ResultStore(other, f"{tmp_path}/kept").get("  " + sql.replace(" WHERE", "\n WHERE"))
    assert sorted(values(again)) == first
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and len(store.versions(key)) == 1
    # a refresh is a new version; the old one stays until it is pruned
    assert sorted(values(store.get(sql, refresh=True))) == first and len(store.versions(key)) == 2
    assert store.prune() == 1 and len(store.versions(key)) == 1


def test_changed_inputs_views_and_days_are_misses(spark, tmp_path):
    store, sql = stored(spark, tmp_path), "SELECT count(*) AS n FROM store_in"
    n = values(store.get(sql))[0]
    spark.read.parquet(f"{tmp_path}/in").limit(5).write.parquet(f"{tmp_path}/more")
    spark.read.parquet(f"{tmp_path}/more").write.mode("append").parquet(f"{tmp_path}/in")
    spark.read.parquet(f"{tmp_path}/in").createOrReplaceTempView("store_in")
    assert values(store.get(sql)) == [n + 5]
    spark.read.parquet(f"{tmp_path}/in").where("age > 40").createOrReplaceTempView("store_in")
    assert values(store.get(sql))[0] < n
    spark.read.parquet(f"{tmp_path}/more").createOrReplaceTempView("store_in")
    assert values(store.get(sql)) == [5]
    assert len(store.files.names(store.folder)) == 4
    today = spark.sql("SELECT current_date() AS d, * FROM store_in")
    day = spark.sql("SELECT date_add(current_date(), 1) AS d, * FROM store_in")
    assert store.key(today, "same") != store.key(day, "same")


def test_what_cannot_be_known_again_is_not_stored(spark, tmp_path):
    store = stored(spark, tmp_path)
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("store_local")
    assert values(store.get("SELECT * FROM store_local")) == [1]
    assert store.get("SELECT rand() AS r, * FROM store_in").count() > 0
    assert store.files.names(store.folder) == []
    # both sides of a difference have the same columns: which is which matters
    spark.read.parquet(f"{tmp_path}/in").limit(3).write.parquet(f"{tmp_path}/few")
    spark.read.parquet(f"{tmp_path}/few").createOrReplaceTempView("store_few")
    a, b = ("SELECT * FROM {} EXCEPT SELECT * FROM {}".format(*x) for x in (("store_in", "store_few"), ("store_few", "store_in")))
    assert store.get(a).count() > 0 and store.get(b).count() == 0


def test_a_died_writer_leaves_no_result(spark, tmp_path):
    store, sql = stored(spark, tmp_path), "SELECT pt FROM store_in"
    key = store.key(spark.sql(sql), sql)
    spark.range(1).write.parquet(f"{store.folder}/{key}/.part-dead")
    assert store.versions(key) == []
    assert store.get(sql).columns == ["pt"]
    # version and leftover alike go when nothing is kept
    assert store.prune(0) == 2


class Dies(Exception):
    pass


def batch(spark, tmp_path, fails):
    """Four reports; the third fails while ``fails`` holds something. Returns the batch and what was made."""
    made = []

    def report(name, value):
        def source(s):
            made.append(name)
            if name == "c" and fails:
                fails.pop()
                raise Dies(name)
            return s.createDataFrame([(name, value)], "nm string, v int")

        return Extract(name, source, f"{tmp_path}/{name}", saving_func="save_parquet", copy_path=f"{tmp_path}/{name}_copy")

    def run(value, day=MONDAY):
        manifest = Manifest(spark, f"{tmp_path}/manifest")
        extracts.run_due(spark, [report(n, value) for n in "abcd"], day, manifest=manifest)
        return manifest

    return run, made


def test_a_batch_that_died_goes_on(spark, tmp_path):
    run, made = batch(spark, tmp_path, ["once"])
    with pytest.raises(Dies):
        run(1)
    assert made == ["a", "b", "c"]
    assert Manifest(spark, f"{tmp_path}/manifest").finished() == ["a", "b"]
    assert not (tmp_path / "c").exists()
    assert run(1).finished() == ["a", "b", "c", "d"]
    # what was done is not made again
    assert made == ["a", "b", "c", "c", "d"]
    for n in "abcd":
        assert values(spark.read.parquet(f"{tmp_path}/{n}_copy")) == [(n, 1)]
    run(1)
    assert len(made) == 5
    # another day makes all of them, and readers see the old ones until then
    run(2, MONDAY + dt.timedelta(days=1))
    assert len(made) == 9 and values(spark.read.parquet(f"{tmp_path}/a"), "v") == [2]
    assert not [p.name for p in tmp_path.iterdir() if "__" in p.name]


@pytest.mark.parametrize("at", range(1, 5))
def test_dying_between_the_renames(spark, tmp_path, monkeypatch, at):
    """A report is replaced in two renames for each of its places; the batch may die before any of them."""
    run, made = batch(spark, tmp_path, [])
    run(1)
    moves, move = [], Files.move

    def dies(self, source, target):
        if "__staged_" in source or "__replaced_" in target:
            moves.append(source)
            if len(moves) == at:
                raise Dies(source)
        return move(self, source, target)

    day = MONDAY + dt.timedelta(days=1)
    monkeypatch.setattr(Files, "move", dies)
    with pytest.raises(Dies):
        run(2, day)
    monkeypatch.setattr(Files, "move", move)
    before = made.count("a")
    run(2, day)
    # the files were ready: the report is put in place and not computed again
    assert made.count("a") == before
    for place in ("a", "a_copy", "d"):
        assert values(spark.read.parquet(f"{tmp_path}/{place}"), "v") == [2]
    assert not [p.name for p in tmp_path.iterdir() if "__" in p.name]


def test_half_written_files_are_not_seen(spark, tmp_path):
    """A writer that dies leaves its files aside; the next run removes them."""
    manifest = Manifest(spark, f"{tmp_path}/manifest")

    def write(stage):
        spark.range(3).write.parquet(stage(f"{tmp_path}/r"))
        raise Dies

    with pytest.raises(Dies):
        manifest.publish("r", "x", write)
    assert not (tmp_path / "r").exists()
    assert manifest.publish("r", "x", lambda stage: spark.range(4).write.parquet(stage(f"{tmp_path}/r")))
    assert spark.read.parquet(f"{tmp_path}/r").count() == 4
    assert not manifest.publish("r", "x", write)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["manifest", "r"]


def test_tables_are_replaced_whole(spark, tmp_path):
    for n in (3, 5):
        publish_table(spark.range(n), "caseloom_published")
        assert spark.table("caseloom_published").count() == n
    spark.sql("DROP TABLE caseloom_published")
    assert not [t for t in spark.catalog.listTables() if "staged" in t.name]


def test_refresh_and_store_in_a_batch(spark, tmp_path):
    store = stored(spark, tmp_path)
    config = [Extract(n, "SELECT pt, count(*) AS n FROM store_in GROUP BY pt", f"{tmp_path}/{n}") for n in "ab"]
    for refresh, versions in ((False, 1), (False, 1), (True, 2)):
        extracts.run_due(spark, config, MONDAY, store=store, refresh=refresh)
        (key,) = store.files.names(store.folder)
        assert len(store.versions(key)) == versions


def ranges(df, partitions, column="k"):
    cuts = tables.balanced_predicates(df.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n")), partitions, column)
    met = [F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in cuts]
    times = values(df.select(sum(met[1:], met[0]).alias("times")).distinct())
    sizes = df.agg(*[F.sum(m).alias(f"r{i}") for i, m in enumerate(met)]).first()
    return cuts, times, list(sizes)


@pytest.mark.parametrize("kind", ["long", "double", "decimal(20,4)", "date", "timestamp", "string"])
def test_ranges_of_equal_rows(spark, kind):
    """A skewed key of any type, with rows that have none: every row meets one condition, shares are alike."""
    k = F.when(F.col("id") % 10 > 0, F.floor(F.pow(F.col("id") / 50, 2)))
    day = F.date_add(F.lit("2020-01-01"), k.cast("int"))
    df = spark.range(6000).select((day.cast(kind) if kind in ("date", "timestamp") else k.cast(kind)).alias("k")).repartition(5)
    cuts, times, sizes = ranges(df, 8)
    assert len(cuts) == 8 and times == [1]
    # the first also has the 600 rows without a key
    assert max(sizes[1:]) < 1.3 * 675 and sizes[0] < 1.3 * 675 + 600


def test_ranges_of_hot_few_and_no_keys(spark):
    hot = spark.range(4000).select(F.when(F.col("id") < 3000, F.lit(7)).otherwise(F.col("id")).alias("k"))
    cuts, times, sizes = ranges(hot, 4)
    assert times == [1] and sizes[0] == 3000 and len(cuts) == 2
    quoted = spark.createDataFrame([("it's",), ("b",), (None,), ("z'z",)], "k string")
    assert ranges(quoted, 3)[1] == [1]
    for rows in ([], [(None,)], [(5,)]):
        df = spark.createDataFrame(rows, "k long")
        cuts, times, _ = ranges(df, 3)
        assert cuts == ["1 = 1"] and times in ([], [1])
    with pytest.raises(ValueError, match="range"):
        tables.range_starts(spark.createDataFrame([], "key long, n long"), 0)
    with pytest.raises(ValueError, match="no ranges"):
        tables.balanced_predicates(spark.createDataFrame([(True, 1), (False, 1)], "key boolean, n long"), 2, "k")


def test_old_accents_of_a_table(spark, tmp_path):
    rows = [(1, "Québec Çà".encode("latin-1"), 3), (2, "déjà vu".encode(), 4), (3, None, 5), (4, b"plain", 6)]
    df = spark.createDataFrame(rows, "id int, b binary, n int").select("id", F.col("b").cast("string").alias("v"), "n")
    df.write.parquet(f"{tmp_path}/old.parquet")
    got = dict(values(tables.Tables(spark, str(tmp_path)).flat("old").select("id", "v")))
    assert got == {1: "Québec Çà", 2: "déjà vu", 3: None, 4: "plain"}
