import random
import re

import pytest

from caseloom.llm import decontaminate
from caseloom.llm.queries import ORACLES, QUERIES

from .samples import documents, empty, prose


def words(t):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def by_hand(docs, items, width=10):
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, text in items:
            b = words(text)
            n = min(width, len(b))
            for k in range(len(b) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == b[k : k + n]:
                        hit |= set(range(p, p + n))
                        ids |= {str(item)} - {"None"}
        out.append((str(i), len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out)


def result(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in df.collect())


def test_awkward_rows(spark):
    docs = documents(spark)
    items = [(1, prose(2, 40)), (2, None), (3, ""), (4, "one two"), (None, prose(3, 30)), (5, "one two"), (6, "ONE"), (6, "a b c a b c a b c a"), (7, prose(77, 30))]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "1 AS doc_id", "2 AS n_words")
    got = decontaminate.contamination(docs, bench)
    assert got.columns == ["doc_id", "n_words", "n_hit", "items", "contaminated"]
    assert result(got) == by_hand([(r["doc_id"], r["text"]) for r in docs.collect()], items)


@pytest.mark.parametrize("probes", [1, 2, 4])
def test_planted_windows(spark, probes):
    """Frequent and rare words, partial windows, overlapping items, items at the ends of texts."""
    rng = random.Random(probes)
    vocabulary = ["the", "of", "a"] * 6 + [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(90, "the the the the the the the the the the the the"), (91, items[3][1])]
    docs = []
    for i in range(60):
        w = rng.choices(vocabulary, k=rng.randint(0, 15))
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(items)[1].split()
            a = rng.randint(0, 2)
            w += p[a : len(p) - rng.randint(0, 2)] + rng.choices(vocabulary, k=rng.randint(0, 5))
        docs.append((i, ", ".join(w).title()))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert result(decontaminate.contamination(d, b, probes=probes)) == by_hand(docs, items)


def test_terms_that_are_not_broadcast(spark, monkeypatch):
    docs = documents(spark)
    bench = spark.createDataFrame([(1, prose(2, 40))], "item_id long, text string")
    want = result(decontaminate.contamination(docs, bench))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    assert result(decontaminate.contamination(docs, bench)) == want


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, item), (2, item.replace("epsilon", "epsilon extra")), (3, "alpha then many many many many more words and kappa"), (4, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(5, item)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.near_matches(d, b, probes=10, slack=1).collect()}
    assert got == {(1, "5"), (2, "5")}
    assert [r["doc_id"] for r in decontaminate.near_matches(d, b, probes=10, slack=0).collect()] == [1]


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, prose(2, 40))], "item_id long, text string")
    assert decontaminate.contamination(empty(spark), bench).count() == 0
    got = decontaminate.contamination(documents(spark), bench.limit(0)).collect()
    assert len(got) == documents(spark).count() and not any(r["contaminated"] for r in got)


def test_main_path_is_native(spark):
    bench = spark.createDataFrame([(1, prose(2, 40))], "item_id long, text string")
    plan = decontaminate.contamination(documents(spark).coalesce(1), bench)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_against_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    df = QUERIES["op7_decontaminate"](spark, folder)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES['op7_decontaminate']}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in df.orderBy("doc_id").collect()] == want


def test_one_word_items_in_a_long_text(spark):
    """A shift for each of many occurrences: the item's words are held once for the document."""
    rows = [(1, "Omega " * 3000 + "alpha"), (2, "beta " * 500), (3, "alpha beta omega")]
    items = [(1, "omega"), (2, "alpha"), (3, " ".join(["beta"] * 12))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: (3001, 3001, ["1", "2"]), 2: (500, 500, ["3"]), 3: (3, 2, ["1", "2"])}
