import re
from collections import Counter

from caseloom.llm import rules
from caseloom.llm.queries import ORACLES, QUERIES

from .samples import documents, empty


def by_hand(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_lines": len(lines), "n_repeat_words": len(covered),
        "n_stop_words": sum(x.lower() in rules.STOP_WORDS for x in w),
    }


def test_awkward_rows(spark):
    docs = documents(spark)
    want = {r["n_chars"]: by_hand(r["text"]) for r in docs.collect()}
    got = rules.judge(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        m = want[r["n_chars"]]
        assert {k: r[k] for k in m} == m
        assert r["base_failed"] == (m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"])
        assert r["kept"] == (not r["failed"]) and (not r["base_failed"] or not r["kept"])
    assert rules.judge(empty(spark)).count() == 0


def test_one_projection_without_python(spark):
    plan = rules.judge(documents(spark).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Generate" not in plan


def test_own_table_of_rules(spark):
    strict = (("too_few_words", "n_words", 5, None), ("never", "symbol_ratio", None, -1.0))
    got = rules.judge(documents(spark), strict).collect()
    assert all(not r["kept"] and "never" in r["failed"] for r in got)


def test_query_against_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    df = QUERIES["op4_rules"](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    columns = ", ".join(df.columns)
    want = con.execute(f"SELECT {columns} FROM ({ORACLES['op4_rules']}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in df.orderBy("doc_id").collect()] == want
