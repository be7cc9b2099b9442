import random
import re
from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from caseloom.llm import mixing

from . import test_decontaminate, test_mixing, test_simhash
from .samples import documents, prose
from .test_substrings import by_hand as repeats_by_hand


def stage(name):
    return dict(pipeline.STAGES)[name]


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_language_keeps_texts_with_letters(spark):
    docs = documents(spark)
    got = stage("language")(spark, docs, "")
    assert got.columns == pipeline.COLUMNS
    want = sorted(r["n_chars"] for r in docs.collect() if r["text"] and re.search(r"[^\W\d_]", r["text"]))
    assert sorted(r["n_chars"] for r in got.collect()) == want


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    all_rows = [(r["doc_id"], test_simhash.by_hand(r["text"])) for r in docs.collect()]
    want = sorted({c for _, _, c in test_simhash.component_ids(all_rows) if c is not None})
    got = stage("near_duplicates")(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in got) == want


def table_of(spark, data):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")


def test_rows_without_or_with_repeated_ids_are_judged_by_row(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    data = [(None, a), (None, b), (None, b), (7, c), (7, d), (3, d), (8, c), (9, "one two"), (9, "ONE two"), (None, "one two")]
    got = stage("near_duplicates")(spark, table_of(spark, data).repartition(4), "").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([(None, a), (None, b), (7, c), (3, d), (9, "ONE two")], key=str)


def test_clean_rows_of_a_shared_id_stay(spark, tmp_path):
    item = prose(2, 40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    data = [(None, item), (None, "clean here"), (5, "x " + item), (5, "clean too"), (6, "and this")]
    got = stage("decontamination")(spark, table_of(spark, data), str(tmp_path)).collect()
    assert sorted(r["text"] for r in got) == ["and this", "clean here", "clean too"]


def test_repeats_are_cut(spark):
    passage = prose(2, 60)
    data = [(1, passage), (2, "before it " * 3 + passage + " after"), (3, passage), (4, "nothing here"), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    got = rows(stage("repeats")(spark, docs, ""))
    removed = {int(i): (n, r) for i, n, r, _ in repeats_by_hand(data)}
    assert set(got) == {i for i, (n, r) in removed.items() if r == 0 or r < n} == {1, 2, 4, 5}
    for i, r in got.items():
        assert len(r["text"].encode().split()) == removed[i][0] - removed[i][1] and r["n_chars"] == len(r["text"])


def test_benchmark_passages_go(spark, tmp_path):
    docs = documents(spark)
    items = [(1, prose(2, 40)), (2, "one two")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = stage("decontamination")(spark, docs, str(tmp_path))
    # row by row: a clean row stays, whoever else has its id or has none
    before = [(r["doc_id"], r["text"]) for r in docs.collect()]
    clean = [(i, t) for i, t in before if not test_decontaminate.by_hand([(i, t)], items)[0][-1]]
    assert 0 < len(clean) < len(before)
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(clean)


def test_mix_meets_its_targets(spark):
    docs = documents(spark).drop("n_words", "score", "kept", "size")
    got = stage("mixing")(spark, docs, "").collect()
    size, taken = defaultdict(int), defaultdict(int)
    for r in docs.collect():
        size[r["source"]] += test_mixing.words(r["text"])
    for r in got:
        taken[r["source"]] += r["words"]
    assert all(abs(taken[s] - t) <= 1 for s, t in mixing.targets(size).items())


def test_run_equals_the_stages_by_hand(spark, tmp_path):
    """Copies, near copies, shared and benchmark passages and texts without letters through all stages, one after another."""
    rng = random.Random(12)
    passage, item = prose(21, 60), " ".join(f"bench{i} question{i}" for i in range(12))
    data = []
    for i in range(60):
        text = " ".join(rng.choice(["tree", "river", "stone", "casa", "Ärger", "model"]) + str(rng.randrange(50)) for _ in range(80))
        if i % 6 == 1:
            text = data[-1][1]
        elif i % 10 == 4:
            text = text[:200] + " " + passage + " " + text[200:]
        elif i % 15 == 5:
            text += " " + item + " end"
        elif i % 20 == 8:
            text = "12 34 !! 56"
        data.append((i * 3, text, "en" if i % 2 else "fr", f"src{i % 3}"))
    rows = [(i, t, lang, src, len(t)) for i, t, lang, src in data]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, item)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = pipeline.run(spark, str(tmp_path)).collect()

    source = {i: s for i, _, _, s in data}
    left = [(i, t) for i, t, *_ in data if re.search(r"[^\W\d_]", t)]
    groups = test_simhash.component_ids([(i, test_simhash.by_hand(t)) for i, t in left])
    first = {c for _, _, c in groups}
    left = [(i, t) for i, t in left if i in first]
    assert len(left) < 52
    gone = cut_by_hand(left)
    left = [(i, " ".join(w for p, w in enumerate(t.split()) if p not in gone[i])) for i, t in left]
    assert any(gone.values())
    left = [(i, t) for i, t in left if t and not test_decontaminate.by_hand([(i, t)], items)[0][-1]]
    want, size, taken = dict(left), Counter(), Counter()
    for i, t in left:
        size[source[i]] += len(t.split())
    for r in got:
        taken[r["source"]] += r["words"]
        # a copy that the end of the mix falls into holds its first words only
        assert r["text"].split() == want[r["doc_id"]].split()[: r["words"]]
    target = test_mixing.by_hand(dict(size))
    assert all(abs(taken[s] - target[s]) <= 1 for s in size)
    assert {r["doc_id"] for r in got if target[r["source"]] > size[r["source"]] + 1} == {i for i in want if target[source[i]] > size[source[i]] + 1}


def cut_by_hand(rows, width=13):
    """Places of the words that a window covers which a document with a smaller id has too."""
    first, gone = {}, {}
    for i, t in sorted(rows):
        w = t.split()
        windows = [tuple(w[k : k + width]) for k in range(len(w) - width + 1)]
        gone[i] = {p for k, x in enumerate(windows) if first.get(x, i) < i for p in range(k, k + width)}
        for x in windows:
            first.setdefault(x, i)
    return gone


def test_run(spark):
    got = pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == [*pipeline.COLUMNS, "copy", "words", "finish"]
    assert got.count() > 0
