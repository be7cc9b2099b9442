from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from caseloom.llm import mixing
from caseloom.llm.queries import QUERIES

from .samples import collected, documents, empty


def words(t):
    return len((t or "").encode().split())


def by_hand(sizes, weights=(5, 2, 1), most=3):
    """Targets by raising one level for all sources until the shares add up."""
    order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    low, high, total = 0.0, 1e12, sum(sizes.values())
    for _ in range(300):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(most * sizes[s], w[s] * level) for s in sizes) < total else (low, level)
    return {s: min(most * sizes[s], w[s] * low) for s in sizes}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5}, {"b": 7, None: 100, "a": 1, "z": 0}, {None: 3}, {"a": 0}, {}])
def test_targets(sizes):
    got = mixing.targets(sizes)
    assert {s: pytest.approx(t, abs=1e-6) for s, t in by_hand(sizes).items()} == got


def test_weights_follow_code_points():
    sizes = dict.fromkeys(["b", "B", "é", "a"], 1000)
    assert mixing.targets(sizes) == pytest.approx({"B": 4000 * 5 / 13, "a": 4000 * 2 / 13, "b": 4000 / 13, "é": 4000 * 5 / 13})


def check(rows, sources):
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        size[sources[r["doc_id"]]] += r["size"]
        taken[sources[r["doc_id"]]] += r["taken"]
        target[sources[r["doc_id"]]] = r["target"]
    for s in size:
        assert abs(taken[s] - target[s]) <= 1 or not size[s]
    return size, target


def test_query_meets_targets(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    first = QUERIES["op1_mixing"](spark, folder).collect()
    assert {r["doc_id"]: r["size"] for r in first} == {r["doc_id"]: words(r["text"]) for r in docs}
    size, target = check(first, {r["doc_id"]: r["source"] for r in docs})
    want = by_hand(dict(size))
    assert all(target[s] == pytest.approx(want[s]) for s in want)
    assert sorted(first) == sorted(QUERIES["op1_mixing"](spark, folder).collect())
    # whole rounds come first: within a source, copies differ by one at most
    assert [r["finish"] for r in first] == sorted(r["finish"] for r in first)


def test_awkward_rows(spark):
    docs = documents(spark)
    got = mixing.schedule(docs)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "n_words", "score", "kept", *mixing.OWN]
    assert got.count() == docs.count()
    taken, size = defaultdict(int), defaultdict(int)
    for r in got.collect():
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
    want = by_hand(size)
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_mix_gives_the_copies(spark):
    docs = documents(spark)
    planned = Counter()
    for r in mixing.schedule(docs).collect():
        planned[r["doc_id"]] += r["taken"]
    copies = mixing.mix(docs)
    assert copies.columns == [*docs.columns, "copy", "words", "finish"]
    got = Counter()
    rows = copies.collect()
    for r in rows:
        got[r["doc_id"]] += r["words"]
        assert words(r["text"]) == r["words"]
    assert got == +planned
    assert [r["finish"] for r in rows] == sorted(r["finish"] for r in rows)


def test_empty_and_bounds(spark):
    assert mixing.schedule(empty(spark)).count() == 0
    assert mixing.mix(empty(spark)).count() == 0
    with pytest.raises(ValueError, match="sources"):
        mixing.schedule(documents(spark), max_sources=2)


def test_order_does_not_depend_on_partitions(spark):
    docs = documents(spark)
    assert collected(mixing.schedule(docs)) == collected(mixing.schedule(docs.repartition(7, F.col("n_chars"))))


def test_private_names_do_not_clash(spark):
    """Columns named like anything the operator uses inside come back as they were."""
    names = ["_order", "_other", "_sid", "_size", "_slice", "_slices", "_first", "_rounds", "_within", "_before", "row", "_source", "Copy"]
    docs = documents(spark).select("doc_id", "text", "source", *[F.concat(F.lit(n), F.col("n_chars")).alias(n) for n in names])
    plain = mixing.schedule(docs)
    assert [c for c in plain.columns if c in names] == names
    assert all(r[n] == plain_value(r, n) for r in plain.collect() for n in names)
    copies = mixing.mix(docs)
    kept = [n for n in names if n != "Copy"]
    assert copies.columns == ["doc_id", "text", "source", *kept, "copy", "words", "finish"]
    assert all(r[n] == plain_value(r, n) for r in copies.collect() for n in kept)


def plain_value(r, n):
    """What a column was: its name and the number of the row, which all of them share."""
    return n + r["_order"].removeprefix("_order")
