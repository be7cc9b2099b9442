import hashlib
import random

import numpy as np
import pytest

from caseloom.llm import substrings
from caseloom.llm.common import pack, unpack
from caseloom.llm.queries import ORACLES, QUERIES

from .samples import SCHEMA, documents, empty, prose


def by_hand(rows, width=13):
    """(id, words, removed, digest) of each row, from the smallest id of every window."""
    first = {}
    split = [(float("inf") if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - width + 1):
            x = tuple(w[k : k + width])
            first[x] = min(i, first.get(x, i))
    out = []
    for (i, _), (key, w) in zip(rows, split, strict=True):
        gone = {p for k in range(len(w) - width + 1) if first[tuple(w[k : k + width])] < key for p in range(k, k + width)}
        left = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


def test_awkward_rows(spark):
    docs = documents(spark)
    got = substrings.dedup(docs)
    assert result(got) == by_hand([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "kept", "size", "n_words", "n_removed", "kept_sha256"]
    kept = {r["n_chars"]: r["text"] for r in docs.collect()}
    for r in got.collect():
        if r["n_removed"] == 0:
            assert r["text"] == kept[r["n_chars"]]
        else:
            assert hashlib.sha256(b" ".join(r["text"].encode().split())).hexdigest() == r["kept_sha256"]
    assert substrings.dedup(empty(spark)).count() == 0


@pytest.mark.parametrize("group,bucket", [(300, 400), (4 << 20, 8 << 20)])
def test_planted_passages_over_many_groups(spark, group, bucket):
    """Passages of 10 to 40 words at every offset, overlapping, chained and inside one document."""
    rng = random.Random(4)
    passages = [[f"p{k}w{j}" for j in range(n)] for k, n in enumerate((10, 12, 13, 14, 19, 25, 40))]
    rows = []
    for i in range(70):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += [f"f{rng.randrange(4000)}" for _ in range(rng.randint(0, 11))]
            p = rng.choice(passages)
            a = rng.randint(0, 3)
            w += p[a : len(p) - rng.randint(0, 3)] * rng.choice([1, 1, 1, 2])
        rows.append((i * 7 % 71, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(substrings.dedup(docs, group_bytes=group, bucket_bytes=bucket)) == by_hand(rows)


def test_other_width_and_repeated_words(spark):
    rows = [(1, "a a a a a a a"), (2, "a a a a a"), (3, "a a a b a a a"), (4, "a a"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(substrings.dedup(docs, width=3)) == by_hand(rows, 3)


def test_text_keeps_its_white_space():
    text = b"  one two\tthree\nfour  five "
    gone = np.array([0, 1, 1, 0, 0], bool)
    assert substrings.without(text, gone) == b"  one four  five "
    assert substrings.without(text, np.array([1, 1, 0, 0, 1], bool)) == b"  three\nfour  "


def test_packing_is_exact():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        x = np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        assert (unpack(pack(x)) == x).all()


def test_long_text_in_pieces(spark):
    text = prose(9, 30_000)
    docs = spark.createDataFrame([(1, text, *[None] * 7), (2, text[1000:], *[None] * 7)], SCHEMA)
    assert result(substrings.dedup(docs)) == by_hand([(1, text), (2, text[1000:])])


def test_query_against_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    df = QUERIES["op8_substrings"](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES['op8_substrings']}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in df.orderBy("doc_id").collect()] == want
