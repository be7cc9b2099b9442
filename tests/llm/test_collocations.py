import random
import re
from collections import Counter

import numpy as np
import pytest

from caseloom.llm import collocations
from caseloom.llm.queries import ORACLES, QUERIES

from .samples import documents, empty, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, threshold, longest=5, most=2000):
    """Rows are (text, lang); the strongest phrases of every language."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    frequent = {(lang, p): a for (lang, p), a in f.items() if len(p) > 1 and a >= threshold}
    inside = set()
    for (lang, p), a in frequent.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p) and a >= f[lang, p[i:j]]:
                    inside.add((lang, p[i:j]))
    out = []
    for lang in n:
        rows = []
        for (x, p), a in frequent.items():
            if x == lang and (x, p) not in inside:
                cuts = [(1000 * a * n[lang] // (f[x, p[:k]] * f[x, p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((score, a, " ".join(p), f[x, p[:k]], f[x, p[k:]]))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, left, right, n[lang], s) for i, (s, a, p, left, right) in enumerate(rows[:most])]
    return sorted(out)


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "words"]
    return sorted(tuple(r)[:8] for r in df.collect())


@pytest.mark.parametrize("threshold", [2, 5, 40])
def test_awkward_rows(spark, threshold):
    docs = documents(spark)
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    want = by_hand(rows, threshold)
    assert want and result(collocations.collocations(docs, threshold)) == want


@pytest.mark.parametrize("part,held,fan", [(8 << 20, 1 << 21, 2048), (500, 60, 2048), (500, 60, 4)])
def test_many_summaries_in_one_or_two_steps(spark, part, held, fan):
    """Skewed words over many ranges: lists are cut off often, and ranges are reached in two steps."""
    rng = random.Random(8)
    words = [f"v{int(rng.paretovariate(0.6)) % 400}" for _ in range(9000)]
    texts = [" ".join(words[i : i + 45]) + rng.choice([". ", ", and so on", "\thot phrase here"]) for i in range(0, 9000, 45)]
    rows = [(i, t * rng.choice([1, 1, 3]), [None, "en", "und", "xx"][i % 4]) for i, t in enumerate(texts)]
    rows += [(900 + i, "the same copy of one text", "en") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = result(collocations.collocations(docs, 6, part_bytes=part, held=held, fan=fan))
    assert got == by_hand([(t, lang) for _, t, lang in rows], 6)


def test_a_frequent_phrase_survives_any_merges():
    """Summaries of bounded size keep what reaches the threshold, whatever comes in between."""
    rng = np.random.default_rng(1)
    keys = rng.permutation(np.concatenate([np.repeat(np.arange(5, dtype=np.uint64), 100), rng.integers(10, 1 << 40, 4000).astype(np.uint64)]))
    capacity = len(keys) // 100 + 1
    summary = np.empty(0, np.uint64), np.empty(0, np.int64), 0
    for part in np.array_split(keys, 37):
        k, c = np.unique(part, return_counts=True)
        summary = collocations.merge(summary, k, c, capacity)
        assert len(summary[0]) <= capacity
    k, c, taken = summary
    assert taken < 100 and set(range(5)) <= set(k[c + taken >= 100].tolist())


def test_long_text_in_slices(spark):
    """Phrases across the cuts of a long text count once."""
    text = prose(3, 3000).encode()
    batch = [collocations.pa.RecordBatch.from_pydict({"text": [text.decode(), None], "lang": ["en", "en"]})]
    totals = []
    for size in (40, 999, 1 << 21):
        count = Counter()
        for w, _ in collocations.chunks(batch, 5, size):
            cache = {}
            for n in range(1, 6):
                count.update((n, w.text(i, n)) for i in np.flatnonzero(collocations.alive(w, n, {}, cache)))
        totals.append(count)
    assert totals[0] == totals[1] == totals[2]


def test_scores_beyond_64_bits(spark):
    """Products of counts are exact."""
    a, n = 3_000_000_019, 9_000_000_000_000_000
    got = spark.sql(f"SELECT (cast({a}L as decimal(38,0)) * {n}L * 1000) div (cast({a}L as decimal(38,0)) * {a + 7}L) AS x").first()["x"]
    assert got == 1000 * a * n // (a * (a + 7)) and 1000 * a * n > 1 << 64


def test_empty_table_and_few_phrases(spark):
    assert result(collocations.collocations(empty(spark))) == []
    assert result(collocations.collocations(documents(spark), 10**6)) == []
    short = result(collocations.collocations(documents(spark), 5, most=3))
    assert short == by_hand([(r["text"], r["lang"]) for r in documents(spark).collect()], 5, most=3)


def test_query_equals_sql(spark, con):
    got = QUERIES["op11_collocations"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(ORACLES["op11_collocations"]).fetchall())
