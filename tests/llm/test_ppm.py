import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import ppm
from caseloom.llm.queries import QUERIES

from .samples import documents, empty


class Trie:
    """Plain prediction by partial matching: counts of all contexts, escapes and exclusion, a byte at a time."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for t in texts:
            x = b"\xff" * order + t + b"\xff"
            for i in range(order, len(x)):
                for j in range(order + 1):
                    self.seen[x[i - j : i]][x[i]] += 1

    def probability(self, context, symbol):
        p, out = 1.0, set()
        for j in range(self.order, -1, -1):
            live = {s: n for s, n in self.seen.get(context[len(context) - j :], {}).items() if s not in out}
            if not live:
                continue
            total = sum(live.values())
            if symbol in live:
                return p * (live[symbol] - 0.5) / total
            p *= len(live) / 2 / total
            out |= set(live)
        return p / (256 - len(out))

    def score(self, text):
        x = b"\xff" * self.order + text + b"\xff"
        return sum(math.log10(self.probability(x[i - self.order : i], x[i])) for i in range(self.order, len(x)))


def by_hand(rows, order):
    """Rows are (text, learnt from)."""
    low = [((t or "").encode().lower(), y) for t, y in rows]
    words = Counter(w for t, y in low if y for w in [*t.split(), None])
    n, v = sum(words.values()), len(words)
    trie = Trie([t for t, y in low if y], order)
    out = []
    for t, _ in low:
        w = [*t.split(), None]
        base = sum(math.log10((words[x] + 1) / (n + 1 * (v + 1))) for x in w)
        out.append((len(w), sum(words[x] > 0 for x in w), n, base, trie.score(t)))
    return out


@pytest.mark.parametrize("order", [2, 3, 4, 6])
def test_awkward_rows(spark, order):
    docs = documents(spark)
    rows = {r["n_chars"]: r["text"] for r in docs.collect() if r["n_chars"] != 8}
    few = docs.where("n_chars <> 8")
    got = ppm.score(few, F.col("n_chars") % 3 != 0, order, group_bytes=2000, bucket_bytes=1500)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "n_words", "kept", "size", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    keys = sorted(rows)
    want = dict(zip(keys, by_hand([(rows[k], k % 3 != 0) for k in keys], order), strict=True))
    found = {r["n_chars"]: (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got.collect()}
    assert set(found) == set(want)
    for k in keys:
        assert found[k][:3] == want[k][:3]
        assert found[k][3:] == pytest.approx(want[k][3:], rel=1e-5)


def test_probabilities_sum_to_one():
    """After any context, seen or not, all 256 symbols share exactly one."""
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 101, 200, dtype=np.uint8)) for _ in range(5)]
    pairs = ppm.pair_counts(texts)
    seen = ppm.merged([ppm.counted(ppm.grams(d, n, 3)) for d, _, n in ppm.pieces(texts, 3)])
    for context in (b"aab", b"zab", b"zzb", b"\xff\xffa", b"zzz"):
        asked = np.array([(context[2] << 24) | (context[1] << 16) | (context[0] << 8) | s for s in range(256)], np.uint64)
        keys, counts = ppm.merged([(seen[0], seen[1]), (asked, np.zeros(256))])
        p = ppm.log_probabilities(keys, counts, pairs, 3)
        assert (10 ** p[np.searchsorted(keys, asked)]).sum() == pytest.approx(1)


@pytest.mark.parametrize("order", [3, 4, 6])
def test_contexts_are_solved_apart_by_three_bytes(order):
    """Sequences of one pair of bytes go to several buckets, and the buckets' results are those of the whole."""
    texts = [b"the tree there", b"see the sea", b"he hears the bees", "öde äther".encode()] * 3
    found = [ppm.counted(ppm.grams(d, n, order)) for d, _, n in ppm.pieces(texts, order)]
    keys, counts = ppm.merged(found)
    pairs, triples = ppm.pair_counts(texts), ppm.triple_counts(texts)
    assert (ppm.pairs_of(triples) == pairs).all()
    whole = ppm.log_probabilities(keys, counts, pairs, order)
    bucket = ppm.gram_bucket(keys, order, 16)
    pair = keys >> np.uint64(8 * (order - 1))
    assert any(len(set(bucket[pair == p])) > 1 for p in set(pair))
    for b in set(bucket):
        own = bucket == b
        assert np.allclose(ppm.log_probabilities(keys[own], counts[own], pairs, order, triples), whole[own])


def test_long_texts_in_pieces():
    text = b"abcabcabd" * 50
    for size in (7, 64, 1 << 21):
        found = [ppm.counted(ppm.grams(d, n, 4)) for d, _, n in ppm.pieces([text, b"", b"x"], 4, size)]
        keys, counts = ppm.merged(found)
        assert counts.sum() == len(text) + 1 + 1 + 2
        if size == 7:
            first = dict(zip(keys.tolist(), counts.tolist(), strict=True))
        assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == first


def test_nothing_to_learn_from(spark):
    docs = documents(spark)
    got = ppm.score(docs, F.lit(None).cast("boolean")).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in got)
    for r in got:
        assert r["base_score"] == pytest.approx(0) and math.isfinite(r["score"])
    assert ppm.score(empty(spark), F.lit(True)).count() == 0
    with pytest.raises(ValueError, match="order"):
        ppm.score(docs, F.lit(True), 1)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    learnt = {i: zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in docs}
    short = [k for k, (_, t) in enumerate(docs) if len(t or "") < 1500][:40]
    texts = [((t or "").encode().lower(), learnt[i]) for i, t in docs]
    trie = Trie([t for t, y in texts if y], 4)
    got = {r["doc_id"]: r for r in QUERIES["op9_ppm"](spark, folder).collect()}
    words = Counter(w for t, y in texts if y for w in [*t.split(), None])
    n, v = sum(words.values()), len(words)
    for (i, _), (t, y) in zip(docs, texts, strict=True):
        w = [*t.split(), None]
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (not y, len(w), sum(words[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((words[x] + 1) / (n + 1 * (v + 1))) for x in w))
    for k in short:
        assert got[docs[k][0]]["score"] == pytest.approx(trie.score(texts[k][0]), rel=1e-5)
