import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from caseloom.llm import language
from caseloom.llm.queries import QUERIES

from .samples import documents, empty

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return language.vocabulary(PATH)


def segmentations(word, pieces):
    """All ways to cut a word, as piece numbers."""
    if not word:
        return [[]]
    out = []
    for j in range(1, len(word) + 1):
        p = pieces.get(word[:j], 0 if j == 1 else None)
        if p is not None:
            out += [[p, *rest] for rest in segmentations(word[j:], pieces)]
    return out


def test_forward_sums_all_segmentations(pieces):
    words = ["▁thatth", "▁ción", "▁日本x", "a", "▁", "▁the", "𝒳ab"]
    p = np.random.default_rng(1).random((len(pieces) + 1, 2)) / 100
    lattice = language.Lattice(words, language.Pieces(pieces))
    want = [np.log(sum(np.prod(p[s], axis=0) for s in segmentations(w, pieces))) for w in words]
    assert np.allclose(lattice.log_probability(p), want)
    uses = np.zeros(len(p))
    for k, w in enumerate(words):
        cuts = segmentations(w, pieces)
        weight = np.array([np.prod(p[s, 0]) for s in cuts])
        for s, x in zip(cuts, weight / weight.sum(), strict=True):
            np.add.at(uses, s, x * (k + 1))
    assert np.allclose(lattice.expected(p[:, 0], np.arange(1, 8.0)), uses)


def test_learning_raises_the_likelihood(pieces):
    counts = {"x": Counter({"abcab": 5, "cab": 2, "zz": 1})}

    def likelihood(rounds):
        m = language.fit(counts, pieces, rounds, prior=1e-9)
        return m.totals([b" ".join(w.encode() for w in counts["x"].elements())])[0, 0]

    found = [likelihood(r) for r in range(1, 5)]
    assert found == sorted(found) and language.fit(counts, pieces).probability.sum() == pytest.approx(1)


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op10_language"](spark, folder).collect()
    assert len(rows) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_rows(spark, pieces):
    counts = {"en": Counter({"the": 50, "model": 5, "one": 9, "river": 3}), "fr": Counter({"casa": 9, "éte": 9})}
    m = language.fit(counts, pieces)
    docs = documents(spark)
    got = language.identify(docs, m)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words", "kept", "size", "lang_pred", "score"]
    rows = {r["n_chars"]: r for r in got.collect()}
    assert len(rows) == docs.count()
    for k, r in rows.items():
        told = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] != "und") == told and 0 <= r["score"] <= 1, k
    assert rows[3]["lang_pred"] == "en"
    assert language.identify(empty(spark), m).count() == 0
    # the whole text counts: a long tail outvotes the start
    assert m.predict([b"the " * 3 + "casa éte ".encode() * 200_000])[0][0] == "fr"


def test_forgetting_and_long_words_change_nothing(pieces):
    counts = {"en": Counter({"the": 50, "model": 5}), "fr": Counter({"casa": 9, "éte": 9})}
    texts = [f"the model {i} casa {'x' * (i % 90)}".encode() for i in range(300)]
    m = language.fit(counts, pieces)
    want = np.concatenate([m.totals([t]) for t in texts])
    assert np.allclose(m.totals(texts, most=10), want) and np.allclose(language.fit(counts, pieces).totals(texts), want)


def plain_forward(word, pieces, probability):
    """Log probability over all segmentations, with whole numbers for exponents."""
    longest = max(map(len, pieces))
    alpha = [[(1.0, 0)] * probability.shape[1]]
    for e in range(1, len(word) + 1):
        row = []
        for k in range(probability.shape[1]):
            terms = []
            for size in range(1, min(longest, e) + 1):
                p = pieces.get(word[e - size : e], 0 if size == 1 else None)
                if p is not None:
                    m, x = alpha[e - size][k]
                    terms.append((m * probability[p, k], x))
            top = max(x for _, x in terms)
            m, shift = np.frexp(sum(m * 2.0 ** (x - top) for m, x in terms))
            row.append((float(m), top + int(shift)))
        alpha.append(row)
    return [np.log(m) + x * np.log(2) for m, x in alpha[-1]]


def test_long_words_are_summed_over_all_segmentations(pieces):
    """Words of any length, without a cut: texts that know no spaces, and blocks of a very long one."""
    p = np.random.default_rng(4).random((len(pieces) + 1, 3)) / 1000
    words = ["▁" + "donaudampfschifffahrtsgesellschaft" * k for k in (1, 3, 40)] + ["▁" + "日本語のテキスト" * 30, "▁the", "▁" + "x" * 25]
    found = language.Pieces(pieces)
    want = [plain_forward(w, pieces, p) for w in words]
    assert np.allclose(language.log_probability(words, found, p), want)
    for block in (7, 100, 10**6):
        assert np.allclose([language.long_log_probability(w, found, p, block) for w in words], want)
    m = language.fit({"en": Counter({"the": 50, "model": 5}), "fr": Counter({"casa": 9})}, pieces)
    assert np.allclose(m.totals([words[1][1:].encode()])[0], plain_forward(words[1], pieces, m.probability))


def test_expected_uses_of_long_words(pieces):
    """The rescaled passes give the uses of the plain ones, for the same words."""
    p = np.random.default_rng(2).random(len(pieces) + 1) / 100
    lattice = language.Lattice(["▁thatthing", "▁ción"], language.Pieces(pieces))
    want = lattice.expected(p, np.array([2.0, 3.0]))
    lattice.most, short = lattice.most, language.SHORT
    try:
        language.SHORT = 1
        assert np.allclose(lattice.expected(p, np.array([2.0, 3.0])), want)
    finally:
        language.SHORT = short
    long = language.Lattice(["▁" + "abcdefghij" * 60], language.Pieces(pieces))
    uses = long.expected(p, np.ones(1))
    sizes = np.ones(len(p))
    sizes[list(pieces.values())] = [len(x) for x in pieces]
    assert (uses * sizes).sum() == pytest.approx(601)


def test_nothing_to_learn_from(spark):
    docs = documents(spark)
    none = language.learn(docs.withColumn("lang", docs["lang"].substr(100, 1)).where("lang = 'q'"), PATH)
    assert {r["lang_pred"] for r in language.identify(docs, none).collect()} == {"und"}
    some = language.learn(docs, PATH)
    assert some.languages == ["en", "fr"]
    with pytest.raises(ValueError, match="languages"):
        language.learn(docs, PATH, max_languages=1)


def test_copies_take_one_place_of_the_sample(spark, monkeypatch):
    texts = ["alpha beta"] * 500 + [f"word{i} other{i}" for i in range(40)]
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").repartition(4)
    seen = {}
    monkeypatch.setattr(language, "vocabulary", lambda path: {})
    monkeypatch.setattr(language, "fit", lambda counts, pieces: seen.update(counts))
    language.learn(docs, "", per_language=100)
    assert len(seen["en"]) == 82 and set(seen["en"].values()) == {1}
