import zlib

import numpy as np
import pytest

from caseloom.llm import toxicity
from caseloom.llm.queries import QUERIES

from .samples import documents, empty


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op3_toxicity"](spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    hit = sum(p and y for p, y in held)
    # some labels of these tables contradict their texts, so not all can be met
    assert hit / sum(y for _, y in held) >= 0.85 and hit / max(1, sum(p for p, _ in held)) >= 0.88


def trained(n=400):
    rng = np.random.default_rng(0)
    plain = [f"w{i}" for i in range(300)]
    texts, toxic, langs = [], [], []
    for i in range(n):
        lang = "en" if i % 2 else "xx"
        w = [x + lang for x in rng.choice(plain, 60)]
        if y := i % 4 < 2:
            w[int(rng.integers(60))] = ["nasty" + lang, "vile" + lang][i % 3 % 2]
        texts.append(" ".join(w).encode())
        toxic.append(int(y))
        langs.append(lang)
    packed = [np.concatenate([np.empty(0, np.int64), *toxicity.features(t)]) for t in texts]
    return toxicity.fit(packed, np.array(toxic), langs), texts, toxic


@pytest.fixture(scope="module")
def model():
    return trained()


def test_learns_single_words_and_their_forms(model):
    m, texts, toxic = model
    assert np.mean([(m.score(t) >= 0.7) == y for t, y in zip(texts, toxic, strict=True)]) > 0.97
    long = " ".join(["w1en"] * 20_000)
    assert m.score(long.encode()) < 0.7 <= m.score((long + " nastyen").encode())
    assert m.score(b"Nastyen!!") >= 0.7


def test_whole_text_in_pieces(model):
    m, texts, _ = model
    text = b" ".join(texts[:40])
    whole = m.logit(toxicity.features(text))[0]
    assert m.logit(toxicity.features(text, 50))[0] == pytest.approx(whole, abs=1e-5)


def test_gradient_and_padding(model):
    """Scoring by tables equals plain convolution over padded words."""
    m, texts, _ = model
    for t in [*texts[:5], b"", b"one", b"one two"]:
        ids = toxicity.buckets(np.concatenate([np.empty(0, np.int64), *toxicity.features(t)]))
        n = max(1, len(ids))
        v = m.vectors(np.concatenate([ids, np.full((toxicity.PAD + 1, ids.shape[1]), toxicity.BUCKETS)]))
        best = np.concatenate([np.max([sum(v[i + j] @ m.filters[w][j] for j in range(w)) for i in range(n)], axis=0) for w in toxicity.WIDTHS])
        z = np.maximum(best + m.shift, 0) @ m.out + m.bias
        assert m.logit(toxicity.features(t))[0] == pytest.approx(float(z), abs=1e-4)


def test_best_cut():
    assert toxicity.best_cut(np.array([0.0, 1, 2, 5, 6]), np.array([0, 0, 0, 1, 1])) == 3.5
    assert toxicity.best_cut(np.array([]), np.array([])) == 0.0


def test_awkward_rows(spark, model):
    docs = documents(spark)
    got = toxicity.score(docs, model[0])
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "n_words", "kept", "size", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    blank = {r["score"] for r in rows if r["n_chars"] in (0, 1, 2)}
    assert len(blank) == 1
    assert toxicity.score(empty(spark), model[0]).count() == 0


def test_labels_with_gaps(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(5, 1), (5, 0), (7, None), (None, 1), (8, 0), (99, 1), (0, 1)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.learn(docs, labels)).count() == docs.count()
    none = toxicity.learn(empty(spark), labels)
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(docs, none).collect())


def test_cuts_come_from_all_labels_and_not_from_the_capped_sample(spark):
    """One word that a tenth of the clean texts have too: at the true rate of toxic texts it must not be enough."""
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for i in range(3000):
        words = [f"w{k}" for k in rng.integers(0, 200, 20)]
        toxic = i % 30 == 0
        if toxic or i % 6 == 1:
            words[3] = "doubtful"
        if toxic and i % 60:
            words[7] = "nasty"
        docs.append((i, " ".join(words), "en"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    # the sample has as many toxic texts as clean ones, the corpus one in thirty
    model = toxicity.learn(docs, labels, per_class=100)
    got = toxicity.score(docs, model).join(labels, "doc_id").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in got)
    assert hit >= 40 and hit / sum(r["predicted"] for r in got) > 0.8


def test_all_labelled_rows_are_counted(spark, model):
    docs, labels = documents(spark), spark.createDataFrame([(i, i % 2) for i in range(16)], "doc_id long, toxic int")
    taught = spark.createDataFrame([("5",), ("8",)], "id string")
    got = toxicity.logit_counts(docs, labels, taught, model[0], 1000).collect()
    # ids 1 to 15, 10 twice; the text of 8 is too long to be trained on
    assert sum(r["n"] for r in got) == 16 and sum(r["n"] for r in got if r["trained"]) == 1


def test_calibration_keeps_the_rate_of_all_rows():
    m = toxicity.Model()
    m.languages = ["en"]
    # 20 toxic rows of 30 were trained on: the other 10 stand for all 30
    z = np.array([0.0, 1.0, 1.0, 2.0, 9.0])
    toxic, trained = np.array([0, 0, 1, 1, 1]), np.array([False, False, False, False, True])
    n = np.array([500.0, 12, 5, 5, 20])
    toxicity.calibrate(m, z, np.zeros(5, int), toxic, trained, n)
    assert m.cuts[0, 0] == 0.5
    toxicity.calibrate(m, z, np.zeros(5, int), toxic, trained, np.array([500.0, 100, 5, 5, 20]))
    assert m.cuts[0, 0] == 1.5
