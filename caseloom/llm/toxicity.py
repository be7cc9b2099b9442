"""Toxicity: a convolutional classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of the hashed vectors of the word and of its first bytes, so inflected forms share what they
know. Filters of several widths run over the words; each keeps its highest value in the text, wherever it is, and a
logistic layer weighs these. Scores are calibrated for each language, as told from the text alone, so that one
threshold serves all; the cuts come from counts over all labelled rows, at their own rate of toxic ones.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.plans.sizing import hinted, is_small, materialise

from .common import others, prepare, rows, word_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 17
BUCKETS = 1 << BITS
PREFIXES = (4, 5)
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
PAD = max(WIDTHS) - 1
#: Where languages are calibrated to: predicted toxic from here on.
THRESHOLD = 0.7
#: Logits are counted in steps of this width, up to so many either way.
STEP, STEPS = 0.01, 4000
#: Most bytes of labels that are sent to every executor.
BROADCAST_BYTES = 32 << 20
#: A-Z in lower case; ASCII signs and white space part words.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


class Features(dict):
    """The buckets of a word and its prefixes, in one number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        n = xxhash.xxh64_intdigest(word) % BUCKETS
        for k, size in enumerate(PREFIXES, 1):
            n |= (xxhash.xxh64_intdigest(word[:size], size) % BUCKETS) << (BITS * k)
        self[word] = n
        return n


_FEATURES = Features()


def features(text: bytes | None, piece: int = 1 << 17) -> Iterator[np.ndarray]:
    """Bucket numbers of a text's words, a bounded number at a time."""
    for words in word_chunks((text or b"").translate(LETTERS), piece):
        yield np.fromiter(map(_FEATURES.__getitem__, words), np.int64, len(words))


def buckets(packed: np.ndarray) -> np.ndarray:
    return np.stack([(packed >> (BITS * k)) & (BUCKETS - 1) for k in range(len(PREFIXES) + 1)], axis=1)


def settled(z):
    """A logit as it is up to 4, beyond that only its logarithm counts: how certain a certain case is follows its length
    and the training, and must not push the cut away from the doubtful ones."""
    size = np.abs(z)
    return np.sign(z) * (np.minimum(size, 4.0) + np.log1p(np.maximum(size - 4.0, 0.0)))


class Model:
    """Weights and calibration; what a task needs to score."""

    def __init__(self) -> None:
        # a last row of zeros pads the ends of texts
        self.words = np.zeros((BUCKETS + 1, DIM), np.float32)
        self.filters = {w: np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS}
        self.shift = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.bias = np.float32(-2)
        self.languages: list[str] = []
        self.told = np.zeros((BUCKETS, 0), np.float32)
        #: For each language, then for all: settled logit at the threshold, and slope.
        self.cuts = np.array([[0.0, 1.0]])
        self.table: np.ndarray | None = None

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        return self.words[ids].sum(axis=1)

    def pooled(self, parts: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Highest value of each filter over a whole text, and the log weight of each language."""
        if self.table is None:
            # what a bucket adds to every place of every filter, side by side: one look-up for each bucket of a word
            self.table = np.concatenate([self.words @ self.filters[w][j] for w in WIDTHS for j in range(w)], axis=1)
        best = np.full(len(WIDTHS) * FILTERS, -np.inf, np.float32)
        told = np.zeros(len(self.languages))
        end = np.full((PAD, len(PREFIXES) + 1), BUCKETS)
        carry = np.empty((0, len(PREFIXES) + 1), int)
        some = False
        for packed in parts:
            ids = np.concatenate([carry, buckets(packed)])
            told += self.told[ids[len(carry) :, 0]].sum(axis=0, dtype=float)
            some = some or len(packed) > 0
            self.raise_to(best, ids)
            carry = ids[-PAD:]
        tail = np.concatenate([carry, end]) if some else np.concatenate([end, end])
        self.raise_to(best, tail)
        return best, told

    def raise_to(self, best: np.ndarray, ids: np.ndarray) -> None:
        words = self.table[ids[:, 0]]
        for c in range(1, ids.shape[1]):
            words += self.table[ids[:, c]]
        at = 0
        for k, w in enumerate(WIDTHS):
            n = len(ids) - w + 1
            if n > 0:
                total = words[:n, at : at + FILTERS].copy()
                for j in range(1, w):
                    total += words[j : j + n, at + j * FILTERS : at + (j + 1) * FILTERS]
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                np.maximum(best[own], total.max(axis=0), out=best[own])
            at += w * FILTERS

    def logit(self, parts: Iterable[np.ndarray]) -> tuple[float, int]:
        """Raw logit, and the number of the text's language (-1: cannot be told)."""
        best, told = self.pooled(parts)
        z = float(np.maximum(best + self.shift, 0) @ self.out + self.bias)
        return z, int(np.argmax(told)) if len(told) and np.ptp(told) > 0 else -1

    def score(self, text: bytes | None) -> float:
        z, language = self.logit(features(text))
        cut, slope = self.cuts[language]
        at = np.log(THRESHOLD / (1 - THRESHOLD))
        return float(1 / (1 + np.exp(-np.clip(slope * (settled(z) - cut) + at, -30, 30))))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"table": None}


def kept_out_of(n: int) -> np.ndarray:
    """Which of the labelled texts are not trained on: every fourth."""
    return np.arange(n) % 4 == 3


def fit(texts: list[np.ndarray], toxic: np.ndarray, langs: list[str | None], epochs: int = 6, seed: int = 5) -> Model:
    """Train on three quarters of the labelled texts (packed features) and calibrate on the rest."""
    rng, model = np.random.default_rng(seed), Model()
    if not len(texts) or toxic.min() == toxic.max():
        return model
    kept_out = kept_out_of(len(texts))
    train = np.flatnonzero(~kept_out)
    _begin(model, [texts[i] for i in train], toxic[train], rng)
    _train(model, [buckets(t) for t in texts], toxic.astype(np.float32), train, epochs, rng)
    _tell_languages(model, [texts[i] for i in train], [langs[i] for i in train])
    _calibrate(model, texts, toxic, ~kept_out)
    return model


def _begin(model: Model, texts: list[np.ndarray], toxic: np.ndarray, rng: np.random.Generator) -> None:
    """Random weights, but a first dimension that starts as smoothed log odds of the buckets."""
    seen = np.zeros((2, BUCKETS))
    for t, y in zip(texts, toxic, strict=True):
        seen[int(y), np.unique(buckets(t))] += 1
    per = seen.sum(axis=1) * 0 + np.array([max(1, (toxic == 0).sum()), max(1, (toxic == 1).sum())])
    rates = (seen + 3.0 * per[:, None] / per.sum()) / per[:, None]
    odds = np.log(rates[1] / rates[0])
    model.words[:BUCKETS] = rng.normal(0, 0.05, (BUCKETS, DIM))
    model.words[:BUCKETS, 0] = np.clip(odds, -2, 4) / 2
    for w in WIDTHS:
        model.filters[w] = rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32)
        if w == 1:
            # single words speak first; wider filters learn what these leave open, so that a word weighs the same
            # whatever stands beside it
            model.filters[w][:, 0, :] += rng.uniform(0.2, 1.0, (w, FILTERS)).astype(np.float32)
    model.out[:] = rng.uniform(0.1, 0.4, len(model.out))
    model.shift[:] = -0.5


def _train(model: Model, ids: list[np.ndarray], y: np.ndarray, train: np.ndarray, epochs: int, rng, rate: float = 0.003, size: int = 64) -> None:
    names = ["words", "shift", "out", "bias", *WIDTHS]
    def weights(k):
        return model.filters[k] if k in WIDTHS else getattr(model, k)
    model.bias = np.array(model.bias, np.float32).reshape(1)
    first = {k: np.zeros_like(weights(k)) for k in names}
    second = {k: np.zeros_like(weights(k)) for k in names}
    weight = np.where(y > 0, len(train) / (2 * max(1, y[train].sum())), len(train) / (2 * max(1, (1 - y[train]).sum()))).astype(np.float32)
    pad = np.full((PAD, len(PREFIXES) + 1), BUCKETS)
    step = 0
    # the word of each text that looks most toxic at the start; crops keep it, so that their label still holds
    peaks = [int(model.words[x][:, :, 0].sum(axis=1).argmax()) if len(x) else 0 for x in ids]

    def crop(i: int) -> np.ndarray:
        """Half of the texts in part, from one word to all: the logit must not depend on the length."""
        x = ids[i]
        if len(x) < 2 or rng.random() < 0.5:
            return x
        n = int(np.exp(rng.uniform(0, np.log(len(x) + 1))))
        low, high = max(0, peaks[i] - n + 1), min(peaks[i], len(x) - n)
        at = int(rng.integers(low, high + 1))
        return x[at : at + n]

    for _ in range(epochs):
        order = rng.permutation(train)
        for at in range(0, len(order), size):
            chosen = order[at : at + size]
            step += 1
            # every text followed by padding: windows begin at its words, or at the padding of an empty text
            used = [crop(i) for i in chosen]
            flat = np.concatenate([x for t in used for x in (t, pad)] + [pad])
            lens = np.array([max(1, len(t)) for t in used])
            places = np.concatenate(([0], np.cumsum([len(t) + PAD for t in used])))[:-1]
            starts = np.concatenate([p + np.arange(n) for p, n in zip(places, lens, strict=True)])
            bounds = np.concatenate(([0], np.cumsum(lens)))[:-1]
            v = model.vectors(flat)
            pooled, where = [], []
            for w in WIDTHS:
                total = sum(v[starts + j] @ model.filters[w][j] for j in range(w))
                top = np.maximum.reduceat(total, bounds, axis=0)
                hit = np.where(total == np.repeat(top, lens, axis=0), np.arange(len(total))[:, None], len(total))
                where.append(starts[np.minimum.reduceat(hit, bounds, axis=0)])
                pooled.append(top)
            raw = np.concatenate(pooled, axis=1) + model.shift
            f = np.maximum(raw, 0)
            z = f @ model.out + model.bias[0]
            dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[chosen]) * weight[chosen] / len(chosen)
            df = dz[:, None] * model.out * (raw > 0)
            grads = {"out": f.T @ dz + 1e-4 * model.out, "bias": np.array([dz.sum()]), "shift": df.sum(axis=0), "words": np.zeros_like(model.words)}
            for k, w in enumerate(WIDTHS):
                d = df[:, k * FILTERS : (k + 1) * FILTERS]
                grads[w] = np.zeros_like(model.filters[w])
                for j in range(w):
                    spot = where[k] + j
                    grads[w][j] = np.einsum("bk,bkd->dk", d, v[spot])
                    back = (d[:, :, None] * model.filters[w][j].T[None]).reshape(-1, DIM)
                    for c in range(flat.shape[1]):
                        np.add.at(grads["words"], flat[spot.ravel(), c], back)
            grads["words"][BUCKETS] = 0
            for k in names:
                g = grads[k].astype(np.float32)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                move = rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)
                weights(k)[...] -= move
    model.bias = np.float32(model.bias[0])


def _tell_languages(model: Model, texts: list[np.ndarray], langs: list[str | None]) -> None:
    """Log probabilities of buckets by language, from the training texts."""
    model.languages = sorted({x for x in langs if x is not None})
    model.told = np.zeros((BUCKETS, len(model.languages)), np.float32)
    for k, name in enumerate(model.languages):
        own = [buckets(t)[:, 0] for t, g in zip(texts, langs, strict=True) if g == name]
        n = np.bincount(np.concatenate(own), minlength=BUCKETS) + 0.1
        model.told[:, k] = np.log(n / n.sum())


def _calibrate(model: Model, texts: list[np.ndarray], toxic: np.ndarray, trained: np.ndarray) -> None:
    """Calibrate on texts that each count once."""
    model.table = None
    found = [model.logit([t]) for t in texts]
    z, lang = np.array([f[0] for f in found], float), np.array([f[1] for f in found], int)
    calibrate(model, z, lang, toxic, trained, np.ones(len(z)))


def calibrate(model: Model, z: np.ndarray, lang: np.ndarray, toxic: np.ndarray, trained: np.ndarray, n: np.ndarray, least: int = 8) -> None:
    """Put each language's cut where it separates best its own labelled rows and, as ``least`` more, those of all languages:
    the fewer rows a language has, the nearer its cut is to the common one.

    ``n`` rows have the logit, language and label, and were trained on or not. Logits of rows trained on lie too far
    apart, so the others stand for them, label by label, and the rate of toxic rows stays that of all; only where there
    are fewer than ``least`` others of a label do all rows count.
    """

    z = settled(z)

    def weights(own: np.ndarray) -> np.ndarray:
        w = np.where(own, n, 0.0)
        fresh = np.where(trained, 0.0, w)
        labels = [toxic == y for y in (0, 1)]
        if min(fresh[y].sum() for y in labels) < least:
            return w
        return sum(np.where(y, fresh * w[y].sum() / fresh[y].sum(), 0.0) for y in labels)

    w = weights(np.ones(len(z), bool))
    middle = np.average(z, weights=w) if len(z) else 0.0
    spread = max(1e-3, float(np.sqrt(np.average((z - middle) ** 2, weights=w)))) if len(z) else 1.0
    common = [best_cut(z, toxic, w), 2 / spread]
    cuts = []
    # rows of all languages count as ``least`` more rows of each
    others = w * (least / max(1.0, w.sum()))
    for k in range(len(model.languages)):
        own = lang == k
        cuts.append([best_cut(z, toxic, weights(own) + others), common[1]])
    model.cuts = np.array([*cuts, common])


def best_cut(z: np.ndarray, toxic: np.ndarray, weight: np.ndarray | None = None) -> float:
    """The middle of the gap with the highest F1; of equal ones the widest."""
    weight = np.ones(len(z)) if weight is None else weight
    z, toxic, weight = z[weight > 0], toxic[weight > 0], weight[weight > 0]
    if not len(z):
        return 0.0
    z, at = np.unique(z, return_inverse=True)
    right = np.bincount(at, weight * toxic)[::-1].cumsum()[::-1]
    called = np.bincount(at, weight)[::-1].cumsum()[::-1]
    f1 = 2 * right / (called + right[0])
    gap = np.diff(z, prepend=z[0] - 1.0)
    k = max(np.flatnonzero(f1 >= f1.max() - 1e-9), key=lambda i: gap[i])
    return float(z[k] - gap[k] / 2)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 3000, max_bytes: int = 32_768) -> Model:
    """Fit on a bounded sample: of each label at most ``per_class`` ids with texts of at most ``max_bytes``.

    The ids are those first by a hash; three quarters of them are trained on. The cuts of the languages are then chosen
    from the logits of all labelled texts, counted in steps. Rows without doc_id, text or label teach nothing; an id with
    several labels counts as toxic. Eight bytes for each word of the sample reach the driver, at most
    8 * per_class * max_bytes (786 MB by default, if all texts are as long as they may be and of one letter a word), and
    a count for every language, label and step. Languages are not named to the scorer: it tells them from the text.
    """
    spark = prepare(docs.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = materialise(known)
    fits = docs.where(F.octet_length("text") <= max_bytes).select("doc_id", "text", "lang")
    ids = known.join(fits.select("doc_id").distinct(), "doc_id").withColumn("_h", F.xxhash64("doc_id"))
    picked = [ids.where(F.col("toxic") == y).orderBy("_h", "doc_id").limit(per_class).select("doc_id", "toxic") for y in (0, 1)]
    sample = fits.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (texts,) = next(rows([b], "text"))
            packed = [np.concatenate([np.empty(0, np.int64), *features(t)]).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(packed, pa.binary())], ["doc_id", "toxic", "lang", "words"])

    bare = sample.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("binary").alias("text"))
    found = bare.mapInArrow(pack, "doc_id string, toxic int, lang string, words binary").toArrow()
    order = np.argsort([xxhash.xxh64_intdigest(f"{i} {k}") for i, k in zip(found["doc_id"].to_pylist(), map(len, found["words"].to_pylist()), strict=True)], kind="stable")
    words = [np.frombuffer(x, np.int64) for x in found["words"].to_pylist()]
    langs, toxic = found["lang"].to_pylist(), (np.array(found["toxic"].to_pylist(), np.int64) > 0).astype(np.int64)
    model = fit([words[i] for i in order], toxic[order], [langs[i] for i in order])
    if not len(toxic) or toxic.min() == toxic.max():
        return model
    names = found["doc_id"].to_pylist()
    taught = sorted({names[i] for i in order[~kept_out_of(len(order))]})
    taught = spark.createDataFrame([(x,) for x in taught], "id string")
    counts = logit_counts(docs, known, taught, model, max_bytes).toArrow()
    step, lang, label, trained, n = (counts[c].to_numpy() for c in ("step", "language", "label", "trained", "n"))
    calibrate(model, (step + 0.5) * STEP, lang, label, trained.astype(bool), n.astype(float))
    return model


def logit_counts(docs: DataFrame, known: DataFrame, taught: DataFrame, model: Model, max_bytes: int) -> DataFrame:
    """Number of labelled rows for every language, label, step of the logit, and whether they were trained on.

    Texts do not move: few labels are sent to them, of many only the logits go to the labels.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            (texts,) = next(rows([b], "text"))
            found = [m.logit(features(t)) for t in texts]
            steps = np.clip(np.floor(np.array([z for z, _ in found], float) / STEP), -STEPS, STEPS - 1).astype(np.int32)
            short = [len(t) <= max_bytes for t in texts]
            arrays = [b.column(0), pa.array(steps), pa.array([k for _, k in found], pa.int32()), pa.array(short, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "step", "language", "short"])

    small = is_small(known, BROADCAST_BYTES)
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("text").cast("binary").alias("text"))
    if small:
        texts = texts.join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    told = texts.mapInArrow(run, f"doc_id {kind}, step int, language int, short boolean").join(hinted(known, small), "doc_id")
    told = told.join(F.broadcast(taught), F.col("doc_id").cast("string") == F.col("id"), "left")
    trained = (F.col("id").isNotNull() & F.col("short")).cast("int").alias("trained")
    label = (F.col("toxic") > 0).cast("int").alias("label")
    return told.groupBy("step", "language", label, trained).agg(F.count("*").alias("n"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without its text, with score (0 to 1) of the whole text and predicted (1 from the threshold on).

    A null or empty text is scored as an empty one; rows that repeat score alike; an empty table gives no rows; columns
    named like an added one are replaced. Nothing but the text is an input.
    """
    spark = prepare(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)
    kept = others(docs, "text", "score", "predicted")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            (texts,) = next(rows([b], "text"))
            scores = np.array([m.score(t) for t in texts], float)
            out = [b.column(k) for k in kept] + [pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, [*kept, "score", "predicted"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*kept).schema)
    return docs.select(*kept, F.col("text").cast("binary").alias("text")).mapInArrow(run, f"{kinds}score double, predicted int")
