"""Language-model scores by prediction by partial matching over bytes, pretrained on the corpus.

The model is a trie of byte contexts up to a given order. A byte seen in its context costs its share there, less half a
count; one unseen costs the context's escape (half a count for each distinct successor) and is predicted by the next
shorter context, without the bytes that the longer one has seen. Sequences of up to three bytes are one table of counts; a context, its successors
and all its suffixes of three bytes or more are solved together, on their own.

Texts are dealt once into groups of bounded size. A group sends its distinct words and byte sequences with their counts
in training texts, dealt by a hash of the whole sequence. Each hash range sums the counts of all groups; distinct
sequences go on to be solved, and their probabilities come back to the range, which answers the groups.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.plans.sizing import materialise

from .common import Hashes, mixed, others, pack, prepare, split_sorted, unpack, word_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Not a byte of UTF-8: begins and ends every text.
EDGE = b"\xff"
#: Not a word: the end of a text as a token.
END_TOKEN = b" "
SYMBOLS = 256
_HASHES = Hashes()


def pieces(texts: list[bytes], order: int, size: int = 1 << 21) -> Iterator[tuple[np.ndarray, list[int], list[int]]]:
    """Bounded parts of all texts: bytes, the number of the text of each stretch, and the stretches' lengths.

    A stretch starts with the ``order`` bytes before it; edges stand before and after a text.
    """
    parts, owners, total = [], [], 0
    for k, text in enumerate(texts):
        for a in range(0, max(1, len(text)), size):
            before = (EDGE * order + text[max(0, a - order) : a])[-order:] if order else b""
            part = before + text[a : a + size] + (EDGE if a + size >= len(text) else b"")
            parts.append(part)
            owners.append(k)
            total += len(part)
            if total >= size:
                yield np.frombuffer(b"".join(parts), np.uint8), owners, list(map(len, parts))
                parts, owners, total = [], [], 0
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), owners, list(map(len, parts))


def grams(data: np.ndarray, lengths: list[int], order: int) -> np.ndarray:
    """For every predicted byte its context, nearest byte first, then the byte, as one number."""
    b = data.astype(np.uint64)
    n = len(b) - order
    key = np.zeros(n, np.uint64)
    for j in range(1, order + 1):
        key = (key << np.uint64(8)) | b[order - j : order - j + n]
    key = (key << np.uint64(8)) | b[order:]
    keep = np.ones(len(b), bool)
    starts = np.cumsum([0, *lengths[:-1]])
    for j in range(order):
        keep[starts + j] = False
    return key[keep[order:]]


def tokens(text: bytes) -> np.ndarray:
    parts = [_HASHES.of(words) for words in word_chunks(text)]
    return np.concatenate([*parts, _HASHES.of([END_TOKEN])])


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, and their summed weights."""
    codes, distinct = pd.factorize(keys)
    sums = np.bincount(codes, weights, minlength=len(distinct))
    order = np.argsort(distinct)
    return distinct[order], sums[order]


def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.empty(0, np.uint64), np.empty(0)
    return counted(*(np.concatenate(x) for x in zip(*found, strict=True)))


#: Bytes of a group whose sequences are kept in memory between counting and scoring.
KEPT = 16 << 20


class Group:
    """The texts of a group: their words and, piece by piece, numbers of their distinct byte sequences."""

    def __init__(self, texts: list[bytes], order: int):
        self.texts, self.order = texts, order
        # a group is a few MB, unless one text alone is larger: that one is read again for each use
        self.small = sum(map(len, texts)) <= KEPT
        self.words = [tokens(t) for t in texts] if self.small else None
        self.found = list(self._pieces()) if self.small else None

    def _pieces(self) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
        for data, owners, lengths in pieces(self.texts, self.order):
            codes, distinct = pd.factorize(grams(data, lengths, self.order))
            yield owners, np.array(lengths) - self.order, codes.astype(np.int32), distinct

    def sequences(self) -> Iterable[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
        """Texts, numbers of places and the numbers of the sequences there, and the distinct sequences."""
        return self._pieces() if self.found is None else self.found

    def tokens(self) -> Iterable[np.ndarray]:
        return map(tokens, self.texts) if self.words is None else self.words


def group_counts(group: Group, train: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    """Distinct words and byte sequences of a group, with their counts in its training texts."""
    words, seen = [], []
    for t, learn in zip(group.tokens(), train, strict=True):
        words.append((t, np.full(len(t), float(learn))))
        if sum(len(w[0]) for w in words[-256:]) > 1 << 20:
            words = [merged(words)]
    for owners, places, codes, distinct in group.sequences():
        seen.append((distinct, np.bincount(codes, np.repeat(train[owners].astype(float), places), minlength=len(distinct))))
    return merged(words), merged(seen)


def gram_bucket(keys: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Sequences that end their context in the same three bytes (two, if it has no more) go together."""
    return sequence_bucket(keys >> np.uint64(8 * max(1, order - 2)), buckets)


def sequence_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mixed(keys + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


def dealt(b: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted sequences by bucket, and the buckets' edges in it."""
    return np.argsort(b, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(b, minlength=buckets))))


def pair_counts(texts: Iterable[bytes]) -> np.ndarray:
    out = np.zeros(1 << 16, np.int64)
    for data, _, lengths in pieces(list(texts), 1):
        out += np.bincount(grams(data, lengths, 1).astype(np.int64), minlength=1 << 16)
    return out


def triple_counts(texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two bytes of context, nearest first, and the byte: distinct numbers and their counts."""
    return merged([counted(grams(data, lengths, 2)) for data, _, lengths in pieces(list(texts), 2)])


def pairs_of(triples: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    pair = ((triples[0] >> np.uint64(16)) << np.uint64(8)) | (triples[0] & np.uint64(255))
    return np.bincount(pair.astype(np.int64), triples[1], minlength=1 << 16).astype(np.int64)


def whole_contexts(own: np.ndarray, triples: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The given triples and all others of the corpus in the same contexts, and their counts."""
    at = np.isin(triples[0] >> np.uint64(8), np.unique(own >> np.uint64(8)))
    keys = np.union1d(own, triples[0][at])
    counts = np.zeros(len(keys))
    counts[np.searchsorted(keys, triples[0][at])] = triples[1][at]
    return keys, counts


def share(n: np.ndarray, total: np.ndarray, kinds: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probability by counts less a half where there are some, else the escape times what shorter contexts give."""
    whole = np.maximum(total, 1)
    return np.where(n > 0, (n - 0.5) / whole, np.where(kinds > 0, 0.5 * kinds / whole, 1.0) * below)


def log_probabilities(keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray, order: int, triples: tuple | None = None) -> np.ndarray:
    """log10 of the probability of the last byte of each sequence after its context.

    ``keys`` are distinct and sorted, and hold all sequences of the corpus that share the last two context bytes; with
    the corpus counts of ``triples``, for an order over two, the last three. ``pairs`` are the corpus counts of byte pairs.
    """
    two = pairs.reshape(SYMBOLS, SYMBOLS).astype(float)
    one = two.sum(axis=0)
    # from the longest contexts down: distinct sequences, counts, contexts, and where each goes in the next
    levels = []
    k, n = keys, counts
    for j in range(order, 1, -1):
        if j == 2 and levels and triples is not None:
            own = k
            k, n = whole_contexts(own, triples)
            levels[-1] = (*levels[-1][:4], np.searchsorted(k, own)[levels[-1][4]])
        contexts, at = np.unique(k >> np.uint64(8), return_inverse=True)
        lower = ((k >> np.uint64(16)) << np.uint64(8)) | (k & np.uint64(255))
        short, down = np.unique(lower, return_inverse=True)
        levels.append((k, n, at, len(contexts), down))
        k, n = short, np.bincount(down, n, minlength=len(short))
    # k is now (nearest byte, byte); their counts are known from the whole corpus
    c1, s = (k >> np.uint64(8)).astype(np.int64), (k & np.uint64(255)).astype(np.int64)
    kinds0, kinds1 = (one > 0).sum(), (two > 0).sum(axis=1)
    unseen = 1 / max(1, SYMBOLS - kinds0)
    rest0 = one.sum() - ((two > 0) * one[None, :]).sum(axis=1)
    below = share(one[s], rest0[c1], (kinds0 - kinds1)[c1], np.full(len(s), unseen))
    n = two[c1, s]
    total, kinds = two.sum(axis=1)[c1], kinds1[c1].astype(float)
    for _, n_up, at, size, down in reversed(levels):
        # what the longer context has seen is left out here
        seen = n_up > 0
        kinds_up = np.bincount(at, seen, minlength=size)
        left_out = np.bincount(at, np.where(seen, n[down], 0.0), minlength=size)
        below = share(n[down], total[down] - left_out[at], kinds[down] - kinds_up[at], below[down])
        n, total, kinds = n_up, np.bincount(at, n_up, minlength=size)[at], kinds_up[at]
    return np.log10(share(n, total, kinds, below))


def planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def text_scores(group: Group, words: tuple, sequences: tuple) -> Iterator[tuple[int, int, float, float]]:
    """For each text: tokens, known tokens, sum of log10(count + 1), log10 probability; from sorted keys and values."""
    scores = np.zeros(len(group.texts))
    for owners, places, codes, distinct in group.sequences():
        values = sequences[1][np.searchsorted(sequences[0], distinct)][codes]
        np.add.at(scores, owners, np.add.reduceat(values, np.cumsum(places) - places))
    for k, t in enumerate(group.tokens()):
        count = words[1][np.searchsorted(words[0], t)]
        yield len(t), int((count > 0).sum()), float(np.log10(count + 1).sum()), float(scores[k])


def score(docs: DataFrame, train: Column, order: int = 4, group_bytes: int = 4 << 20, bucket_bytes: int = 32 << 20) -> DataFrame:
    """``docs`` without its text, with n_tokens, n_known, train_tokens, base_score and score.

    Texts are scored whole, with A-Z in lower case; words and an end are the tokens of the base, a unigram model with one
    added to each count; score is log10 of the model's probability of the text's bytes and its end. The model learns
    from the rows where ``train`` holds (null does not). Null texts are empty; rows that repeat count each time; an
    empty table gives no rows; without training rows all words are unknown (counted as one token) and all bytes alike.
    Columns named like an added one are replaced.

    Only the counts of the distinct triples of bytes (at most 2 to the 24, some hundred thousand in prose) and two totals
    reach the driver, and every executor. No task depends on how many groups have a frequent context. ``order`` is 2 to 6.
    """
    if not 2 <= order <= 6:
        raise ValueError("order must be 2 to 6")
    spark = prepare(docs.sparkSession)
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kept = others(docs, *added, "text", "_grp", "_train")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups, buckets = max(1, math.ceil(total / group_bytes)), max(1, math.ceil(total / bucket_bytes))
    spot = F.pmod(F.xxhash64("text", *kept[:1]), F.lit(groups)).cast("int")
    learn = F.coalesce(train, F.lit(False))
    grouped = docs.select(spot.alias("_grp"), *kept, learn.alias("_train"), F.col("text").cast("binary").alias("text"))

    def triple_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            sums.append(triple_counts([(t or b"").lower() for t in b.column(0).to_pylist()]))
            if len(sums) >= 16:
                sums = [merged(sums)]
        at, n = merged(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n.astype(np.int64))], ["triple", "n"])

    taught = docs.where(learn).select(F.col("text").cast("binary").alias("text"))
    found = taught.mapInArrow(triple_rows, "triple int, n long").groupBy("triple").agg(F.sum("n").alias("n")).toArrow().sort_by("triple")
    triples = found["triple"].to_numpy().astype(np.uint64), found["n"].to_numpy()
    sent = spark.sparkContext.broadcast((pairs_of(triples), triples))

    def read(group: pa.Table) -> list[bytes]:
        return [(t or b"").lower() for t in group.column("text").to_pylist()]

    def known(group: pa.Table) -> tuple:
        own = Group(read(group), order)
        return own, *group_counts(own, np.array(group.column("_train").to_pylist(), bool))

    def places(words: np.ndarray, sequences: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Buckets, and the numbers of a group's keys there: sequences first, then words."""
        turn, edges = dealt(sequence_bucket(sequences, buckets), buckets)
        yield from ((i, turn[edges[i] : edges[i + 1]]) for i in range(buckets))
        cuts = [0, *split_sorted(words, buckets).tolist(), len(words)]
        yield from ((buckets + i, np.arange(cuts[i], cuts[i + 1])) for i in range(buckets))

    def ask(key: tuple, group: pa.Table) -> pa.Table:
        _, words, sequences = known(group)
        out = []
        for bucket, at in places(words[0], sequences[0]):
            if len(at):
                keys, counts = words if bucket >= buckets else sequences
                out.append((bucket, key[0].as_py(), pack(keys[at]), planes(counts[at].astype("<u4"))))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "_grp", "keys", "counts"])

    def merge(key: tuple, bucket: pa.Table) -> pa.Table:
        """Distinct sequences of all groups in a hash range, for those who solve them."""
        number, out = key[0].as_py(), []
        if number < buckets:
            flat = np.concatenate([unpack(x) for x in bucket.column("keys").to_pylist()])
            counts = np.concatenate([from_planes(x, "<u4") for x in bucket.column("counts").to_pylist()])
            distinct, sums = counted(flat, counts)
            turn, edges = dealt(gram_bucket(distinct, order, buckets), buckets)
            for i in range(buckets):
                if len(at := turn[edges[i] : edges[i + 1]]):
                    out.append((i, number, pack(distinct[at]), planes(sums[at].astype("<i8"))))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["solver", "bucket", "keys", "counts"])

    def solve(key: tuple, parts: pa.Table) -> pa.Table:
        keys = [unpack(x) for x in parts.column("keys").to_pylist()]
        flat = np.concatenate(keys)
        counts = np.concatenate([from_planes(x, "<i8") for x in parts.column("counts").to_pylist()])
        turn = np.argsort(flat)
        values = np.empty(len(flat), "<f4")
        values[turn] = log_probabilities(flat[turn], counts[turn].astype(float), sent.value[0], order, sent.value[1])
        edges = np.cumsum([0, *map(len, keys)])
        data = pa.array([planes(values[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())
        return pa.table([parts.column("bucket"), parts.column("keys"), data], ["bucket", "keys", "data"])

    def answer(key: tuple, bucket: pa.Table, solved: pa.Table) -> pa.Table:
        number, who = key[0].as_py(), bucket.column("_grp").to_pylist()
        keys = [unpack(x) for x in bucket.column("keys").to_pylist()]
        if number >= buckets:
            counts = np.concatenate([from_planes(x, "<u4") for x in bucket.column("counts").to_pylist()])
            distinct, sums = counted(np.concatenate(keys), counts)
            values = sums.astype("<i8")
            totals = (int(sums.sum()), int((sums > 0).sum()))
        else:
            distinct = np.concatenate([unpack(x) for x in solved.column("keys").to_pylist()])
            values = np.concatenate([from_planes(x, "<f4") for x in solved.column("data").to_pylist()])
            turn = np.argsort(distinct)
            distinct, values, totals = distinct[turn], values[turn], (0, 0)
        data = [planes(values[np.searchsorted(distinct, k)]) for k in keys]
        n = len(who)
        columns = [[*who, -1], [number] * (n + 1), [*data, b""], [0] * n + [totals[0]], [0] * n + [totals[1]]]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["_grp", "bucket", "data", "tokens", "distinct"])

    asked = grouped.groupBy("_grp").applyInArrow(ask, "bucket int, _grp int, keys binary, counts binary")
    # both sides read one exchange of what was asked
    merges = asked.groupBy("bucket").applyInArrow(merge, "solver int, bucket int, keys binary, counts binary")
    solved = merges.groupBy("solver").applyInArrow(solve, "bucket int, keys binary, data binary")
    answers = asked.groupBy("bucket").cogroup(solved.groupBy("bucket"))
    answers = materialise(answers.applyInArrow(answer, "_grp int, bucket int, data binary, tokens long, distinct long"))
    n, v = answers.where("_grp = -1").agg(F.sum("tokens"), F.sum("distinct")).first()
    n, v = n or 0, v or 0
    unit = math.log10(n + v + 1)

    def results(key: tuple, group: pa.Table, reply: pa.Table) -> pa.Table:
        own, words, sequences = known(group)
        data = dict(zip(reply.column("bucket").to_pylist(), reply.column("data").to_pylist(), strict=True))
        counts, logs = np.zeros(len(words[0]), np.int64), np.zeros(len(sequences[0]))
        for bucket, at in places(words[0], sequences[0]):
            if len(at):
                into, kind = (counts, "<i8") if bucket >= buckets else (logs, "<f4")
                into[at] = from_planes(data[bucket], kind)
        found = list(text_scores(own, (words[0], counts), (sequences[0], logs)))
        columns = {c: group.column(c) for c in kept} | {
            "n_tokens": pa.array([f[0] for f in found], pa.int64()),
            "n_known": pa.array([f[1] for f in found], pa.int64()),
            "train_tokens": pa.array([n] * len(found), pa.int64()),
            "base_score": pa.array([f[2] - f[0] * unit for f in found], pa.float64()),
            "score": pa.array([f[3] for f in found], pa.float64()),
        }
        return pa.table(columns)

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*kept).schema)
    out = grouped.groupBy("_grp").cogroup(answers.where("_grp >= 0").groupBy("_grp"))
    return out.applyInArrow(results, f"{kinds}n_tokens long, n_known long, train_tokens long, base_score double, score double")
