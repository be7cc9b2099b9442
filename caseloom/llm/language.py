"""Language identification by unigrams of pieces, summed over all segmentations.

The pieces are those of a public vocabulary, the same for all languages; each language has its own probabilities of
them, learnt by expectation maximisation. A word's probability is the sum over all ways to cut it into pieces, by the
forward algorithm; a text's is the product over its words.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import others, prepare, rows, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BEGIN = "▁"
UNKNOWN = "und"
#: Probabilities of words up to this length stay far from underflow; those of longer ones are rescaled on the way.
SHORT = 24
#: Longer words than this are read in blocks of so many characters.
BLOCK = 50_000
_LETTER = regex.compile(r"\p{L}")


def vocabulary(path: str) -> dict[str, int]:
    """Text pieces of a sentencepiece file, numbered from 1; number 0 is any single character without a piece."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    special = [sp.is_unknown, sp.is_control, sp.is_byte, sp.is_unused]
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not any(f(i) for f in special)]
    return {p: i for i, p in enumerate(dict.fromkeys(names), 1)}


def words_of(data: bytes) -> list[str]:
    """Words in lower case."""
    return data.decode("utf-8", "replace").lower().split()


class Pieces:
    """All prefixes of the pieces in hash tables, to look up many places of a text at once."""

    SLOTS = 20
    STEP = 0x100000001B3

    def __init__(self, pieces: dict[str, int]):
        number = {p[:i]: 0 for p in pieces for i in range(1, len(p))} | pieces
        self.longest = max(map(len, pieces), default=1)
        hashes = []
        for p in number:
            h = 0
            for c in p:
                h = (h * self.STEP + ord(c) + 1) % (1 << 64)
            hashes.append(h)
        self.hash = np.array(hashes, np.uint64)
        #: Number of the piece, 0 for what is only the start of some.
        self.number = np.array(list(number.values()), np.int64)
        self.tables: list[tuple[np.uint64, np.ndarray]] = []
        left = np.arange(len(self.hash))
        # what finds its slot taken goes to the next table
        while len(left):
            factor = np.uint64((0x9E3779B97F4A7C15 * (2 * len(self.tables) + 1)) % (1 << 64) | 1)
            table = np.zeros(1 << self.SLOTS, np.int32)
            slot = self.slots(self.hash[left], factor)
            table[slot] = left
            self.tables.append((factor, table))
            left = left[table[slot] != left]

    def slots(self, h: np.ndarray, factor: np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (((h ^ (h >> np.uint64(29))) * factor) >> np.uint64(64 - self.SLOTS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        out = np.full(len(h), -1, np.int64)
        open_ = np.arange(len(h))
        for factor, table in self.tables:
            entry = table[self.slots(h[open_], factor)]
            hit = self.hash[entry] == h[open_]
            out[open_[hit]] = entry[hit]
            open_ = open_[~hit]
        return out


class Lattice:
    """All segmentations of some words: an edge for every piece at every place."""

    def __init__(self, words: list[str], pieces: Pieces):
        self.lengths = np.array([len(w) for w in words], np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64) + np.uint64(1)
        owner = np.repeat(np.arange(len(words)), self.lengths)
        first = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        place = np.arange(len(code)) - first[owner] if len(code) else np.empty(0, np.int64)
        left = self.lengths[owner] - place
        at, h = np.arange(len(code)), np.zeros(len(code), np.uint64)
        found: list[tuple[np.ndarray, ...]] = []
        size = 0
        while len(at):
            size += 1
            with np.errstate(over="ignore"):
                h = h * np.uint64(Pieces.STEP) + code[at + size - 1]
            entry = pieces.find(h) if len(pieces.hash) else np.full(len(h), -1)
            number = np.where(entry >= 0, pieces.number[np.maximum(entry, 0)] if len(pieces.hash) else 0, 0)
            # a single character without a piece is an unknown one
            use = np.ones(len(at), bool) if size == 1 else number > 0
            found.append((owner[at[use]], place[at[use]], place[at[use]] + size, number[use]))
            on = (entry >= 0) & (left[at] > size)
            at, h = at[on], h[on]
        word, start, end, piece = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.empty(0, np.int64)] * 4
        order = np.argsort(end, kind="stable")
        self.word, self.start, self.end, self.piece = word[order], start[order], end[order], piece[order]
        self.most = int(self.lengths.max(initial=0))
        self.at = np.searchsorted(self.end, np.arange(self.most + 2))

    def forward(self, probability: np.ndarray) -> np.ndarray:
        """alpha[place, word, language]: probability of the first characters, over all segmentations."""
        n = len(self.lengths)
        alpha = np.zeros((self.most + 1, n, probability.shape[1]))
        alpha[0] = 1
        for e in range(1, self.most + 1):
            own = slice(self.at[e], self.at[e + 1])
            w = self.word[own]
            flow = alpha[self.start[own], w] * probability[self.piece[own]]
            for k in range(probability.shape[1]):
                alpha[e, :, k] = np.bincount(w, flow[:, k], minlength=n)
        return alpha

    def log_forward(self, probability: np.ndarray, backward: bool = False) -> np.ndarray:
        """Logarithm of ``forward`` for words of any length; ``backward`` of the last characters, by their number.

        Only as many places as the longest piece has are needed further on; they are rescaled as a whole.
        """
        span = int((self.end - self.start).max(initial=1))
        start, end, at = self.start, self.end, self.at
        word, piece = self.word, self.piece
        if backward:
            start, end = self.lengths[word] - self.end, self.lengths[word] - self.start
            order = np.argsort(end, kind="stable")
            start, end, word, piece = start[order], end[order], word[order], piece[order]
            at = np.searchsorted(end, np.arange(self.most + 2))
        n, kinds = len(self.lengths), probability.shape[1]
        alpha, scale = np.zeros((self.most + 1, n, kinds)), np.zeros((n, kinds))
        alpha[0] = 1
        logs = np.zeros_like(alpha)
        for e in range(1, self.most + 1):
            own = slice(at[e], at[e + 1])
            w = word[own]
            flow = alpha[start[own], w] * probability[piece[own]]
            for k in range(kinds):
                alpha[e, :, k] = np.bincount(w, flow[:, k], minlength=n)
            with np.errstate(divide="ignore"):
                logs[e] = np.log(alpha[e]) + scale
            if e % 8 == 0:
                near = alpha[max(0, e - span + 1) : e + 1]
                top = near.max(axis=0)
                top[top == 0] = 1
                near /= top
                scale += np.log(top)
        return logs

    def log_probability(self, probability: np.ndarray) -> np.ndarray:
        if self.most > SHORT:
            logs = self.log_forward(probability)
            return logs[self.lengths, np.arange(len(self.lengths))]
        alpha = self.forward(probability)
        return np.log(np.maximum(alpha[self.lengths, np.arange(len(self.lengths))], 1e-300))

    def expected(self, probability: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece, over all segmentations of all words (one language)."""
        if self.most > SHORT:
            first, last = (self.log_forward(probability[:, None], side)[:, :, 0] for side in (False, True))
            whole = first[self.lengths, np.arange(len(self.lengths))]
            with np.errstate(divide="ignore"):
                use = first[self.start, self.word] + np.log(probability[self.piece]) + last[self.lengths[self.word] - self.end, self.word]
            return np.bincount(self.piece, np.exp(use - whole[self.word]) * counts[self.word], minlength=len(probability))
        alpha = self.forward(probability[:, None])[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[self.lengths, np.arange(len(self.lengths))] = 1
        for e in range(self.most, 0, -1):
            own = slice(self.at[e], self.at[e + 1])
            np.add.at(beta, (self.start[own], self.word[own]), probability[self.piece[own]] * beta[e, self.word[own]])
        total = np.maximum(alpha[self.lengths, np.arange(len(self.lengths))], 1e-300)
        use = alpha[self.start, self.word] * probability[self.piece] * beta[self.end, self.word]
        return np.bincount(self.piece, use / total[self.word] * counts[self.word], minlength=len(probability))


def lattices(words: list[str], pieces: Pieces, most: int = 400_000) -> Iterator[tuple[np.ndarray, Lattice]]:
    """Numbers of words of up to BLOCK characters and their lattices, by length: a table of places and words stays small."""
    order = sorted((k for k in range(len(words)) if len(words[k]) <= BLOCK), key=lambda k: len(words[k]))
    at = 0
    while at < len(order):
        short, to = len(words[order[at]]) <= SHORT, at + 1
        while to < len(order) and (to - at + 1) * len(words[order[to]]) <= most and (len(words[order[to]]) <= SHORT) == short:
            to += 1
        yield np.array(order[at:to]), Lattice([words[k] for k in order[at:to]], pieces)
        at = to


def log_probability(words: list[str], pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, over all segmentations of the whole word."""
    out = np.zeros((len(words), probability.shape[1]))
    for own, lattice in lattices(words, pieces):
        out[own] = lattice.log_probability(probability)
    for k, w in enumerate(words):
        if len(w) > BLOCK:
            out[k] = long_log_probability(w, pieces, probability)
    return out


def long_log_probability(word: str, pieces: Pieces, probability: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The same for one very long word, some characters at a time.

    What edges that begin in a block give to the places after it is carried on, so no piece is cut.
    """
    span, kinds = pieces.longest, probability.shape[1]
    carry, scale = np.zeros((span + 1, kinds)), np.zeros(kinds)
    carry[0] = 1
    for a in range(0, len(word), block):
        part = word[a : a + block + span]
        size = min(block, len(word) - a)
        x = Lattice([part], pieces)
        own = x.start < size
        start, piece = x.start[own], x.piece[own]
        at = np.searchsorted(x.end[own], np.arange(size + span + 2))
        alpha = np.zeros((size + span + 1, kinds))
        alpha[: span + 1] = carry
        for e in range(1, size + span + 1):
            edges = slice(at[e], at[e + 1])
            alpha[e] += (alpha[start[edges]] * probability[piece[edges]]).sum(axis=0)
            if e % 8 == 0 and e <= size:
                # also what is carried to places ahead
                near = alpha[max(0, e - span + 1) : max(e, span) + 1]
                top = near.max(axis=0)
                top[top == 0] = 1
                near /= top
                scale += np.log(top)
        carry = alpha[size : size + span + 1]
        top = carry.max(axis=0)
        carry, scale = carry / top, scale + np.log(top)
    return np.log(np.maximum(carry[0], 1e-300)) + scale


class Known(dict):
    """Numbers of words; those not met before are noted."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        n = self[word] = len(self)
        return n


class Model:
    def __init__(self, languages: list[str], pieces: dict[str, int], probability: np.ndarray):
        self.languages, self.pieces, self.probability = languages, pieces, probability
        self.forget()
        self.found: Pieces | None = None

    def forget(self) -> None:
        self.known, self.values = Known(), np.empty((0, len(self.languages)))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": Known(), "values": np.empty((0, len(self.languages))), "found": None}

    def learn_words(self) -> None:
        """Score the words that were not met before, many at once."""
        self.found = self.found or Pieces(self.pieces)
        parts = [self.values]
        for a in range(0, len(self.known.new), 20_000):
            new = self.known.new[a : a + 20_000]
            parts.append(log_probability([BEGIN + w for w in new], self.found, self.probability))
        self.values = np.concatenate(parts)
        self.known.new = []

    def totals(self, texts: list[bytes], most: int = 150_000) -> np.ndarray:
        """Log probability of whole texts in each language; words are scored once for many texts."""
        out = np.zeros((len(texts), len(self.languages)))
        held: list[tuple[int, np.ndarray]] = []

        def settle() -> None:
            self.learn_words()
            for k, ids in held:
                out[k] += self.values[ids].sum(axis=0)
            held.clear()
            if len(self.known) > most:
                self.forget()

        size = 0
        for k, text in enumerate(texts):
            for part in slices(text):
                words = words_of(part)
                held.append((k, np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))))
                size += len(words)
                if size > 1 << 20:
                    settle()
                    size = 0
        settle()
        return out

    def predict(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        told = [t is not None and bool(self.languages) and _LETTER.search(t.decode("utf-8", "replace")) is not None for t in texts]
        z = iter(self.totals([t for t, ok in zip(texts, told, strict=True) if ok]) if any(told) else ())
        out = []
        for ok in told:
            if not ok:
                out.append((UNKNOWN, 0.0))
                continue
            row = next(z)
            best = int(np.argmax(row))
            out.append((self.languages[best], float(1 / np.exp(row - row[best]).sum())))
        return out


def fit(counts: dict[str, Counter], pieces: dict[str, int], rounds: int = 4, prior: float = 0.05) -> Model:
    """Piece probabilities of each language from its word counts, by expectation maximisation."""
    names, n, found = sorted(counts), len(pieces) + 1, Pieces(pieces)
    out = np.empty((n, len(names)))
    for k, name in enumerate(names):
        words = sorted(counts[name])
        often = np.array([counts[name][w] for w in words], float)
        p = np.full(n, 1 / n)
        blocks = [(lattice, often[own]) for own, lattice in lattices([BEGIN + w for w in words], found)]
        for _ in range(rounds):
            uses = sum((lattice.expected(p, o) for lattice, o in blocks), np.zeros(n)) + prior
            p = uses / uses.sum()
        out[:, k] = p
    return Model(names, pieces, out)


def learn(docs: DataFrame, vocabulary_path: str, per_language: int = 600, max_bytes: int = 32_768, max_languages: int = 500) -> Model:
    """Fit on a bounded sample: of each language at most ``per_language`` distinct texts of at most ``max_bytes``, by a hash of the text.

    Rows without text or lang teach nothing. More than ``max_languages`` raise an error; so the driver gets at most
    the word counts of per_language * max_bytes bytes for each language.
    """
    prepare(docs.sparkSession)
    fits = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(F.octet_length("text") <= max_bytes)
    fits = fits.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text", F.lit(3)).alias("_h"))
    # copies count once, or a text with many would fill the places of its language
    sizes = fits.select("lang", "_h").distinct().groupBy("lang").agg(F.count("*").alias("n")).limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not sizes:
        return fit({}, vocabulary(vocabulary_path))
    # a share of the hashes that holds a little more than wanted, so no language is ranked whole
    share = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, 1.5 * per_language / r["n"])) for r in sizes], "lang string, share double")
    near = F.shiftrightunsigned("_h", 11).cast("double") / float(1 << 53) <= F.col("share")
    few = fits.join(F.broadcast(share), "lang").where(near).groupBy("lang", "_h").agg(F.min("text").alias("text"))
    ranked = few.withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy("_h", "text")))
    sample = ranked.where(F.col("_rank") <= per_language).select("lang", F.col("text").cast("binary").alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(*next(rows([b], "lang", "text")), strict=True):
                found.setdefault(lang, Counter()).update(w for part in slices(text) for w in words_of(part))
            flat = [(g, w, n) for g, c in found.items() for w, n in c.items()]
            columns = zip(*flat, strict=True) if flat else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], ["lang", "word", "n"])

    words = sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, Counter] = {}
    for lang, word, n in zip(*(words[c].to_pylist() for c in ("lang", "word", "n")), strict=True):
        counts.setdefault(lang, Counter())[word] = n
    return fit(counts, vocabulary(vocabulary_path))


def identify(docs: DataFrame, model: Model, keep_text: bool = True) -> DataFrame:
    """All columns of ``docs`` (the text only if ``keep_text``), with lang_pred and score (posterior of that language, all being as likely before).

    The whole text is read, a bounded part at a time. A null text and one without a letter are ``und`` with score 0, and
    so is every text if no language was learnt. Rows that repeat are judged alike; an empty table gives no rows;
    columns named like an added one are replaced.
    """
    spark = prepare(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)
    kept = others(docs, "lang_pred", "score", *([] if keep_text else ["text"]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            found = m.predict(b.column("text").cast(pa.binary()).to_pylist())
            added = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), *added], [*kept, "lang_pred", "score"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*kept).schema)
    return docs.select(*dict.fromkeys([*kept, "text"])).mapInArrow(run, f"{kinds}lang_pred string, score double")
