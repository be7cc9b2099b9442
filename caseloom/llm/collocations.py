"""Phrases that occur often, and how strongly their words belong together.

Frequent phrases are found by Misra-Gries summaries, one for each range of phrase hashes. A summary has more counters than
its share of all occurrences divided by the threshold, so whatever it takes from a counter stays below the threshold and
no frequent phrase is lost. Tasks send exact local counts, which are summaries too, and merge without loss. Longer phrases
are only looked at where shorter ones survived. A second pass over the texts counts the survivors exactly.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.plans.sizing import broadcast_if_small, materialise

from .common import mixed, pack, powers, prepare, rows, slices, unpack

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD, BLANK, BREAK = range(3)
_KIND = np.zeros(256, np.int8)
_KIND[[32, 9]] = BLANK
_KIND[[*b".,;:!?\n\v\f\r"]] = BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Words:
    """The words of many texts: where they are, which may follow each other, and hashes that include the language."""

    def __init__(self, texts: list[tuple[bytes, int, int]], salts: list[int]):
        """Texts with the bytes that are only context of what follows, and the number of their language."""
        data = np.frombuffer(b"\n".join(t for t, _, _ in texts) + b"\n", np.uint8)
        self.bytes = _LOWER[data]
        kind = _KIND[self.bytes]
        word = np.concatenate(([0], (kind == WORD).view(np.int8), [0]))
        edge = np.diff(word)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kind == BREAK, dtype=np.int32)[self.start]
        begins = np.cumsum([0, *(len(t) + 1 for t, _, _ in texts[:-1])])
        text = np.searchsorted(begins, self.start, side="right") - 1
        self.lang = np.array([x for _, _, x in texts], np.int32)[text]
        self.fresh = self.start >= (begins + np.array([c for _, c, _ in texts]))[text]
        self.salt = np.array(salts, np.uint64)[self.lang]
        self.hash = self.hashes(0)

    def hashes(self, which: int) -> np.ndarray:
        up, down = powers(_BASES[which], 1 << len(self.bytes).bit_length())
        with np.errstate(over="ignore"):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * up[: len(self.bytes)])))
            return mixed((sums[self.end] - sums[self.start]) * down[self.start] + self.salt)

    def grams(self, n: int, shorter: np.ndarray | None, words: np.ndarray) -> np.ndarray:
        """Hash of the n words from every place, from those of n - 1; of places too near the end, there are none."""
        if n == 1:
            return words
        with np.errstate(over="ignore"):
            return mixed(shorter[: len(shorter) - 1] * np.uint64(0xD6E8FEB86659FD93) + words[n - 1 :]) if len(shorter) else shorter

    def together(self, n: int) -> np.ndarray:
        """Whether the n words from a place are in one piece, and the last one is not only context."""
        m = len(self.start) - n + 1
        if m <= 0:
            return np.empty(0, bool)
        return (self.piece[:m] == self.piece[n - 1 :]) & self.fresh[n - 1 :]

    def text(self, i: int, n: int) -> str:
        return b" ".join(self.bytes[self.start[i] : self.end[i + n - 1]].tobytes().split()).decode()


def chunks(batches: Iterable[pa.RecordBatch], longest: int, size: int = 1 << 19) -> Iterator[tuple[Words, list[str]]]:
    """Words of a stream of texts, some MB at a time; a long text goes on with its last words as context."""
    langs: dict[str, int] = {}
    waiting: list[tuple[bytes, int, int]] = []
    held = 0

    def take() -> tuple[Words, list[str]]:
        names = list(langs)
        return Words(waiting, [xxhash.xxh64_intdigest(x.encode(), 7) for x in names]), names

    for b in batches:
        for text, lang in zip(*next(rows([b], "text", "lang")), strict=True):
            code = langs.setdefault("und" if lang is None else lang, len(langs))
            before = b""
            for part in slices((text or "").encode(), size):
                waiting.append((before + part, len(before), code))
                held += len(part)
                tail = part.rsplit(None, longest - 1)
                before = part[len(tail[0]) :] if len(tail) == longest else before + part
                if held >= size:
                    yield take()
                    waiting, held = [], 0
    if waiting:
        yield take()


class Bitmap:
    """Which hashes may be in a set: a bit for each slot, some bits for each member, at most 32 MB in all."""

    def __init__(self, hashes: DataFrame, members: int, most_bits: int = 28):
        self.shift = 64 - min(most_bits, max(10, (32 * members).bit_length()))
        slot = F.shiftrightunsigned("hash", self.shift)
        words = hashes.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
        words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
        got = words.toArrow()
        self.bits = np.zeros(1 << max(0, 64 - self.shift - 6), np.uint64)
        self.bits[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> np.uint64(self.shift)
        return (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def alive(w: Words, n: int, maps: dict[int, Bitmap], cache: dict) -> np.ndarray:
    """Places whose n words may be a frequent phrase, judged by the words and pairs that survived."""
    if n not in cache:
        ok = w.together(n)
        if n == 1:
            cache[n] = ok
        else:
            # of the two phrases with a word less; without regard to context, which they may begin in
            a, b = (alive_before(w, n - 1, maps, cache)[k : k + len(ok)] for k in (0, 1))
            cache[n] = ok & a & b
    return cache[n]


def alive_before(w: Words, n: int, maps: dict[int, Bitmap], cache: dict) -> np.ndarray:
    """Places whose n words survived, as far as is known."""
    key = ("before", n)
    if key not in cache:
        if n in maps:
            cache[key] = maps[n].has(gram_hashes(w, n, cache))
        elif n == 1:
            cache[key] = np.ones(len(w.start), bool)
        else:
            a = alive_before(w, n - 1, maps, cache)
            cache[key] = a[:-1] & a[1:]
    return cache[key]


def gram_hashes(w: Words, n: int, cache: dict, which: int = 0) -> np.ndarray:
    key = ("hash", which, n)
    if key not in cache:
        first = ("hash", which, 1)
        if first not in cache:
            cache[first] = w.hash if which == 0 else w.hashes(which)
        if n > 1:
            cache[key] = w.grams(n, gram_hashes(w, n - 1, cache, which), cache[first])
    return cache[key]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, int)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def merge(summary: tuple[np.ndarray, np.ndarray, int], keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A Misra-Gries summary (keys, counts, what was taken from them) with another one merged into it."""
    k, c = summed(np.concatenate((summary[0], keys)), np.concatenate((summary[1], counts)))
    taken = summary[2]
    if len(k) > capacity:
        # as many occurrences go for every key as the first one beyond the capacity has
        cut = int(np.partition(c, len(c) - capacity - 1)[len(c) - capacity - 1])
        stay = c > cut
        k, c, taken = k[stay], c[stay] - cut, taken + cut
    return k, c, taken


LIST = "part long, keys binary, counts binary"
_LIST = pa.schema([("part", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _counts_out(c: np.ndarray) -> bytes:
    """Counts byte plane by byte plane: most planes are zeros, which codecs shrink to nothing."""
    return np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _counts_in(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.int64)


def _lists(keys: np.ndarray, counts: np.ndarray, parts: int, low: int = 0, high: int = 1 << 64) -> pa.RecordBatch:
    """Counts dealt to equal ranges of the hashes from low to high."""
    step = -(-(high - low) // parts)
    edges = np.searchsorted(keys, np.array([low + i * step for i in range(1, parts)], np.uint64)) if parts > 1 else np.empty(0, int)
    cuts = [0, *edges.tolist(), len(keys)]
    spans = [(i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
    columns = [pa.array([i for i, _, _ in spans], pa.int64()), pa.array([pack(keys[a:b]) for _, a, b in spans], pa.binary())]
    return pa.RecordBatch.from_arrays([*columns, pa.array([_counts_out(counts[a:b]) for _, a, b in spans], pa.binary())], schema=_LIST)


def survivors(docs: DataFrame, orders: tuple[int, ...], maps: dict[int, Bitmap], threshold: int, parts: int, longest: int, held: int, fan: int) -> DataFrame:
    """Hashes of all phrases of the given lengths that may occur ``threshold`` times: a Misra-Gries summary for each of
    ``parts`` ranges. Beyond ``fan`` ranges the counts take two steps, so that no task cuts its lists into crumbs."""
    sent = docs.sparkSession.sparkContext.broadcast(maps)
    first = min(parts, fan)
    second = -(-parts // first)

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            return _lists(*summed(np.concatenate(keys), np.concatenate(counts)), first)

        for w, _ in chunks(batches, longest):
            cache: dict = {}
            found = [gram_hashes(w, n, cache)[alive(w, n, sent.value, cache)] for n in orders]
            k, c = np.unique(np.concatenate(found), return_counts=True)
            keys.append(k)
            counts.append(c)
            size += len(k)
            if size >= held:
                k, c = summed(np.concatenate(keys), np.concatenate(counts))
                keys, counts, size = [k], [c], len(k)
                if size >= held // 2:
                    yield flush()
                    keys, counts, size = [], [], 0
        if size:
            yield flush()

    def split(key: tuple, lists: pa.Table) -> pa.Table:
        """Lists of one coarse range, merged and cut into its fine ranges."""
        p, step = key[0].as_py(), -(-(1 << 64) // first)
        k, c = summed(*_joined(lists))
        out = _lists(k, c, second, p * step, min((p + 1) * step, 1 << 64))
        return pa.table([pa.array(out["part"].to_numpy() + p * second), out["keys"], out["counts"]], _LIST)

    def frequent(lists: pa.Table) -> pa.Table:
        capacity = sum(int(_counts_in(c).sum()) for c in lists["counts"].to_pylist()) // threshold + 1
        summary = np.empty(0, np.uint64), np.empty(0, np.int64), 0
        waiting, size = [], 0
        for a, b in zip(lists["keys"].to_pylist(), lists["counts"].to_pylist(), strict=True):
            waiting.append((unpack(a), _counts_in(b)))
            size += len(waiting[-1][0])
            if size >= max(capacity, held // 2):
                summary = merge(summary, *map(np.concatenate, zip(*waiting, strict=True)), capacity)
                waiting, size = [], 0
        if waiting:
            summary = merge(summary, *map(np.concatenate, zip(*waiting, strict=True)), capacity)
        k, c, taken = summary
        return pa.table([pa.array(k[c + taken >= threshold].view(np.int64))], ["hash"])

    sent_lists = docs.mapInArrow(local, LIST)
    if second > 1:
        groups = F.pmod(F.xxhash64("keys"), F.lit(max(1, second // 8)))
        sent_lists = sent_lists.withColumn("group", groups).groupBy("part", "group").applyInArrow(split, LIST)
    return sent_lists.groupBy("part").applyInArrow(frequent, "hash long")


def _joined(lists: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([unpack(x) for x in lists["keys"].to_pylist()]), np.concatenate([_counts_in(x) for x in lists["counts"].to_pylist()])


def phrase_counts(docs: DataFrame, threshold: int = 100, longest: int = 5, part_bytes: int = 8 << 20, held: int = 1 << 21, fan: int = 2048) -> DataFrame:
    """lang, phrase, words, f: every phrase of up to ``longest`` words that occurs ``threshold`` times in its language,
    and a row of no words with the number of all words of the language (null phrase).

    Counts are exact and told apart by the phrase itself; hashes only decide which phrases are counted.
    """
    spark = prepare(docs.sparkSession)
    # private names first, so that others of the table do not matter
    docs = docs.select(F.col("text"), F.col("lang").cast("string").alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    maps: dict[int, Bitmap] = {}
    for orders in ((1,), (2,), tuple(range(3, longest + 1))):
        orders = tuple(n for n in orders if n <= longest)
        if orders:
            found = materialise(survivors(docs, orders, maps, threshold, parts, longest, held, fan))
            bitmap = Bitmap(found, found.count())
            maps = maps | dict.fromkeys(orders, bitmap)
    sent = spark.sparkContext.broadcast(maps)
    first = min(parts, fan)
    second = -(-parts // first)
    kind = pa.schema([("lang", pa.string()), ("part", pa.int64()), ("phrases", pa.string()), ("counts", pa.binary())])

    def spot(phrase: str) -> int:
        return xxhash.xxh64_intdigest(phrase.encode(), 3)

    def listed(counts: dict[tuple, int], part) -> pa.RecordBatch:
        lists: dict[tuple, tuple[list, list]] = {}
        for (lang, phrase), n in counts.items():
            at = lists.setdefault((lang, part(phrase)), ([], []))
            at[0].append(phrase)
            at[1].append(n)
        columns = [[k[0] for k in lists], [k[1] for k in lists], ["\n".join(p) for p, _ in lists.values()]]
        columns.append([_counts_out(np.array(n, np.int64)) for _, n in lists.values()])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

    def added(lists: pa.Table) -> dict[str, int]:
        sums: dict[str, int] = {}
        for phrases, c in zip(lists["phrases"], lists["counts"], strict=True):
            for p, n in zip(phrases.as_py().split("\n"), _counts_in(c.as_py()).tolist(), strict=True):
                sums[p] = sums.get(p, 0) + n
        return sums

    def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lists of phrases and their counts, by language and range of the hash: few rows, however many phrases."""
        counts: dict[tuple, int] = {}

        for w, langs in chunks(batches, longest):
            cache: dict = {}
            for code, c in enumerate(np.bincount(w.lang[w.fresh], minlength=len(langs)).tolist()):
                counts[langs[code], ""] = counts.get((langs[code], ""), 0) + c
            for n in range(1, longest + 1):
                at = np.flatnonzero(alive(w, n, sent.value, cache))
                h = gram_hashes(w, n, cache)[at]
                keep = sent.value[n].has(h)
                at, h = at[keep], h[keep]
                if not len(at):
                    continue
                _, one, which, c = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                other = gram_hashes(w, n, cache, 1)[at]
                if (other != other[one][which]).any():
                    _, one, c = np.unique(np.stack((h, other), 1), axis=0, return_index=True, return_counts=True)
                for i, m in zip(at[one].tolist(), c.tolist(), strict=True):
                    key = langs[w.lang[i]], w.text(i, n)
                    counts[key] = counts.get(key, 0) + m
            if len(counts) > 300_000:
                yield listed(counts, lambda p: spot(p) % first)
                counts = {}
        if counts:
            yield listed(counts, lambda p: spot(p) % first)

    def split(key: tuple, lists: pa.Table) -> pa.Table:
        """Lists of one language and coarse part, merged and cut into its fine parts."""
        lang, own = key[0].as_py(), key[1].as_py()
        sums = {(lang, p): n for p, n in added(lists).items()}
        return pa.Table.from_batches([listed(sums, lambda p: own + first * (spot(p) // first % second))], kind)

    def total(lists: pa.Table) -> pa.Table:
        found = [(p, p.count(" ") + 1 if p else 0, n) for p, n in added(lists).items() if n >= threshold or not p]
        lang = [lists["lang"][0].as_py()] * len(found)
        columns = [lang, [p or None for p, _, _ in found], [w for _, w, _ in found], [n for _, _, n in found]]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "phrase", "words", "f"])

    kinds = "lang string, part long, phrases string, counts binary"
    found = docs.mapInArrow(exact, kinds)
    if second > 1:
        groups = F.pmod(F.xxhash64("phrases"), F.lit(max(1, second // 8)))
        found = found.withColumn("group", groups).groupBy("lang", "part", "group").applyInArrow(split, kinds)
    return found.groupBy("lang", "part").applyInArrow(total, "lang string, phrase string, words int, f long")


def _whole(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def collocations(
    docs: DataFrame, threshold: int = 100, longest: int = 5, most: int = 2000, part_bytes: int = 8 << 20, held: int = 1 << 21, fan: int = 2048
) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score, words: the ``most`` best phrases of every language.

    Texts are split at ``.,;:!?`` and line ends, in lower case (A-Z); phrases of 2 to ``longest`` words do not cross these.
    a counts a phrase, l and r the parts of its weakest cut, n all words of the language; score = floor(1000 a n / (l r)),
    the lowest over all cuts, of equal ones the first. Phrases always within one longer frequent phrase are left out. A
    null text is empty, a null language is ``und``; rows that repeat count again; texts of any length are read whole;
    an empty table gives no rows; no other columns are read. Ties in rank go by frequency, then by the bytes of the phrase.
    """
    counts = materialise(phrase_counts(docs, threshold, longest, part_bytes, held, fan))
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    part = counts.where("words > 0").select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias("_f"))
    part = broadcast_if_small(part)
    phrases = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def piece(start: Column, n: Column) -> Column:
        return F.array_join(F.slice("w", start, n), " ")

    # a phrase lies in a longer one of the same count only if it does in one with a word more
    one = F.lit(1)
    longer = phrases.where("words > 2").select(
        "lang", F.explode(F.array(piece(one, F.col("words") - 1), piece(one + 1, F.col("words") - 1))).alias("phrase"), F.col("a").alias("longer")
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    phrases = phrases.join(longer, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    cuts = phrases.select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(one, F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", piece(one, F.col("k")).alias("left"), piece(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(part, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).drop("_lang", "_part").withColumnRenamed("_f", name)
    cuts = cuts.join(broadcast_if_small(totals), "lang")
    cuts = cuts.withColumns({"_up": _whole(F.col("a")) * F.col("n") * 1000, "_down": _whole(F.col("l")) * F.col("r")})
    cuts = cuts.withColumn("score", F.expr("_up div _down"))
    lowest = cuts.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    order = F.col("c.score").desc(), F.col("a").desc(), F.col("phrase")
    # the best of some parts of a language first, so that its last task reads a bounded number of rows
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    lowest = lowest.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= most)
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = lowest.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "c.l", "c.r", "n", "c.score", "words")
