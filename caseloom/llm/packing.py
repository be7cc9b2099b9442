"""Packing of tokenised documents into sequences, by a grouping genetic algorithm.

Pieces of one length can stand for each other, so a packing is a table of patterns (the lengths in one sequence) and how
often each is used. Its size follows the possible lengths and not the corpus. Islands evolve such tables as Spark tasks:
a crossover injects the well-filled bins of one parent into the other, drops the bins whose pieces are then used twice,
and best-fits the displaced pieces; the best of every island migrates to the next one. The winning table is then dealt
to the pieces by their rank among those of their length.
"""

from __future__ import annotations

import json
import random
import re
import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.plans.sizing import bounded_rows, materialise

from .common import powers, prepare, rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- token ids -------------------------------------------------------------------------------------------------------

LETTER, DIGIT, BLANK, OTHER = range(4)
#: Texts with later code points are left to the library as a whole: their classes depend on its Unicode version.
PLAIN = 0x500
_LATER = re.compile(f"[^\0-{chr(PLAIN - 1)}]")


def _classes() -> np.ndarray:
    import unicodedata

    kinds = {"L": LETTER, "N": DIGIT}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(PLAIN)], np.int8)
    out[[*range(9, 14), 32, 0x85, 0xA0]] = BLANK
    return out


def word_starts(chars: np.ndarray, kind: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the words of byte-level vocabularies begin: contractions, then runs of letters, digits or others with one
    space before them, then white space. ``begins`` are the first places of texts, in order."""
    n = len(chars)
    first = np.zeros(n + 1, bool)
    first[begins] = True
    first[n] = True
    start = first.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    blank = kind == BLANK
    # of white space before a word, the last character is apart, and a space belongs to the word
    before = np.flatnonzero(blank[:-1] & ~blank[1:] & ~first[1:n]) if n > 1 else np.empty(0, int)
    start[before] = True
    start[before[chars[before] == 32] + 1] = False
    # a lone apostrophe that begins a word takes the letters of a contraction along
    at = np.flatnonzero((chars == 39) & start[:n])
    at = at[(at + 1 < n) & ~first[np.minimum(at + 1, n)]]
    one = chars[at + 1]
    two = np.where((at + 2 < n) & ~first[np.minimum(at + 2, n)], chars[np.minimum(at + 2, n - 1)], 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    size = np.where(short, 2, np.where(long, 3, 0))
    at, size = at[size > 0], size[size > 0]
    start[at + 1] = False
    start[at + size] = True
    return np.flatnonzero(start[:n])


class Encoder:
    """Ids of a byte-level vocabulary of the tokenizers library; every distinct word is encoded once.

    Words are found and told apart with numpy, over many texts at once; the library encodes the words it has not seen.
    At most ``most_words`` are remembered, in some 60 bytes each.
    """

    def __init__(self, spec: str, most_words: int = 2_000_000):
        from tokenizers import Tokenizer

        from .tokens import byte_letters

        s = json.loads(spec)
        pre = s["pre_tokenizer"] or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not s["normalizer"]
        if not plain or s["truncation"] or s["padding"] or s["model"].get("dropout"):
            raise ValueError("a byte-level vocabulary without normaliser is needed")
        self.library = Tokenizer.from_str(spec)
        self.special = [t["content"] for t in s["added_tokens"]]
        self.letters = dict(enumerate(byte_letters()))
        self.kind = _classes()
        self.most_words = most_words
        self.forget()

    def forget(self) -> None:
        """No word is known: sorted hashes, a second hash of each to be sure, and where the ids of each word are."""
        self.key, self.check = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.at, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of new words are from now on, and how many each has."""
        ids, size = [], []
        for w in words:
            found = [t.id for t in self.library.model.tokenize(w.encode().decode("latin-1").translate(self.letters))]
            ids += found
            size.append(len(found))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        size = np.array(size, np.int64)
        at = self.used + np.cumsum(size) - size
        self.used += len(ids)
        return at, size

    def look_up(self, key: np.ndarray, check: np.ndarray, word) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of ids of words, from their hashes in order; ``word`` gives the i-th word itself."""
        place = np.searchsorted(self.key, key)
        near = np.minimum(place, max(0, len(self.key) - 1))
        known = (self.key[near] == key) & (self.check[near] == check) if len(self.key) else np.zeros(len(key), bool)
        at, size = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
        at[known], size[known] = self.at[near[known]], self.size[near[known]]
        new = np.flatnonzero(~known)
        if len(new):
            at[new], size[new] = self.learn([word(i) for i in new.tolist()])
            # one hash never stands for two words
            fresh = new[np.concatenate(([True], key[new][1:] != key[new][:-1]))]
            if len(self.key):
                fresh = fresh[self.key[near[fresh]] != key[fresh]]
            if len(self.key) + len(fresh) > self.most_words:
                # what was learnt stays valid for this call
                ids = self.ids
                self.forget()
                self.spare = ids
                return at, size
            for name, values in (("key", key), ("check", check), ("at", at), ("size", size)):
                setattr(self, name, np.insert(getattr(self, name), place[fresh], values[fresh]))
        self.spare = self.ids
        return at, size

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def plain(self, text: str) -> bool:
        return (text.isascii() or _LATER.search(text) is None) and not any(s in text for s in self.special)

    def encode(self, texts: list[str], most: int = 1 << 20) -> list[np.ndarray]:
        """Ids of every text, without special tokens around them."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[tuple[int, str]] = []
        size = 0
        for i, t in enumerate(texts):
            if not self.plain(t):
                out[i].append(self.whole(t))
                continue
            for part in parts(t, most):
                waiting.append((i, part))
                size += len(part)
                if size >= most:
                    self._encode(waiting, out)
                    waiting, size = [], 0
        if waiting:
            self._encode(waiting, out)
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.empty(0, np.uint32) for x in out]

    def _encode(self, waiting: list[tuple[int, str]], out: list[list[np.ndarray]]) -> None:
        waiting = [(i, t) for i, t in waiting if t]
        if not waiting:
            return
        joined = "".join(t for _, t in waiting)
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        begins = np.concatenate(([0], np.cumsum([len(t) for _, t in waiting])))
        start = word_starts(chars, self.kind[chars], begins[:-1])
        edge = np.append(start, len(chars))
        # two hashes of every word tell apart what one might not
        hashes = []
        for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
            up, down = (x[: len(chars)] for x in powers(base, 1 << len(chars).bit_length()))
            with np.errstate(over="ignore"):
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * up)))
                hashes.append((sums[edge[1:]] - sums[start]) * down[start])
        _, first, which = np.unique(hashes[0], return_index=True, return_inverse=True)
        if (hashes[1] != hashes[1][first][which]).any():
            _, first, which = np.unique(np.stack(hashes, 1), axis=0, return_index=True, return_inverse=True)
        begin, stop = start[first].tolist(), edge[first + 1].tolist()
        at, size = self.look_up(hashes[0][first], hashes[1][first], lambda i: joined[begin[i] : stop[i]])
        which = which.ravel()
        at, size = at[which], size[which]
        ends = np.cumsum(size)
        ids = self.spare[np.repeat(at - (ends - size), size) + np.arange(ends[-1])]
        cuts = np.concatenate(([0], ends))[np.searchsorted(start, begins)]
        for (i, _), a, b in zip(waiting, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            out[i].append(ids[a:b])


def parts(text: str, most: int) -> Iterator[str]:
    """A text in parts of about ``most`` characters, cut where a word with a space before it begins."""
    at = 0
    while len(text) - at > 2 * most:
        cut = at + most
        while cut < len(text) - 1 and not (text[cut] == " " and text[cut - 1].isalnum() and text[cut + 1].isalnum()):
            cut += 1
        if cut >= len(text) - 1:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


_ENCODERS: dict[int, Encoder] = {}


def encoder(spec: str) -> Encoder:
    """One encoder for each vocabulary and worker process."""
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def pieces(docs: DataFrame, vocabulary: str, size: int = 2048, end: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece (from 0), start, length, ids_crc32 of every document's pieces; ``ids`` too if wanted.

    A document is its ids by the library, then ``end``. Longer ones than ``size`` are cut so that all pieces but the first
    are full. Null and empty texts are ``end`` alone; rows that repeat are documents of their own; an empty table gives
    no rows; other columns are not read. Special strings inside a text are the library's special tokens.
    """
    spark = prepare(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(spec.value)
        for b in batches:
            (texts,) = next(rows([b], "text"))
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, ids in enumerate(e.encode([t or "" for t in texts])):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                at = 0
                while at < len(ids):
                    n = (len(ids) - at - 1) % size + 1
                    part = ids[at : at + n]
                    row.append(i)
                    piece.append(-(-at // size))
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        kept.append(part.astype(np.int32))
                    at += n
            columns = [b.column(b.schema.get_field_index("doc_id")).take(pa.array(row, pa.int64()))]
            columns += [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, kinds)


# ---- the genetic algorithm -------------------------------------------------------------------------------------------

#: A packing: how often each pattern (lengths in falling order) is used.
Packing = dict[tuple[int, ...], int]


def least(demand: dict[int, int], size: int) -> int:
    """Sequences that any packing needs: the tokens, or the pieces of over half a sequence."""
    tokens = sum(x * n for x, n in demand.items())
    return max(-(-tokens // size), sum(n for x, n in demand.items() if 2 * x > size))


def fitness(p: Packing, size: int) -> tuple[int, float]:
    """Sequences, then how unevenly they are filled: full ones beside empty ones are better than all half full."""
    return sum(p.values()), -sum(n * (sum(k) / size) ** 2 for k, n in p.items())


def fill(demand: dict[int, int], size: int, rng: random.Random, wild: float) -> Packing:
    """New bins for all of ``demand``: the largest piece, then what fits best; at random now and then if ``wild``."""
    left = {x: n for x, n in demand.items() if n > 0}
    order = sorted(left)
    out: Packing = {}
    while order:
        bin_, room, used = [], size, {}
        x = order[-1]
        while True:
            bin_.append(x)
            used[x] = used.get(x, 0) + 1
            room -= x
            k = bisect_left(order, room + 1)
            # a piece that is used up within the bin is passed over
            while k and used.get(order[k - 1], 0) >= left[order[k - 1]]:
                k -= 1
            if not k:
                break
            if wild and rng.random() < wild:
                j = rng.randrange(k)
                x = order[j] if used.get(order[j], 0) < left[order[j]] else order[k - 1]
            else:
                x = _closing(order, left, used, room, k)
        times = min(left[x] // n for x, n in used.items())
        key = tuple(sorted(bin_, reverse=True))
        out[key] = out.get(key, 0) + times
        for x, n in used.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
                del order[bisect_left(order, x)]
    return out


def _closing(order: list[int], left: dict[int, int], used: dict[int, int], room: int, k: int, tries: int = 24) -> int:
    """The next piece for a bin: of a pair that fills it, if one is found soon, else the largest that fits."""

    def free(x: int) -> int:
        return left.get(x, 0) - used.get(x, 0)

    if order[k - 1] == room:
        return room
    for j in range(k - 1, max(-1, k - 1 - tries), -1):
        x = order[j]
        rest = room - x
        if free(x) > 0 and free(rest) > (1 if rest == x else 0):
            return x
    return order[k - 1]


def best_fit(p: Packing, demand: dict[int, int], size: int) -> dict[int, int]:
    """Put pieces into the open bins of ``p``, largest first, each where the least room stays; what is left over."""
    rooms: dict[int, Packing] = {}
    for key, n in p.items():
        if size > sum(key):
            rooms.setdefault(size - sum(key), {})[key] = n
    order = sorted(rooms)
    left = dict(demand)
    for x in sorted(left, reverse=True):
        while left[x]:
            k = bisect_left(order, x)
            if k == len(order):
                break
            room = order[k]
            key, n = rooms[room].popitem()
            if not rooms[room]:
                del rooms[room], order[k]
            times = min(n, left[x])
            new = tuple(sorted((*key, x), reverse=True))
            left[x] -= times
            p[key] -= times
            if not p[key]:
                del p[key]
            p[new] = p.get(new, 0) + times
            for room, key, n in ((room, key, n - times), (room - x, new, times)):
                if n and room:
                    if room not in rooms:
                        rooms[room] = {}
                        insort(order, room)
                    rooms[room][key] = rooms[room].get(key, 0) + n
    return {x: n for x, n in left.items() if n}


def keep_bins(order: Iterable[tuple[tuple[int, ...], int]], left: dict[int, int], into: Packing) -> None:
    """Take over bins in turn, each as often as its pieces are still there."""
    for key, n in order:
        times = min(n, min(left.get(x, 0) // key.count(x) for x in set(key)))
        if times > 0:
            into[key] = into.get(key, 0) + times
            for x in key:
                left[x] -= times


def crossover(a: Packing, b: Packing, demand: dict[int, int], size: int, rng: random.Random, wild: float = 0.02) -> Packing:
    """Inject well-filled bins of ``b`` into ``a``, drop the bins of ``a`` that use a piece twice, best-fit the rest."""
    left, child = dict(demand), {}
    good = sorted(b.items(), key=lambda kn: (-sum(kn[0]), kn[0]))
    good = good[: max(1, int(len(good) * rng.uniform(0.2, 0.8)))]
    keep_bins(((k, n) for k, n in good if rng.random() < 0.8), left, child)
    keep_bins(sorted(a.items(), key=lambda kn: (-sum(kn[0]), rng.random())), left, child)
    # mutation: some of the emptier bins are taken apart again
    for key in sorted(child, key=lambda k: sum(k))[: rng.randrange(1, 4 + len(child) // 20)]:
        for x in key:
            left[x] += child[key]
        del child[key]
    left = best_fit(child, {x: n for x, n in left.items() if n}, size)
    for key, n in fill(left, size, rng, wild).items():
        child[key] = child.get(key, 0) + n
    return child


def _written(p: Packing) -> str:
    return json.dumps([[*k, n] for k, n in sorted(p.items())])


def _read(s: str) -> Packing:
    return {tuple(x[:-1]): x[-1] for x in json.loads(s)}


def evolve(spark: SparkSession, demand: dict[int, int], size: int, islands: int, epochs: int, children: int, population: int, seed: int) -> Packing:
    """The best packing of ``demand`` that the islands find. A packing has some thousands of patterns at most."""
    if not demand:
        return {}
    goal = least(demand, size)

    def generation(epoch: int):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for r in batch.to_pylist():
                    rng = random.Random(f"{seed} {epoch} {r['island']}")
                    group = [_read(x) for x in (r["people"] or [])]
                    if not group:
                        group = [fill(demand, size, rng, 0.0 if i + r["island"] == 0 else 0.15 * i) for i in range(population)]
                    if r["guest"] is not None:
                        group.append(_read(r["guest"]))
                    ranked = sorted(group, key=lambda p: fitness(p, size))[:population]
                    for _ in range(children):
                        if fitness(ranked[0], size)[0] <= goal or len(ranked) < 2:
                            break
                        i, j = rng.sample(range(len(ranked)), 2)
                        ranked.append(crossover(ranked[i], ranked[j], demand, size, rng))
                        ranked = sorted(ranked, key=lambda p: fitness(p, size))[:population]
                    bins, uneven = fitness(ranked[0], size)
                    out.append({"island": r["island"], "people": [_written(p) for p in ranked], "bins": bins, "uneven": uneven})
                yield pa.RecordBatch.from_pylist(out, pa.schema([
                    ("island", pa.int64()), ("people", pa.list_(pa.string())), ("bins", pa.int64()), ("uneven", pa.float64()),
                ]))

        return run

    kinds = "island long, people array<string>, bins long, uneven double"
    state = spark.range(islands, numPartitions=islands).select(F.col("id").alias("island"), F.lit(None).cast("array<string>").alias("people"), F.lit(None).cast("string").alias("guest"))
    best = None
    for epoch in range(epochs):
        state = materialise(state.mapInArrow(generation(epoch), kinds))
        best = state.orderBy("bins", "uneven", "island").select("bins", F.element_at("people", 1).alias("packing")).first()
        if best["bins"] <= goal:
            break
        # the elite of every island visits the next one
        guests = state.select(((F.col("island") + 1) % islands).alias("island"), F.element_at("people", 1).alias("guest"))
        state = state.select("island", "people").join(guests, "island").repartition(islands, "island")
    return _read(best["packing"])


# ---- dealing ---------------------------------------------------------------------------------------------------------


class Places:
    """Sequence and offset of the piece with a given rank among those of its length."""

    def __init__(self, packing: Packing):
        spans, taken, sequence = [], {}, 0
        for key, n in sorted(packing.items(), reverse=True):
            offset = 0
            for x in key:
                spans.append((x, taken.get(x, 0), sequence, offset))
                taken[x] = taken.get(x, 0) + n
                offset += x
            sequence += n
        spans.sort()
        length, rank, self.sequence, self.offset = (np.array(c, np.int64) for c in zip(*spans, strict=True)) if spans else [np.empty(0, np.int64)] * 4
        self.key, self.rank = (length << 44) + rank, rank

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 44) + rank, side="right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


def pack(
    made: DataFrame, size: int = 2048, islands: int = 6, epochs: int = 4, children: int = 12, population: int = 4, seed: int = 13
) -> DataFrame:
    """``made`` (pieces with a ``length`` from 1 to ``size``) with sequence_id and offset, gapless in every sequence.

    Only the count of each length reaches the driver. Pieces are ranked among those of their length by prefix sums over
    parts of the table, so a length that most pieces have is no single task. Ties and repeated rows get places of their
    own; an empty table gives no rows; a length outside its bounds is an error; columns named like an added one are
    replaced, other names do not matter.
    """
    spark = prepare(made.sparkSession)
    kept = [c for c in made.columns if c.lower() not in ("sequence_id", "offset")]
    own = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    table = materialise(made.select(own))
    counts = table.groupBy("row.length").count()
    demand = {r["length"]: r["count"] for r in bounded_rows(counts, size + 1, "lengths")}
    if any(x is None or not 0 < x <= size for x in demand):
        raise ValueError(f"pieces must have 1 to {size} tokens")
    whole = demand.pop(size, 0)
    packing = evolve(spark, demand, size, islands, epochs, children, population, seed)
    if whole:
        packing[(size,)] = whole
    places = spark.sparkContext.broadcast(Places(packing))

    # parts of the stored table are numbered by their partition
    part = F.shiftright(F.monotonically_increasing_id(), 33)
    table = table.select("row", F.col("row.length").alias("_length"), part.alias("_part"), F.monotonically_increasing_id().alias("_place"))
    sums = table.groupBy("_length", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_length", "_part").orderBy("_place")
    ranked = table.withColumn("_n", F.row_number().over(inside)).join(sums, ["_length", "_part"])
    ranked = ranked.select("row", (F.col("_before") + F.col("_n") - 1).alias("_rank"), F.col("_length"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(2).to_numpy(), b.column(1).to_numpy()
            sequence, offset = places.value.of(length, rank)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sequence), pa.array(offset)], ["row", "sequence_id", "offset"])

    kinds = f"row {table.schema['row'].dataType.simpleString()}, sequence_id long, offset long"
    return ranked.mapInArrow(run, kinds).select("row.*", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (all tokens in order) and bounds (where pieces begin) of packed pieces that carry their ids."""
    parts_ = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts_.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.offset").alias("bounds")
    )
