"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.plans.session import apply_settings
from caseloom.plans.sizing import materialise

# functions that run in tasks travel with them: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Regular-expression class of the white space that separates words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

SETTINGS = {
    # texts differ in length a thousandfold: few rows for each Arrow batch
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
    "spark.sql.execution.pyspark.udf.simplifiedTraceback.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    apply_settings(spark)
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def others(df: DataFrame, *names: str) -> list[str]:
    """Columns of a table but those named, in whatever case."""
    named = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in named]


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def lower_ascii_word(word: Column) -> Column:
    """A-Z of one word in lower case; other letters stay. Short words take the cheap way."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    ascii_only = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, upper, lower))


def part_of(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts: the split into training and held-out rows."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def rows(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Values of an Arrow stream, one batch of columns at a time, as Python lists."""
    for b in batches:
        yield tuple(b.column(b.schema.get_field_index(c)).to_pylist() for c in columns)


class Hashes(dict):
    """XXH64 of words, kept for words seen before; emptied when it holds too many."""

    def __init__(self, seed: int = 0, most: int = 200_000):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (finaliser of splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd number and of its inverse, modulo 2 to the 64."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = max(n, 4096)
        with np.errstate(over="ignore"):
            up, down = (np.cumprod(np.array([1] + [x] * (size - 1), np.uint64)) for x in (base, pow(base, -1, 1 << 64)))
        _POWERS[base] = up, down
    return _POWERS[base][0][:n], _POWERS[base][1][:n]


def window_hashes(words: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``width`` words, from the hashes of the words: a polynomial by prefix sums."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = powers((0x9E3779B97F4A7C15 + 2 * salt * 0xD1B54A32D192ED03) % (1 << 64) | 1, len(words))
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up)))
        return mixed((sums[width:] - sums[:n]) * down[:n] + np.uint64(salt))


def pack(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as differences, byte plane by byte plane, which block codecs shrink well."""
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def split_sorted(values: np.ndarray, parts: int) -> np.ndarray:
    """Edges of ``parts`` equal ranges of 64-bit numbers within a sorted array."""
    step = -(-(1 << 64) // parts)
    return np.searchsorted(values, np.array([i * step for i in range(1, parts)], np.uint64)) if parts > 1 else np.empty(0, int)


def ranges(values: np.ndarray, parts: int) -> list[tuple[int, int]]:
    edges = [0, *split_sorted(values, parts).tolist(), len(values)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def marked(covered_from: np.ndarray, n: int, width: int) -> np.ndarray:
    """Which of n words lie in a run of ``width`` words that starts at one of the given places."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, covered_from, 1)
    np.add.at(steps, np.minimum(covered_from + width, n), -1)
    return np.cumsum(steps[:-1]) > 0


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def slices(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in slices of about ``size`` bytes, cut at white space only."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + size) if len(data) - at > size else None
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def word_chunks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size; white space is that of bytes.split."""
    return (part.split() for part in slices(data, size))


def connected(edges: DataFrame) -> DataFrame:
    """Components of a graph: (node, root) for every node of ``edges`` (u, v of one orderable type).

    The root is the smallest node of the component. Large and small stars in turn until no edge changes (Kiveris et
    al., 2014); rounds grow with the logarithm of the nodes. Every step is cut by a checkpoint, and both sides of
    every join pass an exchange, so adaptive execution can split the edges of a hub. Only one row per round reaches
    the driver.
    """
    edges = materialise(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = None
    while (now := state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m")))
        edges = materialise(
            both.where("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = materialise(edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k"))
        hung = edges.join(low, F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(hung.unionByName(low.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct())
    # every edge now goes from a node to the root of its component
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
