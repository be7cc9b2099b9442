"""SimHash near-duplicates, by ball hashing that meets in the middle.

Two fingerprints that differ in at most r bits meet in a variant that is within half the radius of each. With r = 3 one
of them flips one bit and the other two. They differ in the parity of their bits, so it is enough that the odd one
flips two; and as two of three bits lie in the same 32-bit half, only pairs of bits of one half are needed.

Whoever reaches a variant by the smaller half of the radius is within r bits of all others there, so a variant's
fingerprints are linked to one of these by a star: its pairs need not be listed to be verified.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.plans.sizing import materialise

from .common import connected, prepare, rows, word_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def shingle_hashes(data: bytes, width: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words joined by spaces; of the whole sequence when it is shorter."""
    carried, some = [], False
    for chunk in word_chunks(data):
        words = carried + chunk
        if len(words) >= width:
            some = True
            text = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
            digest = xxhash.xxh64_intdigest
            yield np.fromiter((digest(text[a:b], seed) for a, b in spans), np.uint64, len(words) - width + 1)
        carried = words[max(0, len(words) - width + 1) :]
    if not some and carried:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carried), seed)], np.uint64)


def fingerprint(data: bytes | None, width: int = 3, seed: int = 42) -> int:
    """The fingerprint as a signed 64-bit number: a bit is 1 if set in over half of the hashes."""
    ones, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes((data or b"").lower(), width, seed):
        for a in range(0, len(h), 1 << 16):
            part = h[a : a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, carried columns and fp (signed long) of every row; a text without words (null too) has fingerprint zero."""
    prepare(docs.sparkSession)
    kept = ["doc_id", *carried]
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (texts,) = next(rows([b], "text"))
            fps = pa.array([fingerprint(t, width, seed) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], fps], [*kept, "fp"])

    bare = docs.select(*kept, F.col("text").cast("binary").alias("text"))
    return bare.mapInArrow(run, f"{kinds}fp long")


def flips(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks every fingerprint is flipped by, and those only fingerprints of odd parity need besides."""

    def masks(size: int, among: Iterable[tuple[int, ...]]) -> list[int]:
        return [sum(1 << b for b in c) for c in among if len(c) == size]

    near = [m for size in range(bits // 2 + 1) for m in masks(size, combinations(range(64), size))]
    far: list[int] = []
    if bits % 2:
        far = masks(bits // 2 + 1, combinations(range(64), bits // 2 + 1))
        if bits == 3:
            far = [m for m in far if m < 1 << 32 or not m & 0xFFFFFFFF]
    return np.array(near, np.uint64), np.array(far, np.uint64)


def crowded(fps: DataFrame, bits: int, blocks: int) -> DataFrame:
    """Fingerprints that may have a neighbour: they agree with another in ``blocks - bits`` of the blocks.

    Differing bits touch at most ``bits`` blocks, so no neighbour is lost; a lone fingerprint needs no variants.
    """
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    of_block = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:], strict=True)]
    signed = [int(np.uint64(sum(c)).astype(np.int64)) for c in combinations(of_block, blocks - bits)]
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(signed)]))
    keyed = fps.select("fp", keys.alias("x")).select("fp", "x.k", "x.part")
    shared = keyed.groupBy("k", "part").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a <> b").select("k", "part")
    # each row becomes a thousand next, so few bytes must not end up in one task
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.join(materialise(shared), ["k", "part"], "left_semi").select("fp").repartition(parts, "fp").distinct()


def links(fps: DataFrame, bits: int = 3, blocks: int = 6) -> DataFrame:
    """Edges (u, v) between distinct fingerprints whose components are those of all pairs within ``bits`` bits."""
    if not 0 <= bits <= 4:
        raise ValueError("ball hashing is meant for 0 to 4 bits")
    near, far = flips(bits)

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            odd = fp[np.bitwise_count(fp) % 2 == 1]
            for own, masks, close in ((fp, near, True), (odd, far, False)):
                if len(own) and len(masks):
                    variant = (own[:, None] ^ masks[None, :]).ravel()
                    arrays = [variant.view(np.int64), np.repeat(own, len(masks)).view(np.int64), np.full(len(variant), close)]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["variant", "fp", "close"])

    variants = crowded(fps, bits, blocks).mapInArrow(emit, "variant long, fp long, close boolean")
    # a variant has at most as many fingerprints as there are flips
    met = variants.groupBy("variant").agg(
        F.min(F.when(F.col("close"), F.col("fp"))).alias("u"), F.count("*").alias("n"), F.collect_list("fp").alias("all")
    )
    met = met.where("n > 1 AND u IS NOT NULL").select("u", F.explode("all").alias("v"))
    return met.where("u <> v").distinct()


def near_duplicates(docs: DataFrame, width: int = 3, bits: int = 3, seed: int = 42, blocks: int = 6) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links of at most ``bits`` differing bits).

    One row for every row of ``docs``. Rows of one fingerprint are linked: empty and null texts (fingerprint zero)
    among themselves and with others near zero. A null doc_id is never smaller; a component of null ids only has a
    null component. An empty table gives no rows; other columns are not read. Copies collapse to one fingerprint
    before any join, and ``blocks`` sets how selective the search for lone fingerprints is (more for more rows).
    """
    return components(docs, width, bits, seed, blocks).drop("root")


def components(
    docs: DataFrame, width: int = 3, bits: int = 3, seed: int = 42, blocks: int = 6, carried: tuple[str, ...] = ()
) -> DataFrame:
    """As ``near_duplicates``, with carried columns and root, a fingerprint that names the row's component."""
    rows_ = materialise(fingerprints(docs, width, seed, carried))
    firsts = materialise(rows_.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = connected(links(firsts.select("fp"), bits, blocks))
    merged = firsts.join(materialise(found), F.col("fp") == F.col("node"), "left")
    merged = materialise(merged.select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = materialise(merged.groupBy("root").agg(F.min("first").alias("component_id")))
    labels = materialise(merged.join(least, "root").select(F.col("fp").alias("_fp"), "component_id", "root"))
    return rows_.join(labels, F.col("fp") == F.col("_fp"), "left").drop("_fp")
