"""Hard negatives by slot-decomposed selection.

The scores of an anchor's positives are the upper limits of its windows of negatives. Sorted, they cut all scores into
disjoint slots. Every cell of the work keeps the best few negatives of each slot, whatever window asks for them; the
answer of a window is the merge of its own slot and those below, from the top, down to its lower limit.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.plans.sizing import materialise

from .common import prepare

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NONE = np.iinfo(np.int64).min


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return vector.isNotNull() & ~bad


def matrix(vectors: pa.ChunkedArray, scale: float, width: int) -> np.ndarray:
    """Scaled components rounded down, a row for each vector; short vectors end in zeros."""
    flat = vectors.combine_chunks()
    n = np.diff(flat.offsets.to_numpy())
    values = np.floor(scale * flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(n), width))
    out[np.arange(width) < n[:, None]] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers, as 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    if most < 1 << 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    big = np.array([[int(x) for x in r] for r in a], object).reshape(a.shape) @ np.array([[int(x) for x in r] for r in b], object).reshape(b.shape).T
    if any(not -(1 << 63) < x < 1 << 63 for x in big.ravel()):
        raise OverflowError("an inner product does not fit 64 bits")
    return big.astype(np.int64)


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest of every row but NONE; of equal ones the first columns."""
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        row, col = np.nonzero((scores >= least[:, None]) & (scores > NONE))
    else:
        row, col = np.nonzero(scores > NONE)
    return first(row, (-scores[row, col],), k, col)


def first(group: np.ndarray, order: tuple, k: int, *carried: np.ndarray) -> tuple:
    """Group and carried values of the first k of each group, by ``order`` and then by place."""
    at = np.lexsort((*reversed(order), group))
    g = group[at]
    starts = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else np.empty(0, int)
    rank = np.arange(len(g)) - np.repeat(starts, np.diff(np.append(starts, len(g))))
    at = at[rank < k]
    return group[at], *(c[at] for c in carried)


def _cell(width: int, scale: float, k: int, slots: int, step: int):
    """What one block of rows offers to one block of anchors: the best k of every anchor, or of each of its slots."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        kind = pa.schema([("_a", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("id", rows.schema.field("id").type)])
        if not len(rows) or not len(anchors):
            return kind.empty_table()
        rows = rows.sort_by([("id", "ascending")])
        row_of, label, ids = rows["_row"].to_numpy(), rows["label"], rows["id"].combine_chunks()
        codes = pa.concat_arrays([*label.chunks, *anchors["a_label"].chunks]).dictionary_encode().indices.to_numpy()
        row_label, a_label = codes[: len(rows)], codes[len(rows) :]
        a, a_row = matrix(anchors["a_vector"], scale, width), anchors["_a"].to_numpy()
        limits = np.full((len(anchors), max(slots, 1)), NONE)
        if slots:
            least = anchors["least"].to_numpy()
            flat = anchors["limits"].combine_chunks()
            n = np.diff(flat.offsets.to_numpy())
            limits[np.arange(slots) < n[:, None]] = flat.flatten().to_numpy()
        found: list[tuple] = []
        for at in range(0, len(rows), step):
            part = slice(at, at + step)
            s = products(a, matrix(rows["vector"][part], scale, width))
            same = a_label[:, None] == row_label[None, part]
            if not slots:
                s[~same | (a_row[:, None] == row_of[None, part])] = NONE
                x, y = best(s, k)
                found.append((x, np.zeros(len(x), int), s[x, y], y + at))
                continue
            s[same | (s < least[:, None])] = NONE
            slot = (limits[:, :, None] >= s[:, None, :]).sum(axis=1) - 1
            for j in range(slots):
                mine = np.where(slot == j, s, NONE)
                x, y = best(mine, k)
                found.append((x, np.full(len(x), j), s[x, y], y + at))
        x, slot, score, y = (np.concatenate(c) for c in zip(*found, strict=True))
        # rows are in order of their ids, so the place decides between equal scores
        _, x, slot, score, y = first(x * max(slots, 1) + slot, (-score, y), k, x, slot, score, y)
        return pa.table([pa.array(a_row[x]), pa.array(slot, pa.int32()), pa.array(score), ids.take(pa.array(y))], kind)

    return run


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _grid(rows: DataFrame, anchors: DataFrame, run, kind: str, row_blocks: int, anchor_blocks: int) -> DataFrame:
    """Every block of rows against every block of anchors; a block of either has bounded size."""
    left = rows.select("*", F.pmod("_row", F.lit(row_blocks)).alias("_r"), _each(anchor_blocks).alias("_b"))
    right = anchors.select("*", F.pmod("_a", F.lit(anchor_blocks)).alias("_b"), _each(row_blocks).alias("_r"))
    return left.groupBy("_b", "_r").cogroup(right.groupBy("_b", "_r")).applyInArrow(run, kind)


def _top(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k)


def mine(
    vectors: DataFrame, anchor: Column, vector: str = "embedding", label: Column | str = "label", id: str = "vec_id",
    positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: float = 256.0,
    block_rows: int = 16384, block_anchors: int = 2048,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    An anchor is a row for which ``anchor`` is true; its positives are its best other rows of the same label. For each
    positive, the best ``negatives`` rows of other labels are given whose score is between ``low`` and ``high`` percent of
    the positive's. Scores are exact inner products of components times ``scale``, rounded down; equal scores go by
    smaller id, no id last. Rows with a null label or vector, or a null or non-finite component, take no part. Missing
    components of a shorter vector count as 0. Rows that repeat are rows of their own, repeated anchors give repeated
    results; an anchor without positives, a window without negatives and an empty table give no rows; a score beyond 64
    bits is an error. No other columns are read, so their names do not matter.

    Anchors meet all rows in blocks: a cell holds at most about ``block_rows`` rows and ``block_anchors`` anchors.
    """
    spark = prepare(vectors.sparkSession)
    if high != 100:
        # the upper limit of a window is the largest whole score within it
        upper = F.floor(F.col("score").cast("decimal(38,0)") * high / 100).cast("long")
    else:
        upper = F.col("score")
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.where(label.isNotNull() & usable(F.col(vector))).select(
        F.col(id).alias("id"), label.alias("label"), F.col(vector).alias("vector"), F.coalesce(anchor, F.lit(False)).alias("_is")
    )
    # numbered once it is stored: repeated rows stay apart, and a task that runs again gives the same numbers
    rows = materialise(rows).withColumn("_row", F.monotonically_increasing_id())
    n, n_anchors, width = rows.agg(F.count("*"), F.count_if("_is"), F.max(F.size("vector"))).first()
    kind = rows.schema["id"].dataType.simpleString()
    cells = f"_a long, slot int, score long, id {kind}"
    anchors = rows.where("_is").select(F.col("_row").alias("_a"), F.col("id").alias("anchor_id"), F.col("label").alias("a_label"), F.col("vector").alias("a_vector"))
    rows = rows.drop("_is")
    blocks = (
        max(-(-n // block_rows), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // 256)), 1),
        max(-(-n_anchors // block_anchors), 1),
    )
    step = max(1, min(2048, (1 << 22) // block_anchors))
    found = _grid(rows, anchors, _cell(width or 0, scale, positives, 0, step), cells, *blocks)
    found = _top(found, ["_a"], positives).groupBy("_a")
    entry = F.struct("_n", F.col("score").alias("positive_score"), F.col("id").alias("positive_id"), upper.alias("upper"))
    found = materialise(found.agg(F.array_sort(F.collect_list(entry)).alias("found")))
    # nothing below the lowest window is asked for
    least = F.ceil(F.array_min("found.positive_score").cast("decimal(38,0)") * low / 100).cast("long")
    asked = anchors.join(found, "_a").select("_a", "a_label", "a_vector", F.col("found.upper").alias("limits"), least.alias("least"))
    slots = _grid(rows, asked, _cell(width or 0, scale, negatives, positives, step), cells, *blocks)
    slots = _top(slots, ["_a", "slot"], negatives).groupBy("_a")
    # in the order of the answer: best first, then small ids, none last
    entry = F.struct((-F.col("score")).alias("down"), F.col("id").isNull().alias("none"), "id", "score", "slot")
    slots = slots.agg(F.array_sort(F.collect_list(entry)).alias("offers"))
    asks = found.select("_a", F.posexplode("found").alias("place", "p")).select("_a", "place", "p.positive_id", "p.positive_score")
    asks = asks.join(slots, "_a").join(anchors.select("_a", "anchor_id"), "_a")
    floor = F.col("positive_score").cast("decimal(38,0)") * low
    fits = F.filter("offers", lambda o: (o["slot"] >= F.col("place")) & (o["score"].cast("decimal(38,0)") * 100 >= floor))
    out = asks.select("anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(fits, 1, negatives)).alias("rank", "o"))
    return out.select(
        "anchor_id", "positive_id", (F.col("rank") + 1).alias("rank"), F.col("o.id").alias("negative_id"),
        "positive_score", F.col("o.score").alias("negative_score"),
    )
