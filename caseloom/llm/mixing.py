"""Mixing of sources to target weights, by weighted fair queueing.

Every source serves its documents in a shuffled order, again from the start when it runs out. A copy's virtual
finish time is the number of words its source has served by then, divided by the source's target. At virtual time 1
every source has served exactly its target, so cutting the global order there cuts it at the total budget.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.plans.sizing import materialise

from .common import SPACE, others, prepare, word_count

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def targets(sizes: dict[str | None, int], weights=(5, 2, 1), most: float = 3.0) -> dict[str | None, float]:
    """Words each source should give: shares by weight, none above ``most`` times its size.

    Sources in order of code points, null last, take the weights in turn. What a full source cannot
    give goes to the others by weight, until none is above its limit.
    """
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    left, out, open_ = float(sum(sizes.values())), {}, list(order)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > most * sizes[s]]
        if not full:
            return out | {s: weight[s] * unit for s in open_}
        out |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return out


OWN = ["size", "source_size", "target", "taken", "served", "finish"]


def _order(docs: DataFrame, seed: int) -> list[Column]:
    """The shuffled place of a row, a hash of all its values, the same on every run; and a second hash.

    Both together tell rows apart at any number of them.
    """
    values = [F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    return [F.xxhash64(F.lit(seed + k), *values).alias(name) for k, name in enumerate(_KEY)]


_KEY = ["_order", "_other"]


def _row(names: list[str]) -> Column:
    """The caller's columns in one, so that no name of theirs meets one of ours."""
    return F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("row")


def _unpacked(names: list[str]) -> list[Column]:
    return [F.col("row").getField(c).alias(c) for c in names]


def schedule(docs: DataFrame, weights=(5, 2, 1), most: float = 3.0, seed: int = 11, max_sources: int = 100_000) -> DataFrame:
    """All columns of ``docs`` but the text, and what the mix takes of each row.

    Adds size, source_size, target, taken (words over all copies), served (words of the source up to the end of the
    first copy) and finish (virtual finish time of the first copy, null without a target).

    A null text has no words; a null source is a source of its own; rows that repeat are documents of their own; an
    empty table gives no rows. Texts of any length are counted whole; equal finish times go by doc_id. Columns named
    like an added one are replaced, other names do not matter. Only one row for each source reaches the driver: more
    than ``max_sources`` raise an error.
    """
    kept = others(docs, *OWN, "text")
    return _schedule(docs, kept, weights, most, seed, max_sources).select(*_unpacked(kept), *OWN)


def _schedule(docs: DataFrame, kept: list[str], weights, most: float, seed: int, max_sources: int) -> DataFrame:
    spark = prepare(docs.sparkSession)
    base = docs.select(_row(kept), "doc_id", "source", word_count(F.col("text")).alias("size"), *_order(docs, seed))
    base = materialise(base)
    per_source = base.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(max_sources + 1).collect()
    if len(per_source) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    target = targets({r["source"]: r["size"] for r in per_source}, weights, most)
    # as many slices of a source's order as rows in a slice: neither grows faster than the root of the rows
    known = [(r["source"], i, r["size"], target[r["source"]], max(1, round(r["n"] ** 0.5))) for i, r in enumerate(per_source)]
    sources = spark.createDataFrame(known, "_source string, _sid int, source_size long, target double, _slices long")
    placed = base.join(F.broadcast(sources), base["source"].eqNullSafe(sources["_source"])).drop("_source")
    spot = (F.shiftrightunsigned("_order", 11).cast("double") / float(1 << 53) * F.col("_slices")).cast("long")
    placed = placed.withColumn("_slice", F.least(spot, F.col("_slices") - 1))
    sums = placed.groupBy("_sid", "_slice").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("_sid").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_sid", "_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_sid", "_slice").orderBy(*_KEY, "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("_within", F.sum("size").over(inside)).join(sums, ["_sid", "_slice"])
    served = F.col("_before") + F.col("_within")
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target") - F.col("_rounds") * F.col("source_size")).cast("long")
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - (F.col("served") - F.col("size"))))
    return (
        placed.withColumn("served", served)
        .withColumn("_rounds", rounds.cast("long"))
        .withColumn("taken", F.col("_rounds") * F.col("size") + last)
        .withColumn("finish", F.when(F.col("target") > 0, F.col("served") / F.col("target")))
    )


def mix(docs: DataFrame, weights=(5, 2, 1), most: float = 3.0, seed: int = 11, max_sources: int = 100_000) -> DataFrame:
    """The mixed corpus: a row for every copy taken, in the global order of virtual finish times.

    All columns of ``docs``, then copy (from 0), words taken of it and finish. A copy that the cut falls into keeps its
    first words, joined by single spaces; all others keep their text. Nulls and empty tables as in ``schedule``; columns
    of ``docs`` named like an added one are replaced.
    """
    added = ["copy", "words", "finish"]
    s = _schedule(docs, [], weights, most, seed, max_sources).where("taken > 0")
    copies = F.explode(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1))
    s = s.select(*_KEY, "size", "taken", "source_size", "target", F.col("finish").alias("_first"), copies.alias("copy"))
    s = s.select(
        *_KEY, F.col("size").alias("_size"), "copy",
        F.least("size", F.col("taken") - F.col("copy") * F.col("size")).alias("words"),
        (F.col("_first") + F.col("copy") * F.col("source_size") / F.col("target")).alias("finish"),
    )
    # rows alike in all values share a place and can stand for each other
    names = others(docs, *added)
    texts = docs.select(_row(names), *_order(docs, seed)).dropDuplicates(_KEY)
    joined = texts.join(s, _KEY)
    own = F.col("row").getField(next(c for c in names if c.lower() == "text"))
    parts = F.split(F.regexp_replace(own, f"^{SPACE}+", ""), f"{SPACE}+")
    cut = F.array_join(F.slice(parts, 1, F.col("words").cast("int")), " ")
    text = F.when(F.col("words") < F.col("_size"), cut).otherwise(own)
    out = [text.alias(c) if c.lower() == "text" else F.col("row").getField(c).alias(c) for c in names]
    ids = F.col("row").getField(next(c for c in names if c.lower() == "doc_id"))
    return joined.orderBy("finish", ids, "copy").select(*out, *added)
