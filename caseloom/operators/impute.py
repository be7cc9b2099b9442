"""Imputation of missing dates from the other dates of a case.

For a target date t and a source date s the gap s - t is known on some rows. A missing
gap is drawn from the known gaps of the same region, and a missing t becomes s minus the
drawn gap, taking the source whose gaps vary least.

A draw picks position ``i`` among the sorted known gaps, from 62 bits scaled to their number: any
number of donors is drawn from alike. Gaps are whole days, so the
sorted list is fully described by a histogram: the drawn gap is the one whose
cumulative range holds ``i``. Rows are therefore never sorted or numbered within a
region; a region with a third of all cases costs no more than its few distinct gaps.
Every region has one row of sorted histograms, which is joined once and searched in place,
so a draw moves no row.

Draws depend on the row key, the seed and the pair of dates, so any partitioning, retry or
lost executor gives the same result, and the gaps drawn for one case are unrelated.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import first_above, halvings, let
from ..plans.sizing import hinted, is_small, materialise

# The dates that are imputed and the dates used for it.
TARGETS = ["onsetdate", "episodedate", "reporteddate"]
SOURCES = [
    "phacreporteddate", "reporteddate", "onsetdate", "earliestlabcollectiondate",
    "earliestlabtestresultdate", "episodedate", "earliestdate",
]

# The prime that keeps products in 64 bits.
_PRIME = 2147483647

_PAIR = ["grp", "target", "source"]


def usable_sources(target: str, sources: list[str]) -> list[str]:
    """Sources whose name does not contain the target's name."""
    return [s for s in sources if target.lower() not in s.lower()]


def row_key(id_col: str) -> Column:
    return F.xxhash64(F.col(id_col))


def round_numbers(seed: int, target: str, source: str) -> list[int]:
    """Fixed numbers that tell the draws of one seed and pair of dates from those of others."""
    digest = hashlib.sha256(f"{seed} {target} from {source}".encode()).digest()
    return [int.from_bytes(digest[8 * i : 8 * i + 8], "big") % _PRIME for i in range(4)]


def _bits(key: Column, numbers: list[int]) -> Column:
    """62 bits for a row, as two numbers below the prime: four rounds that each add a square of one half to the other.

    Every round can be undone, so rows with other keys get other bits, and all bits occur.
    """
    low = F.pmod(key.bitwiseAND(0x7FFFFFFF), F.lit(_PRIME))
    start = F.struct(F.pmod(F.shiftright(key, 31), F.lit(_PRIME)).alias("lo"), low.alias("hi"))

    def mix(s: Column, c: Column) -> Column:
        x = (s["hi"] + c) % F.lit(_PRIME)
        return F.struct(s["hi"].alias("lo"), ((s["lo"] + x * x) % F.lit(_PRIME)).alias("hi"))

    return F.aggregate(F.array(*[F.lit(c).cast("long") for c in numbers]), start, mix)


def _position(key: Column, n: Column, numbers: list[int]) -> Column:
    """A position below ``n`` (up to 2**62): the high part of the product of n and the row's bits, in 64-bit steps."""
    n = n.cast("long")
    n_hi, n_lo = F.shiftright(n, 31), n.bitwiseAND(0x7FFFFFFF)

    def scaled(x: Column) -> Column:
        middle = x["hi"] * n_lo + x["lo"] * n_hi
        return x["hi"] * n_hi + F.shiftright(middle + F.shiftright(x["lo"] * n_lo, 31), 31)

    return let(_bits(key, numbers), scaled)


def _pairs(targets: list[str], sources: list[str]) -> list[tuple[str, str]]:
    return [(t, s) for t in targets for s in usable_sources(t, sources)]


def _group(group: str | None, id_col: str) -> Column:
    """The region; without regions a blank that the planner cannot fold, so the join keeps its key."""
    return F.col(group) if group else F.coalesce(F.substring(F.col(id_col).cast("string"), 1, 0), F.lit(""))


def _prepared(df: DataFrame, names: list[str], group: str | None, id_col: str, key: Column | None) -> DataFrame:
    return df.select(
        F.col(id_col),
        _group(group, id_col).alias("grp"),
        (key if key is not None else row_key(id_col)).cast("long").alias("key"),
        *[F.col(c).cast("date").alias(c) for c in dict.fromkeys(names)],
    ).where(F.col("grp").isNotNull())


def _gap(key: Column, seed: int, target: str, source: str, steps: Column | None = None) -> Column:
    """The gap drawn for a row from the histogram of its region, by the steps of a search if they are known."""
    h = F.col(f"h_{target}_{source}")
    at = _position(key, h["donors"], round_numbers(seed, target, source))
    return F.get(h["gaps"], first_above(h["ends"], at, halvings(F.size(h["ends"])) if steps is None else steps))


class _Model:
    """Small tables learnt from the data: gap histograms of the usable pairs by region."""

    def __init__(self, rows: DataFrame, targets: list[str], sources: list[str], min_frac: float):
        self.targets, self.sources = targets, sources
        self.pairs = _pairs(targets, sources)
        entries = [
            F.struct(F.lit(t).alias("target"), F.lit(s).alias("source"), F.datediff(s, t).alias("gap"))
            for t, s in self.pairs
        ]
        # the target paired with itself carries its own days, for the observed range
        entries += [
            F.struct(F.lit(t).alias("target"), F.lit(t).alias("source"), F.unix_date(t).alias("gap"))
            for t in targets
        ]
        hist = (
            rows.select("grp", F.explode(F.array(*entries)).alias("e"))
            .groupBy("grp", "e.target", "e.source", "e.gap")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        self.hist = materialise(hist)
        known = F.col("gap").isNotNull()
        is_pair = F.col("target") != F.col("source")
        of = Window.partitionBy(*_PAIR)
        donors = F.sum(F.when(known, F.col("n")).otherwise(0)).over(of)
        sized = self.hist.withColumns({"n_rows": F.sum("n").over(of), "donors": donors}).where(is_pair)
        usable = sized.where((F.col("n_rows") - F.col("donors")) / F.lit(min_frac) < F.col("n_rows"))
        ends = F.sum("n").over(of.orderBy("gap").rowsBetween(Window.unboundedPreceding, 0))
        #: Known gaps of the usable pairs: count, cumulative count and donors.
        self.known = usable.where(known).withColumn("end", ends)

    def histograms(self) -> DataFrame:
        """One row per region: days of each target, and donors, sorted gaps and their cumulative counts of each pair."""
        listed = self.known.groupBy(*_PAIR, "donors").agg(F.sort_array(F.collect_list(F.struct("gap", "end"))).alias("x"))
        whole = F.struct(
            "donors", F.transform("x", lambda e: e["end"]).alias("ends"), F.transform("x", lambda e: e["gap"]).alias("gaps"),
            halvings(F.size("x")).alias("steps"),
        )
        listed = listed.select(*_PAIR, whole.alias("h"))
        picked = [
            F.any_value(F.when((F.col("target") == t) & (F.col("source") == s), F.col("h")), True).alias(f"h_{t}_{s}")
            for t, s in self.pairs
        ]
        days = self.hist.where("target = source").groupBy("grp").agg(
            *[
                f(F.when(F.col("target") == t, F.date_from_unix_date("gap"))).alias(f"{name}_{t}")
                for t in self.targets
                for name, f in (("lo", F.min), ("hi", F.max))
            ]
        )
        return days.join(listed.groupBy("grp").agg(*picked), "grp", "left")

    def drawn(self, rows: DataFrame, tables: DataFrame, small: bool, seed: int, *, known: bool = True) -> DataFrame:
        """Every gap of every usable pair, drawn where it is missing: ``id, grp, target, source, gap, drawn``.

        Without ``known`` the drawn ones only.
        """
        id_col = rows.columns[0]
        own = F.datediff
        wanted = [
            F.when(
                F.col(f"h_{t}_{s}").isNotNull() if known else F.col(f"h_{t}_{s}").isNotNull() & own(s, t).isNull(),
                F.struct(
                    F.lit(t).alias("target"), F.lit(s).alias("source"),
                    F.coalesce(own(s, t), _gap(F.col("key"), seed, t, s, F.col(f"h_{t}_{s}")["steps"])).alias("gap"),
                    own(s, t).isNull().alias("drawn"),
                ),
            )
            for t, s in self.pairs
        ]
        asked = rows.join(hinted(tables, small), "grp")
        exploded = asked.select(id_col, "grp", F.explode(F.array_compact(F.array(*wanted))).alias("e"))
        return exploded.select(id_col, "grp", "e.target", "e.source", "e.gap", "e.drawn")

    def ranks(self, rows: DataFrame, tables: DataFrame, small: bool, seed: int) -> DataFrame:
        """Usable pairs ordered by the spread (95th less 5th percentile) of the filled gaps."""
        drawn = self.drawn(rows, tables, small, seed, known=False)
        filled = self.known.select(*_PAIR, "gap", "n").unionByName(
            drawn.groupBy(*_PAIR, "gap").agg(F.count(F.lit(1)).alias("n"))
        )
        q = F.percentile("gap", F.array(F.lit(0.05), F.lit(0.95)), F.col("n"))
        spread = filled.groupBy(*_PAIR).agg(q.alias("q")).select(*_PAIR, (F.col("q")[1] - F.col("q")[0]).alias("spread"))
        order = Window.partitionBy("grp", "target").orderBy("spread", "source")
        ranked = spread.withColumn("rank", F.row_number().over(order))
        picked = [
            F.max(F.when((F.col("target") == t) & (F.col("source") == s), F.col("rank"))).alias(f"r_{t}_{s}")
            for t, s in self.pairs
        ]
        return ranked.groupBy("grp").agg(*picked)


def date_deltas(
    df: DataFrame, target: str, sources: list[str], *, group: str | None = None, id_col: str = "phacid",
    key: Column | None = None, seed: int = 0, min_frac: float = 0.5,
) -> DataFrame:
    """Gaps of each usable source to the target, the missing ones filled by draws.

    Runs the jobs of the histogram before it returns.
    """
    rows = _prepared(df, [target, *sources], group, id_col, key)
    model = _Model(rows, [target], sources, min_frac)
    tables = materialise(model.histograms())
    out = model.drawn(rows, tables, is_small(tables), seed).select(id_col, "grp", "source", "gap", "drawn")
    return out.withColumnRenamed("grp", group) if group else out.drop("grp")


def impute_dates(
    df: DataFrame,
    targets: list[str] = TARGETS,
    sources: list[str] = SOURCES,
    *,
    group: str | None = "pt",
    id_col: str = "phacid",
    key: Column | None = None,
    seed: int = 0,
    min_frac: float = 0.5,
    suppress_out_of_range: bool = True,
    suffix: str = "_imputed",
) -> DataFrame:
    """Add an imputed copy of each target date; dates that are present are kept.

    The input is read three times: gap histogram, spread of the filled gaps, result; the first two run before
    the call returns, and their small results are written to the checkpoint folder, so a retry does not start over. The
    result adds columns row by row. The histograms are broadcast while their bytes pass the check; beyond it the table is
    joined to them once, by region, in a shuffle that adaptive execution may split.
    """
    rows = _prepared(df, [*targets, *sources], group, id_col, key)
    model = _Model(rows, targets, sources, min_frac)
    tables = materialise(model.histograms())
    small = is_small(tables)
    if any(sum(1 for t, _ in model.pairs if t == own) > 1 for own in targets):
        ranked = tables.join(model.ranks(rows, tables, small, seed), "grp", "left")
    else:
        # one source needs no ranking
        ranked = tables.withColumns({f"r_{t}_{s}": F.when(F.col(f"h_{t}_{s}").isNotNull(), 1) for t, s in model.pairs})
    per_group = materialise(ranked).withColumnRenamed("grp", "__grp")

    out = df.withColumn("__key", (key if key is not None else row_key(id_col)).cast("long"))
    out = out.withColumn("__own", _group(group, id_col))
    out = out.join(hinted(per_group, small), F.col("__own") == F.col("__grp"), "left")
    days, added = {}, []
    for i, t in enumerate(targets):
        own = F.col(t).cast("date")
        options = [
            F.when(
                own.isNull() & F.col(s).isNotNull() & F.col(f"r_{t}_{s}").isNotNull(),
                F.struct(
                    F.col(f"r_{t}_{s}").alias("rank"),
                    F.date_sub(F.col(s).cast("date"), _gap(F.col("__key"), seed, t, s, F.col(f"h_{t}_{s}")["steps"])).alias("day"),
                ),
            )
            for _, s in ((a, b) for a, b in model.pairs if a == t)
        ]
        days[f"__day{i}"] = F.coalesce(own, F.array_min(F.array(*options))["day"]) if options else own
        value = F.col(f"__day{i}")
        if suppress_out_of_range:
            value = F.when(value.between(F.col(f"lo_{t}"), F.col(f"hi_{t}")), value)
        added.append(F.when(F.col("__own").isNotNull(), value).alias(f"{t}{suffix}"))
    # drawn in a projection of their own, once for each row however often the range looks at them
    return out.withColumns(days).select(*[F.col(f"`{c}`") for c in df.columns], *added)


def imputed_date(df: DataFrame, target: str, sources: list[str], **kw) -> DataFrame:
    """Impute one date over the whole table."""
    return impute_dates(df, [target], sources, group=None, **kw)
