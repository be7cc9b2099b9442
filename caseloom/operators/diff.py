"""Comparison of two sources of the same cases."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_str, lower_names
from ..plans.sizing import bounded_rows, hinted, is_small, materialise, null_safe
from .derive import age_group10

KEYS = ["pt", "ptcaseid"]
REPORT = ["phacid", "pt", "ptcaseid", "phacreporteddate", "classification"]

# The symptom and diagnosis names used by the widened tables.
SYMPTOM_NAMES = {
    1: "asymptomatic", 2: "cough", 3: "fever", 4: "chills", 5: "sorethroat", 6: "runnynose",
    7: "shortnessofbreath", 8: "nausea", 9: "headache", 10: "weakness", 11: "pain", 12: "irritability",
    13: "diarrhea", 35: "other",
}


def long_to_wide(
    df: DataFrame, names: dict[int, str] | DataFrame, *, id_col: str, value_col: str, prefix: str,
    key: str = "phacid", unnamed: str = "na",
) -> DataFrame:
    """One row per case, one column per named item, and one for all items without a name.

    ``names`` are numbers and their names, or a lookup table whose first two columns are these. With known names there
    is no job to discover them, no lookup join and no pivot: conditional maxima that combine before the
    shuffle. Items that the names miss share the column ``<prefix>na``, so nothing is dropped.
    """
    if isinstance(names, DataFrame):
        names = names_from_lookup(names, *names.columns[:2])
    number = F.col(id_col)
    picked = []
    for item, name in names.items():
        label = re.sub(r"[^0-9a-z]+", "_", f"{prefix}{name}".lower())
        picked.append(F.max(F.when(number == item, F.col(value_col))).alias(label))
    missed = ~F.coalesce(number.isin(*names), F.lit(False)) if names else F.lit(True)
    return df.groupBy(key).agg(*picked, F.max(F.when(missed, F.col(value_col))).alias(f"{prefix}{unnamed}"))


def symptoms_wide(df: DataFrame, names: dict[int, str] | DataFrame = SYMPTOM_NAMES) -> DataFrame:
    out = long_to_wide(df, names, id_col="symptomid", value_col="symptomvalue", prefix="sym")
    return out.withColumnRenamed("symasymptomatic", "asymptomatic")


def diagnoses_wide(df: DataFrame, names: dict[int, str] | DataFrame) -> DataFrame:
    return long_to_wide(df, names, id_col="diagnosisid", value_col="diagnosisvalue", prefix="dx")


def names_from_lookup(df: DataFrame, id_col: str, name_col: str, *, most: int = 2000) -> dict[int, str]:
    """Names from a lookup table. Each becomes a column, so more than ``most`` are an error."""
    rows = bounded_rows(df.select(id_col, name_col).where(F.col(id_col).isNotNull() & F.col(name_col).isNotNull()), most, "names in a lookup")
    return dict(sorted((r[0], r[1]) for r in rows))


def normalise_second(df: DataFrame) -> DataFrame:
    """``not collected`` becomes blank in all text, an unknown disposition too."""
    out = []
    for f in df.schema.fields:
        x = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            x = F.when(x == "not collected", F.lit("")).otherwise(x)
            if f.name.lower() == "disposition":
                x = F.when(x == "unknown", F.lit("")).otherwise(x)
        out.append(x.alias(f.name))
    return df.select(*out)


def normalise_first(df: DataFrame) -> DataFrame:
    """Lower-case names and text."""
    df = lower_names(df)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[F.lower(c).alias(c) if c in text else F.col(c) for c in df.columns])


def missing_rows(df: DataFrame, other: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``; missing key parts match each other."""
    a, b = df.select(*REPORT), other.select(*keys)
    return a.join(b, null_safe(a, b, keys), "left_anti")


def columns_diff(first: DataFrame, second: DataFrame, *, counts: bool = True) -> DataFrame:
    """Where each column name occurs, and, if asked for, how many rows of either source fill it.

    Without ``counts`` only the schemas are read.
    """
    a, b = set(first.columns), set(second.columns)
    where = {c: "both" if c in a and c in b else "first only" if c in a else "second only" for c in [*first.columns, *second.columns]}
    if not counts:
        return first.sparkSession.createDataFrame(list(where.items()), "colname string, found_in string")

    def filled(df: DataFrame, side: str) -> DataFrame:
        row = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
        cells = F.array(*[F.struct(F.lit(c).alias("colname"), F.col(c).alias(side)) for c in df.columns])
        return row.select(F.explode(cells).alias("e")).select("e.*")

    found = F.when(F.col("colname").isin(*(a & b)), F.lit("both")).when(
        F.col("colname").isin(*a), F.lit("first only")
    )
    both = filled(first, "filled_first").join(filled(second, "filled_second"), "colname", "full")
    return both.select(
        "colname", found.otherwise(F.lit("second only")).alias("found_in"), "filled_first", "filled_second"
    )


def repeated_keys(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Keys that occur more than once, with their number of rows; missing parts count as a value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def ambiguous_keys(first: DataFrame, second: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Keys that repeat in either source, with their rows in both: what :func:`cell_diff` leaves out.

    Only keys are read, and they are counted before the shuffle, so a key that holds most rows costs no more.
    """
    sides = [
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_first" if k == 0 else "n_second"))
        for k, df in enumerate((first, second))
    ]
    # missing key parts are told apart by a flag, as an outer join on null-safe keys would not be an equi-join
    a, b = (s.select(*[F.col(k).alias(f"{k}_{i}") for k in keys], s.columns[-1]) for i, s in enumerate(sides))
    on = reduce(lambda x, y: x & y, [a[f"{k}_0"].eqNullSafe(b[f"{k}_1"]) for k in keys])
    either = a.join(b, on, "full").select(
        *[F.when(F.col("n_first").isNotNull(), F.col(f"{k}_0")).otherwise(F.col(f"{k}_1")).alias(k) for k in keys],
        *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in ("n_first", "n_second")],
    )
    return either.where("n_first > 1 OR n_second > 1")


def common_columns(first: DataFrame, second: DataFrame) -> list[str]:
    return sorted(set(first.columns) & set(second.columns))


def _alike(first: DataFrame, second: DataFrame, columns: list[str]) -> list[str]:
    """Columns that both sources hold in the same type, in which equal values have equal digests."""
    a, b = dict(first.dtypes), dict(second.dtypes)
    return [c for c in columns if a[c] == b[c] and a[c] not in ("float", "double") and not a[c].startswith(("map", "variant"))]


def _key_digest(keys: list[str]) -> Column:
    """Digest of a key; a missing part is told from others."""
    return F.xxhash64(F.lit(0), *[x for k in keys for x in (F.col(k), F.col(k).isNull())])


def changed_keys(
    first: DataFrame, second: DataFrame, keys: list[str] = KEYS, cols: list[str] | None = None, *, ranges: int = 4096
) -> DataFrame:
    """Digests of the keys whose rows are not the same in both sources: ``_key``, and their rows in either.

    Two levels: the digests of all rows are summed by range of the key on both sides, and only within ranges that differ
    do row digests meet. Wide rows are not moved. A key in one source only, or whose repeated rows cancel out, is left
    out, as is a difference of two rows that share 96 bits. Keys whose types differ take no part in the digest.
    """
    cols = cols if cols is not None else [c for c in common_columns(first, second) if c not in {"phacid", *keys}]
    known, native = _alike(first, second, keys), set(_alike(first, second, cols))

    def digests(df: DataFrame, side: int) -> DataFrame:
        cells = [x for c in cols for v in [F.col(c) if c in native else F.col(c).cast("string")] for x in (v, v.isNull())]
        row = df.select(_key_digest(known).alias("_key"), F.xxhash64(F.lit(1), *cells).alias("x"), F.hash(F.lit(2), *cells).alias("y"))
        # the key is part of the digest: rows that change places do not cancel out
        return row.select("_key", F.xxhash64("_key", "x").alias("x"), F.hash("_key", "y").alias("y"), F.lit(side).alias("side"))

    def apart(df: DataFrame, *by: Column | str) -> DataFrame:
        sums = df.groupBy(*by).agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), *[F.count_if(F.col("side") == k).alias(f"n_{k}") for k in (0, 1)])
        return sums.where("x <> 0 OR y <> 0")

    rows = materialise(digests(first, 0).unionByName(digests(second, 1)))
    spot = F.pmod("_key", F.lit(ranges)).alias("_range")
    # at most as many rows as ranges
    differ = materialise(apart(rows, spot).select("_range"))
    inside = rows.withColumn("_range", spot).join(F.broadcast(differ), "_range", "left_semi")
    return apart(inside, "_key").where("n_0 > 0 AND n_1 > 0").select("_key", "n_0", "n_1")


def cell_diff(
    first: DataFrame, second: DataFrame, keys: list[str] = KEYS, *, match_missing: bool = True, ranges: int = 4096
) -> DataFrame:
    """Cells that both sources fill with different values, cleaned for display.

    Digests find the keys whose rows differ (see :func:`changed_keys`), before the call returns; only their wide rows are
    joined, once, whatever the number of columns, and the differing cells of a row are picked from an array in place. A
    row is compared with the one row that has its key: keys that repeat in either source, and so do not say which rows
    belong together, are left out and listed by :func:`ambiguous_keys`. Missing key parts match each other unless
    ``match_missing`` is off.
    """
    skip = {"phacid", *keys}
    cols = [c for c in common_columns(first, second) if c not in skip]
    a_types, b_types = dict(first.dtypes), dict(second.dtypes)
    changed = materialise(changed_keys(first, second, keys, cols, ranges=ranges)) if cols else None
    if changed is not None and not changed.isEmpty():
        of = _key_digest(_alike(first, second, keys))

        def only(df: DataFrame, found: DataFrame) -> DataFrame:
            few = hinted(found.select(F.col("_key").alias("_found")), is_small(found))
            return df.join(few, of == F.col("_found"), "left_semi")

        twice = changed.where("n_0 > 1 OR n_1 > 1")
        if not twice.isEmpty():
            parts = only(first, twice), only(second, twice)
            ambiguous = materialise(ambiguous_keys(*parts, keys).select(*[F.col(k).alias(f"{k}__x") for k in keys]))
            few = hinted(ambiguous, is_small(ambiguous))
            first, second = (
                df.join(few, reduce(lambda x, y: x & y, [df[k].eqNullSafe(few[f"{k}__x"]) for k in keys]), "left_anti")
                for df in (first, second)
            )
        first, second = only(first, changed), only(second, changed)
    elif changed is not None:
        # nothing is read again
        first, second = first.where(F.lit(False)), second.where(F.lit(False))
    a = first.select(*[F.col(k).alias(k) for k in keys], F.col("phacid").alias("phacid_orig"),
                     *[F.col(c).alias(f"{c}_orig") for c in cols])
    b = second.select(*[F.col(k).alias(f"{k}__b") for k in keys], F.col("phacid").alias("phacid_meta"),
                      *[F.col(c).alias(f"{c}_meta") for c in cols])
    on = [
        a[k].eqNullSafe(b[f"{k}__b"]) if match_missing else a[k] == b[f"{k}__b"] for k in keys
    ]
    joined = a.join(b, on, "inner")

    def differs(c: str):
        x, y = F.col(f"{c}_orig"), F.col(f"{c}_meta")
        # values of one type are compared as they are; text is made of the few that differ
        native = a_types[c] == b_types[c] and a_types[c] not in ("float", "double")
        return x != y if native else x.cast("string") != y.cast("string")

    cells = [
        F.when(
            differs(c),
            F.struct(
                F.lit(c).alias("colname"),
                F.col(f"{c}_orig").cast("string").alias("orig"),
                F.col(f"{c}_meta").cast("string").alias("meta"),
            ),
        )
        for c in cols
    ]
    lead = ["phacid_orig", "phacid_meta", *keys]
    if not cols:
        return joined.select(F.lit("").alias("colname"), *lead, F.lit("").alias("value_orig"),
                             F.lit("").alias("value_meta")).where(F.lit(False))
    # equal rows, usually nearly all, are dropped inside the join
    joined = joined.where(reduce(lambda x, y: x | y, [F.coalesce(differs(c), F.lit(False)) for c in cols]))
    return (
        joined.select(*lead, F.explode(F.array_compact(F.array(*cells))).alias("e"))
        .select(
            "e.colname", *lead,
            clean_str("e.orig").alias("value_orig"), clean_str("e.meta").alias("value_meta"),
        )
    )


# Fixed value: the symptom whose text is shown.
OTHER_SYMPTOM = 35

# Travel locations that are not abroad.
NOT_ABROAD = ["canada", "unclassifiable", "pei", "not collected"]


def case_view(
    cases: DataFrame, symptoms: DataFrame, severity: DataFrame, exposures: DataFrame, lab: DataFrame,
    travel: DataFrame, *, symptom_ids: dict[str, int] | None = None,
) -> DataFrame:
    """Flat view of the confirmed cases from the normalised tables.

    Tables with several rows per case are reduced to one before the join, so no side
    multiplies another, and all joins are on the case id: each side is shuffled once.
    """
    ids = symptom_ids or {f"sym{v}": k for k, v in SYMPTOM_NAMES.items() if k > 1}
    value, number = F.col("symptomvalue"), F.col("symptomid")
    spec = F.col("symptomspec") if "symptomspec" in symptoms.columns else F.lit(None).cast("string")

    def any_row(cond: Column) -> Column:
        return F.max(F.when(cond, 1)) == 1

    wide = symptoms.groupBy("phacid").agg(
        any_row((number > 1) & (number < 35) & (value == "yes")).alias("s_any"),
        any_row(number == 1).alias("s_asked"),
        F.max(F.when(number == 1, value)).alias("s_own"),
        *[F.max(F.when(number == n, value)).alias(c) for c, n in ids.items()],
        F.max(F.when(number == OTHER_SYMPTOM, spec)).alias("symotherspec"),
    )
    severe = severity.groupBy("phacid").agg(*[F.max(c).alias(c) for c in severity.columns if c != "phacid"])
    tested = lab.groupBy("phacid").agg(
        F.min("labspecimencollectiondate").alias("l_taken"), F.min("labtestresultdate").alias("l_result")
    )
    place = F.col("travel_international_loc")
    travelled = travel.groupBy("phacid").agg(
        any_row(~place.isin(NOT_ABROAD)).alias("t_abroad"), any_row(place == "canada").alias("t_home")
    )
    contact = exposures.groupBy("phacid").agg(
        F.max("closecontacttravel").alias("e_travel"), F.max("closecontactcase").alias("e_case")
    )

    def stated(c: str) -> Column:
        x = F.col(c)
        return F.when(x.isNull() | (x == ""), F.lit("not stated")).otherwise(x)

    asymptomatic = (
        F.when(F.col("s_any"), F.lit("no"))
        .when(F.col("s_asked"), F.col("s_own"))
        .otherwise(F.lit("unknown"))
    )
    icu = (
        (F.col("icu") == "yes") | F.col("icustartdate").isNotNull()
        | (F.col("mechanicalvent") == "yes") | F.col("ventstartdate").isNotNull()
    )
    hospital = (
        F.when(icu, F.lit("hospitalized - icu"))
        .when((F.col("hosp") == "yes") | F.col("hospstartdate").isNotNull(), F.lit("hospitalized - non-icu"))
        .when(F.col("hosp") == "no", F.lit("not hospitalized"))
        .otherwise(F.lit("unknown"))
    )
    d = F.col("disposition")
    outcome = (
        F.when(d.isin("ill", "self isolation"), F.lit("stable"))
        .when(d.isin("not reported", "other", "pending", ""), F.lit("unknown"))
        .otherwise(d)
    )
    exposure = (
        F.when(F.col("t_abroad") | (F.col("pt") == "repatriate"), F.lit("international travel"))
        .when(F.col("e_travel") == "yes", F.lit("domestic acquisition"))
        .when(F.col("e_case").isNotNull() | F.col("t_home"), F.lit("domestic acquisition"))
        .when(F.col("pt") == "on", F.lit("information pending"))
    )
    joined = cases.where(F.col("classification") == "confirmed")
    for side in (wide, severe, contact, tested, travelled):
        joined = joined.join(side, "phacid", "left")
    return joined.select(
        "phacid", "pt", F.coalesce("onsetdate", "l_taken", "l_result").alias("episodedate"),
        "classification", stated("sex").alias("sex2"),
        age_group10("age", "agegrouping").alias("agegroup10"), "age",
        stated("occupation").alias("occupation2"), stated("occupationhcw").alias("healthcare_worker2"),
        stated("ltc_resident").alias("ltc_resident2"), asymptomatic.alias("asymptomatic2"), "onsetdate", *ids,
        "symotherspec",
        hospital.alias("hospstatus"), outcome.alias("disposition2"),
        F.when(d == "recovered", F.col("recoverydate")).alias("recoverydate2"),
        exposure.alias("exposure_cat2"),
    )
