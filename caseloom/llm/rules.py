"""Quality rules: a table of thresholds compiled into one projection of ratios, without user functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.expressions import let

from .common import SPACE, others, prepare

NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
#: Frequent short words of the languages at hand: prose has some, lists and junk have none.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "as", "with", "be", "by", "at", "this",
    "le", "la", "les", "de", "des", "et", "en", "un", "une", "que", "du", "est", "pas",
    "der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "den", "von", "mit",
    "el", "los", "las", "y", "por", "con", "para", "se", "su", "del", "una", "no",
)

#: One row for each rule: name, measure, lower and upper limit (null: none). A text that breaks one is not kept.
#: The first two are the base; its limits are exact: 100 * n_repeat_words > 50 * n_words breaks the second.
RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("too_few_words", "n_words", 50, None),
    ("repeated_windows", "repeat_ratio", None, 0.5),
    ("word_length", "mean_word_chars", 2, 15),
    ("symbols", "symbol_ratio", None, 0.1),
    ("duplicate_lines", "dup_line_ratio", None, 0.3),
    ("no_stop_words", "n_stop_words", 2, None),
)
BASE = ("too_few_words", "repeated_windows")


def words_of(text: Column) -> Column:
    parts = F.split(text, f"{SPACE}+")
    return F.filter(parts, lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, from the sorted hashes of the windows."""

    def windows(w: Column) -> Column:
        def at(i: Column) -> Column:
            return F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))

        n = F.size(w)
        return F.when(n >= 4, F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), at))).otherwise(
            F.array().cast("array<struct<h:bigint,i:int>>")
        )

    def places(s: Column) -> Column:
        def repeated(x: Column, k: Column) -> Column:
            h = x["h"]
            # beyond the ends get gives null, which differs from every hash
            return F.get(s, k - 1)["h"].eqNullSafe(h) | F.get(s, k + 1)["h"].eqNullSafe(h)

        return F.sort_array(F.transform(F.filter(s, repeated), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        def gap(i: Column, k: Column) -> Column:
            return F.coalesce(F.least(F.lit(3), F.get(p, k + 1) - i), F.lit(3))

        return F.aggregate(F.transform(p, gap), F.lit(0).cast("long"), lambda a, x: a + x)

    return let(words, lambda w: let(windows(w), lambda s: let(places(s), covered)))


def measures(text: Column) -> Column:
    """All counts of a text as one struct; null counts as an empty text."""
    t = F.coalesce(text, F.lit(""))

    lines_of = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(NOT_SPACE)))

    def counted(w: Column, lines: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        )

    return let(words_of(t), lambda w: let(lines_of, lambda lines: counted(w, lines)))


def ratios(m: Column) -> dict[str, Column]:
    def share(part: str, of: str) -> Column:
        return F.when(m[of] > 0, m[part] / m[of]).otherwise(F.lit(0.0))

    return {
        "n_words": m["n_words"].cast("double"),
        "repeat_ratio": share("n_repeat_words", "n_words"),
        "mean_word_chars": share("word_chars", "n_words"),
        "symbol_ratio": share("n_symbols", "word_chars"),
        "dup_line_ratio": share("n_dup_lines", "n_lines"),
        "n_stop_words": m["n_stop_words"].cast("double"),
    }


def verdicts(m: Column, rules=RULES) -> dict[str, Column]:
    """For each rule whether a text breaks it."""
    values, out = ratios(m), {}
    for name, measure, low, high in rules:
        v = values[measure]
        tests = [v < low] * (low is not None) + [v > high] * (high is not None)
        out[name] = reduce(lambda a, b: a | b, tests)
    return out


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """``docs`` without its text, with the counts, base_failed, kept and failed (names of the broken rules).

    One projection: no shuffle and no user function. A null or empty text has no words and breaks the first rule; all
    rows come back, repeated ones too; columns named like an added one are replaced. ``rules`` may be any table of
    (name, measure, lower limit, upper limit) over the measures of ``ratios``.
    """
    prepare(docs.sparkSession)
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_stop_words"]
    kept = others(docs, *added, "text", "base_failed", "kept", "failed", "_m")

    def row(m: Column) -> Column:
        broken = verdicts(m, rules)
        failed = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in broken.items()]), lambda x: x.isNotNull())
        base = reduce(lambda a, b: a | b, [c for n, c in verdicts(m, RULES).items() if n in BASE])
        return F.struct(*[m[c].alias(c) for c in added], base.alias("base_failed"), failed.alias("failed"))

    out = docs.select(*kept, let(measures(F.col("text")), row).alias("_m"))
    return out.select(
        *kept, *[F.col(f"_m.{c}").alias(c) for c in added], F.col("_m.base_failed").alias("base_failed"),
        (~F.col("_m.base_failed") & (F.size("_m.failed") == 0)).alias("kept"), F.col("_m.failed").alias("failed"),
    )
