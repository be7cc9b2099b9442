"""Benchmark decontamination with a distributed positional inverted index, in DataFrame functions only.

Every window of a benchmark item is looked up by its rarest terms, as counted over the whole corpus. The index holds
the postings (term, document, position) of just these terms. A posting less the term's place in the item is a shift of
the item against the document; shifts on which all probes of a window agree are compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.plans.sizing import hinted, is_small, materialise

from .common import lower_ascii_word, prepare

SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Most bytes of terms or keys that are sent to every executor; beyond it they are joined by shuffles.
BROADCAST_BYTES = 32 << 20
KEY = ["_k", "_j"]


def split_words(text: Column) -> Column:
    """Words in their case; a text that ends in separators has an empty last one, which equals no term."""
    return F.split(F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SEPARATOR}+", ""), f"{SEPARATOR}+")


def row_key() -> list[Column]:
    """128 bits that stand for a row; rows alike in id and text have the same matches."""
    # a hash passes over nulls, so it is told where they are
    null = [F.col("doc_id").isNull(), F.col("text").isNull()]
    return [F.xxhash64("doc_id", "text", *null).alias("_k"), F.xxhash64(F.lit(1), "text", "doc_id", *null).alias("_j")]


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").alias("_text"), *row_key())


def tokens(docs: DataFrame) -> DataFrame:
    words = docs.select(*KEY, F.posexplode(split_words(F.col("_text"))).alias("pos", "word"))
    return words.select(*KEY, "pos", lower_ascii_word(F.col("word")).alias("term"))


def items_of(benchmark: DataFrame, width: int) -> DataFrame:
    """Distinct word sequences of the items: words, id, and the length of their windows."""
    words = F.filter(F.transform(split_words(F.col("text")), lower_ascii_word), lambda w: w != "")
    items = benchmark.select(words.alias("words")).where(F.size("words") > 0).distinct()
    return items.select("words", F.xxhash64("words").alias("item"), F.least(F.lit(width), F.size("words")).alias("len"))


def sized(df: DataFrame, column: str) -> DataFrame:
    """Broadcast a stored table of strings if its bytes are few."""
    total = df.agg(F.sum(F.octet_length(column) + 32)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def probes_of(items: DataFrame, docs: DataFrame, probes: int) -> DataFrame:
    """item, window, place, term: the rarest terms of every window that can occur at all."""
    places = items.select("item", "len", "words", F.posexplode("words").alias("place", "term"))
    terms = materialise(places.select("term").distinct())
    counts = materialise(tokens(docs).join(sized(terms, "term"), "term").groupBy("term").agg(F.count("*").alias("n")))
    starts = F.sequence(F.greatest(F.lit(0), F.col("place") - F.col("len") + 1), F.least(F.col("place"), F.size("words") - F.col("len")))
    windows = places.join(counts, "term", "left").select("item", "place", "term", "len", "n", F.explode(starts).alias("window"))
    of = Window.partitionBy("item", "window")
    known = windows.withColumn("_all", F.count("n").over(of)).withColumn("_rank", F.row_number().over(of.orderBy("n", "place")))
    return known.where((F.col("_all") == F.col("len")) & (F.col("_rank") <= probes)).select("item", "window", "place", "term")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The positional index of the given terms: term, document key, position."""
    return tokens(docs).join(sized(terms, "term"), "term").select("term", *KEY, "pos")


def shifts(docs: DataFrame, items: DataFrame, probes: int, slack: int) -> DataFrame:
    """Document key, item and shift where all probes of one of the item's windows agree to within ``slack`` words."""
    probe = materialise(probes_of(items, docs, probes))
    terms = materialise(probe.select("term").distinct())
    index = materialise(postings(docs, terms))
    spots = probe.groupBy("term", "item", "place").agg(F.lit(1).alias("_one")).drop("_one")
    found = index.join(spots, "term").select(*KEY, "item", "place", (F.col("pos") - F.col("place")).alias("shift"))
    if slack:
        near = F.explode(F.sequence(F.col("shift") - slack, F.col("shift") + slack))
        found = found.select(*KEY, "item", "place", near.alias("shift"))
    # at most as many places as the item has words
    agreed = found.groupBy(*KEY, "item", "shift").agg(F.collect_set("place").alias("places"))
    needed = probe.groupBy("item", "window").agg(F.collect_set("place").alias("need"))
    needed = materialise(needed.groupBy("item").agg(F.collect_set("need").alias("windows")))
    whole = F.exists("windows", lambda w: F.size(F.array_except(w, F.col("places"))) == 0)
    small = is_small(needed, BROADCAST_BYTES)
    return agreed.join(hinted(needed, small), "item").where(whole).select(*KEY, "item", "shift")


def near_matches(docs: DataFrame, benchmark: DataFrame, width: int = 10, probes: int = 2, slack: int = 2) -> DataFrame:
    """doc_id and item_id of documents that hold the rarest terms of a window at its distances, to within ``slack`` words."""
    prepare(docs.sparkSession)
    held = keyed(docs)
    items = materialise(items_of(benchmark, width))
    hit = shifts(held, items, probes, slack).select(*KEY, "item").distinct()
    ids = held.select(*KEY, "doc_id").distinct().join(hit, KEY)
    return ids.join(item_ids(benchmark, width), "item").select("doc_id", "item_id").distinct()


def item_ids(benchmark: DataFrame, width: int) -> DataFrame:
    words = F.filter(F.transform(split_words(F.col("text")), lower_ascii_word), lambda w: w != "")
    return benchmark.select(F.xxhash64(words).alias("item"), F.col("item_id").cast("string").alias("item_id")).distinct()


def phrase_matches(docs: DataFrame, benchmark: DataFrame, width: int = 10, probes: int = 2) -> DataFrame:
    """Document key, spans (start and end of every occurrence of a window) and items that have one."""
    items = materialise(items_of(benchmark, width))
    # an item's words are held once for a document, however many shifts it has there
    found = shifts(docs, items, probes, 0).groupBy(*KEY, "item").agg(F.collect_set("shift").alias("shifts")).join(items, "item")
    per_doc = materialise(found.groupBy(*KEY).agg(F.collect_list(F.struct("item", "shifts", "len", "words")).alias("tries")))
    keys = per_doc.select(*KEY)
    texts = docs.join(hinted(keys, is_small(keys, BROADCAST_BYTES)), KEY, "left_semi")
    lowered = F.transform(split_words(F.col("_text")), lower_ascii_word)
    tried = texts.select(*KEY, lowered.alias("_words")).dropDuplicates(KEY).join(per_doc, KEY)

    def spans(t: Column) -> Column:
        def of_shift(shift: Column) -> Column:
            def same(i: Column) -> Column:
                at = shift + i
                return (at >= 0) & (F.slice("_words", F.greatest(at, F.lit(0)) + 1, t["len"]) == F.slice(t["words"], i + 1, t["len"]))

            at = F.filter(F.sequence(F.lit(0), F.size(t["words"]) - t["len"]), same)
            return F.transform(at, lambda i: F.struct((shift + i).alias("a"), (shift + i + t["len"]).alias("b")))

        return F.struct(t["item"].alias("item"), F.flatten(F.transform(t["shifts"], of_shift)).alias("at"))

    hits = tried.select(*KEY, F.filter(F.transform("tries", spans), lambda x: F.size(x["at"]) > 0).alias("hits")).where(F.size("hits") > 0)
    return hits.select(
        *KEY, F.sort_array(F.array_distinct(F.flatten(F.transform("hits", lambda x: x["at"])))).alias("spans"),
        F.array_distinct(F.transform("hits", lambda x: x["item"])).alias("items"),
    )


def covered(spans: Column) -> Column:
    """Words in the union of sorted spans."""
    state = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(s: Column, x: Column) -> Column:
        new = F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["end"]))
        return F.struct(F.greatest(s["end"], x["b"]).alias("end"), (s["n"] + new).alias("n"))

    return F.aggregate(spans, state, add, lambda s: s["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, probes: int = 2) -> DataFrame:
    """One row for every row of ``docs``: doc_id, n_words, n_hit (words inside any occurrence of a window of ``width``
    item words), items (ids with an occurring window, sorted as strings) and contaminated.

    A shorter item is one window. Null texts have no words, null or wordless items no windows; an item without id
    counts for n_hit but is not listed; rows that repeat are judged alike; empty tables give no rows or no hits. Only
    doc_id, text and item_id, text are read. The terms of the benchmark are broadcast up to ``BROADCAST_BYTES``.
    """
    return row_contamination(docs, benchmark, width, probes).drop(*KEY)


def row_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, probes: int = 2) -> DataFrame:
    """As ``contamination``, with the key of the row."""
    prepare(docs.sparkSession)
    held = keyed(docs)
    hits = phrase_matches(held, benchmark, width, probes).select(*KEY, covered(F.col("spans")).alias("n_hit"), "items")
    hits = materialise(hits)
    listed = hits.select(*KEY, F.explode("items").alias("item")).join(item_ids(benchmark, width), "item")
    listed = listed.groupBy(*KEY).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    found = materialise(hits.drop("items").join(listed, KEY, "left"))
    n_words = F.coalesce(F.regexp_count("_text", F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    out = held.select("doc_id", *KEY, n_words.alias("n_words")).join(found, KEY, "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    none = F.array().cast("array<string>")
    return out.select("doc_id", *KEY, "n_words", n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"), (n_hit > 0).alias("contaminated"))
