"""The corpus pipeline: stages over ``documents``, each calling one operator of caseloom.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and reads it again as the
next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import decontaminate, language, mixing, simhash, substrings
from caseloom.llm.common import part_of, prepare, table
from caseloom.llm.decontaminate import KEY
from caseloom.plans.sizing import broadcast_if_small, materialise, remove_path, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without a letter and null texts go.

    The model learns from the given lang of rows whose id has crc32 modulo 4 other than 2; predictions read the text only.
    """
    prepare(spark)
    model = language.learn(docs.where(part_of("doc_id", 4) != 2), public_tokenizers.path("piece_bpe_32k.model"))
    told = language.identify(docs.select(*COLUMNS), model)
    return told.where(F.col("lang_pred") != language.UNKNOWN).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id (none counts as largest), then text.

    Rows are judged one by one: those that share an id, or have none, stay apart unless their texts are near.
    """
    prepare(spark)
    keyed = docs.select(*decontaminate.row_key(), *COLUMNS)
    groups = simhash.components(keyed.select("doc_id", "text", *KEY), carried=tuple(KEY)).select(*KEY, "doc_id", "root", "component_id")
    # usually one row has the smallest id; texts are compared where several do
    least = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("root", *KEY).distinct()
    one = least.groupBy("root").agg(F.count("*").alias("n"), *(F.min(k).alias(k) for k in KEY))
    one, least = materialise(one), materialise(least)
    open_ = materialise(least.join(one.where("n > 1").select("root"), "root", "left_semi"))
    first = one.where("n = 1").select(*KEY)
    if not open_.isEmpty():
        tied = keyed.select(*KEY, "text").join(broadcast_if_small(open_), KEY)
        first = first.unionByName(tied.groupBy("root").agg(F.min(F.struct("text", *KEY)).alias("row")).select("row._k", "row._j"))
    # the rows of a key share id and text; one stays, without another exchange
    stay = keyed.join(first, KEY, "left_semi")
    return stay.groupBy(*KEY).agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a document with a smaller id has; documents with nothing left go."""
    prepare(spark)
    cut = substrings.dedup(docs.select(*COLUMNS))
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark; others of the same id, or of none, stay."""
    prepare(spark)
    judged = decontaminate.row_contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    bad = judged.where("contaminated").select(*KEY).distinct()
    return docs.select(*COLUMNS, *decontaminate.row_key()).join(bad, KEY, "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: one row for every copy taken, with copy, words and finish, in the order of the mix."""
    prepare(spark)
    return mixing.mix(docs.select(*COLUMNS))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: SQL cannot learn languages or follow fingerprints to their components; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what a stage has read is removed when its result is written."""
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if read is not None:
            remove_path(spark, read)
        docs, read = spark.read.parquet(path), path
    return docs
