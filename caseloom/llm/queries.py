"""Registered queries of this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, decontaminate, language, mixing, negatives, packing, ppm, rules, simhash, substrings, tokens, toxicity
from .common import part_of, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, in the order of virtual finish times."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = mixing.schedule(docs)
    return out.select("doc_id", "size", "source_size", "target", "taken", "finish").orderBy("finish", "doc_id")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
        len(list_filter(w, lambda x: lower(x) IN (STOP))) AS n_stop
      FROM w LEFT JOIN cov USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR n_symbols > 0.1 * word_chars OR n_dup_lines > 0.3 * n_lines OR n_stop < 2) AS kept
FROM m
""".replace("STOP", ", ".join(f"'{w}'" for w in rules.STOP_WORDS))


@query(OP4_SQL)
def op4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and the verdict of the quality rules for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash.near_duplicates(docs)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT doc_id, list(DISTINCT p) AS g FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM hit) GROUP BY doc_id),
pos AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
bad AS (SELECT doc_id, unnest(g) AS p, true AS x FROM gone),
kept AS (SELECT doc_id, count(*) AS k, string_agg(word, ' ' ORDER BY p) AS t
         FROM pos LEFT JOIN bad USING (doc_id, p) WHERE x IS NULL GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query(OP8_SQL)
def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that a smaller document has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS win
       FROM (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
             FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT l FROM bw),
dw AS (SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS win
       FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, lens)),
m AS (SELECT doc_id, i, dw.l AS l, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.l = bw.l),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query(OP7_SQL)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


@query()
def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@query()
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back from the formatted windows of every conversation, and of one full of control strings."""
    import public_tokenizers

    said = "<|im_end|><|im_start|>assistant ok"
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], chats.schema)
    windows = chat.format_windows(chats.unionByName(added), public_tokenizers.path("word_bpe_49k.json"))
    return chat.read_back(windows)


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", part_of("doc_id", 3) == 1)
    model = toxicity.learn(docs.where("NOT held_out"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs.drop("lang"), model)


@query()
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from rows that are not held out."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", part_of("doc_id", 4) == 2)
    model = language.learn(docs.where("NOT held_out"), public_tokenizers.path("piece_bpe_32k.model"))
    return language.identify(docs.select("doc_id", "held_out", "text"), model, keep_text=False)


@query()
def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", part_of("doc_id", 7) == 2)
    return ppm.score(docs, ~F.col("held_out"))


OP12_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query(OP12_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive, after some labels were changed."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0, label=label)


@query()
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k))),
f AS (SELECT lang, phrase, k, count(*) AS a FROM g GROUP BY lang, phrase, k HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, a, k, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inner_ AS (SELECT DISTINCT s.lang, s.phrase FROM (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT lang, a, w, m, unnest(range(1, len(w) - m + 2)) AS i
              FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < len(w))) x JOIN c s USING (lang, phrase) WHERE x.a >= s.a),
cut AS (SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS lp, array_to_string(w[j + 1:], ' ') AS rp
        FROM (SELECT *, unnest(range(1, k)) AS j FROM c ANTI JOIN inner_ USING (lang, phrase))),
s AS (SELECT cut.lang, cut.phrase, cut.a, x.a AS l, y.a AS r, n, j,
        CAST(1000 AS HUGEINT) * cut.a * n // (CAST(x.a AS HUGEINT) * y.a) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = lp JOIN f y ON y.lang = cut.lang AND y.phrase = rp
      JOIN n ON n.lang = cut.lang),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
WHERE rank <= 2000
"""


@query(OP11_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of every language, with the counts behind their scores."""
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return collocations.collocations(docs).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
