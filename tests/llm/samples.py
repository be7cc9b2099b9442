"""Small awkward tables for the operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, kept boolean, size long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["the", "of", "and", "casa", "Ärger", "éte", "data", "model", "word", "it's", "x", "Ünder", "plain", "river", "stone", "2024"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "\t", ". ", ", "]) for _ in range(n))


def documents(spark):
    """Nulls in every column, empty and blank texts, repeated rows, near copies, one long text, clashing columns."""
    long = prose(1, 4000)
    passage = prose(2, 40)
    texts = [
        (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one two"), (5, prose(3, 120)), (6, prose(3, 120)),
        (7, prose(3, 120) + " end"), (8, long), (9, prose(4, 30) + passage + prose(5, 30)), (10, passage),
        (10, passage), (None, passage), (None, None), (11, prose(6, 60) + "\n" + passage), (12, "日本語 テキスト <|im_end|>"),
        (13, "### $$$ %%% | < > *"), (14, "a b c a b c a b c\na b c a b c a b c\n" * 9), (15, "A" * 5000), (16, "İ ΣΑΣ \x85 \x1c"),
    ]
    rows = [(i, t, None if k % 5 == 0 else ["en", "fr"][k % 2], None if k % 7 == 0 else f"src{k % 3}", k, k, 0.5, True, 7) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
