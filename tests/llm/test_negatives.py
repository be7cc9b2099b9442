import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import negatives
from caseloom.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, id long, score double, _row int, slot int, text string"


def by_hand(rows, anchors, k=5, low=80):
    """Rows are (id, vector, label), in any order; all pairs of an anchor and a row."""
    own = [(i, [math.floor(256 * float(x)) for x in v], y) for i, v, y in rows if v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]

    def order(r):
        return -r[0], r[1] is None, r[1] or 0

    out = []
    for a in own:
        if not anchors(a[0]):
            continue
        scored = [(sum(x * y for x, y in zip(a[1], b[1], strict=False)), b[0], b[2]) for b in own if b is not a]
        for p, i, _ in sorted((s for s in scored if s[2] == a[2]), key=order)[:k]:
            fit = sorted((s for s in scored if s[2] != a[2] and low * p <= 100 * s[0] <= 100 * p), key=order)[:k]
            out += [(a[0], i, n + 1, j, p, s) for n, (s, j, _) in enumerate(fit)]
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, 0.5, 2, 3, "x") for i, v, y in rows], SCHEMA).repartition(3)


def tens(i):
    return i is not None and i % 10 == 0


@pytest.mark.parametrize("block_rows,block_anchors", [(16384, 2048), (7, 2)])
def test_awkward_rows(spark, block_rows, block_anchors):
    """Nulls everywhere, no numbers, vectors of other lengths, repeated rows and anchors, many ties, opposite vectors."""
    rng = random.Random(5)
    some = [[rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(4)] for _ in range(9)]
    rows = [(i, rng.choice(some), rng.randrange(3)) for i in range(90)]
    rows += [(200, some[0], 1)] * 3 + [(None, some[1], 2), (None, some[1], 2), (None, some[2], None)]
    rows += [(210, None, 1), (220, [1.0, None, 0.0, 0.0], 1), (230, [math.nan] * 4, 1), (240, [math.inf, 0.0, 0.0, 0.0], 0)]
    rows += [(250, [], 1), (260, [1.0], 0), (270, [0.5, 0.5, 0.5, 0.5, 9.0], 2), (280, [-1.0] * 4, 0), (290, [1.0] * 4, 7)]
    got = negatives.mine(table(spark, rows), F.col("vec_id") % 10 == 0, block_rows=block_rows, block_anchors=block_anchors)
    assert result(got) == by_hand(rows, tens)


def test_many_equal_rows_and_one_label(spark):
    """A third of all rows is one vector without an id; anchors of a label of their own have no positives."""
    rows = [(None, [0.5, 0.5], 1)] * 400 + [(i, [0.5 + i % 3 / 10, 0.5], i % 2) for i in range(800)] + [(1000, [1.0, 1.0], 99)]
    got = negatives.mine(table(spark, rows), F.col("vec_id") % 100 == 0, block_rows=100)
    want = by_hand(rows, lambda i: i is not None and i % 100 == 0)
    assert result(got) == want and not any(r[0] == 1000 for r in want)


def test_large_products_stay_exact():
    rng = np.random.default_rng(3)
    for most in (100, 1 << 28, 1 << 30):
        a, b = (rng.integers(-most, most, (5, 8)).astype(float) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
        assert negatives.products(a, b).tolist() == want
    with pytest.raises(OverflowError):
        negatives.products(np.full((1, 4), 2.0**33), np.full((1, 4), 2.0**33))


def test_empty_tables(spark):
    assert result(negatives.mine(table(spark, []), F.lit(True))) == []
    assert result(negatives.mine(table(spark, [(1, [1.0], 0), (2, [1.0], 1)]), F.lit(False))) == []
    assert result(negatives.mine(table(spark, [(1, [1.0], 0), (2, [1.0], 1)]), F.lit(None).cast("boolean"))) == []


def test_query_equals_sql(spark, con):
    got = result(QUERIES["op12_hard_negatives"](spark, "/root/testdata/sf0.001"))
    want = con.execute(ORACLES["op12_hard_negatives"]).fetchall()
    assert got and got == sorted(want, key=str)
