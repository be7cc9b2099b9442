"""Shapes that must not appear in any plan."""

import re

import pytest

from verification.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # a window without a partition gathers everything in one task
    for window in re.findall(r"\bWindow \[.*", plan):
        assert not re.search(r"windowspecdefinition\((?:specifiedwindowframe|[\w#]+ (?:ASC|DESC))", window), window
    assert "BatchEvalPython" not in plan


def shapes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {k: len(re.findall(rf"\b{k}\b", plan)) for k in ("Exchange", "SortMergeJoin", "ArrowEvalPython")}


@pytest.mark.parametrize("name,exchanges,joins", [
    ("positivity_batch", 26, 6), ("epi_rolling_mean", 10, 0), ("epi_percent_fill", 10, 0), ("epi_curve_batch", 10, 0),
    ("epi_usual_charts", 10, 0),
])
def test_batches_are_one_small_plan(spark, name, exchanges, joins):
    """The tables of all series come from one plan, however many series there are."""
    found = shapes(QUERIES[name](spark, SF))
    assert found["Exchange"] <= exchanges and found["SortMergeJoin"] <= joins and found["ArrowEvalPython"] <= 1, found
