"""Every registered query against its SQL on the smallest tables."""

import pytest

from verification.check import compare
from verification.queries import ORACLES, QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


# these select regions of a thousand cases, which the smallest tables do not have
MAY_BE_EMPTY = {"report_delay_hist"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem = compare(spark, con, "/root/testdata/sf0.001", name)
    assert problem == ("both empty" if name in MAY_BE_EMPTY else "")


def test_fixture_text_matches_document():
    import re
    from pathlib import Path

    from verification import fixture

    text = (Path(__file__).resolve().parent.parent / "FIXTURES.md").read_text()
    blocks = [b.strip() for b in re.findall(r"```sql\n(.*?)```", text, flags=re.S)]
    assert blocks[:3] == [fixture.CASES_SQL, fixture.SYMPTOMS_SQL, fixture.SECOND_SQL]


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["phacid", "pt", "ptcaseid", "typ", "classification", "phacreporteddate", "err"]
    assert df.count() > 0
