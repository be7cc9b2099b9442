import pytest

from verification.check import session


@pytest.fixture(scope="session")
def spark():
    s = session(4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def con():
    from verification.check import database

    return database("/root/testdata/sf0.001")


def values(df, *cols):
    return [tuple(r) if len(r) > 1 else r[0] for r in df.select(*(cols or df.columns)).collect()]
