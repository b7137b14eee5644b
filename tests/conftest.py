import os

import pytest

from stepwise.session import local_session, prepare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("TZ", "UTC")
    session = prepare(local_session(4, partitions=2, memory="6g"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("the driver's tables aren't here")
    return SF


def rows(df, *columns):
    """All rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
