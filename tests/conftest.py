import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores="8", shuffle_partitions=4)
    yield session
    session.stop()


def rows(df, *order):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
