import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from turnlake.session import local_session

    session = local_session("tests", 4, "6g")
    yield session
    session.stop()


def values(df, *columns):
    """Rows as a sorted list of tuples."""
    rows = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in rows.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
