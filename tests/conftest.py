from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = entry.local_session("local[8]")
    yield session
    session.stop()


@pytest.fixture
def shared(tmp_path):
    """A folder of its own for tests that write."""
    return str(tmp_path)


def values(df, column):
    return [r[column] for r in df.collect()]
