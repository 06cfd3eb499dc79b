import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "clickloom-tests")
    yield session
    session.stop()


@pytest.fixture
def ingested_at():
    from pyspark.sql import functions as F
    return F.lit("2024-01-01 00:00:00").cast("timestamp")
