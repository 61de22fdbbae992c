import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(8)
    yield spark
    spark.stop()


@pytest.fixture
def frame(spark):
    """A DataFrame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
