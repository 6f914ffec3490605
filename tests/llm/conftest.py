import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import rows  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with every awkward case, over several partitions."""
    return spark.createDataFrame(rows.documents(), rows.SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    """A table without rows."""
    return spark.createDataFrame([], rows.SCHEMA)
