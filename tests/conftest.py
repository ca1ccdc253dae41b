import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import oracle  # noqa: E402

from tallyframe.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return tune(oracle.session())


@pytest.fixture(scope="session")
def rows(spark):
    """Small table from tuples and a DDL schema."""

    def build(data, schema):
        return spark.createDataFrame(data, schema)

    return build
