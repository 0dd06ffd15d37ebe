import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import SCHEMA, frame, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    rows = odd_rows()
    return rows, frame(spark, rows).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
