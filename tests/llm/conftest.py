import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edge_cases import CLASH, SCHEMA, edge_rows  # noqa: E402

@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, edge):
    from pyspark.sql import functions as F

    return edge.withColumns({k: F.lit(v) for k, v in CLASH.items()})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
