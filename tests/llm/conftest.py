import pytest
from tests_support import MESSY, SCHEMA, rows_of


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(rows_of(MESSY), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
