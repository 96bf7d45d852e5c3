import pytest


@pytest.fixture()
def frame(spark):
    """DataFrame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
