import pytest


@pytest.fixture
def rows(spark):
    """Frames from literal rows with a schema string."""
    return lambda data, schema: spark.createDataFrame(data, schema)
