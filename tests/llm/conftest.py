import pytest
from llm_helpers import ODD, SCHEMA, table


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, "documents").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """ODD with columns whose names the operators use themselves."""
    rows = [(i, t, None, None if i == 4 else f"s{(i or 0) % 3}", None if t is None else len(t), 1, "x", 2, 3, 4, 5, 6) for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
