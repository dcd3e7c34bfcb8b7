import pytest

from .data import edge_rows, make_docs


@pytest.fixture(scope="session")
def docs(spark):
    return make_docs(spark, edge_rows()).repartition(4).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])
