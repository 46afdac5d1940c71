import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows from (doc_id, text) pairs or longer tuples, over several partitions."""

    def make(*rows):
        full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
