import pytest

DOCS = "doc_id long, text string, lang string, source string, id long, node long, key string, size long, shard int, n int"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from valora.llm.session import ready
    return ready(spark)


@pytest.fixture
def docs(spark):
    """(doc_id, text) pairs as a documents table with extra columns whose names
    the operators use inside."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s0", 1, 2, "k", 3, 4, 5) for i, t in rows], DOCS)
    return make
