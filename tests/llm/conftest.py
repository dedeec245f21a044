import pytest

from sparkmart.llm.common import importable

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text) as a table of documents with extra columns."""
    def make(rows, schema=DOCS):
        return spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], schema)
    return make
