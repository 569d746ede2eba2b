import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """A DataFrame of documents with null, empty and repeated rows and a clashing extra column."""

    def make(texts, ids=None):
        rows = [(i if ids is None else ids[i], t, "en", "s", i) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make
