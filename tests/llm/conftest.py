import pytest

DOCUMENTS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


@pytest.fixture
def docs(spark):
    def make(texts, schema=DOCUMENTS):
        rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
        return spark.createDataFrame(rows, schema)

    return make
