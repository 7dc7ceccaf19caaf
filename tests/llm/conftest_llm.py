import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
SF = "/root/testdata/sf0.001"


@pytest.fixture()
def make_docs(spark):
    """documents with extra and clashing columns from (doc_id, text) pairs."""

    def make(pairs, lang="en"):
        return spark.createDataFrame([(i, t, lang, "src", len(t or ""), "x") for i, t in pairs], DOCS)

    return make
