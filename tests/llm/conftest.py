import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text[, lang, source]), with columns whose names an operator might use itself."""

    def make(rows):
        full = [(i, t, *(r or ("en", "s")), len(t or ""), 1, "x", "y", 2.0) for i, t, *r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, rank int, kept string, component_id string, size double")

    return make
