import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang, source]) tuples."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make
