import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, __words string, _row int, root string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table with further columns whose names clash with those that operators add or use."""

    def make(rows):
        full = []
        for r in rows:
            doc_id, text, *lang = r
            full.append((doc_id, text, lang[0] if lang else None, "s", len(text or ""), "x", "y", "z", 1, "r"))
        return spark.createDataFrame(full, DOCS)

    return make
