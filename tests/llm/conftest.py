import pytest

#: Names that the operators use for columns of their own steps.
CLASHING = ["hash", "lost", "row", "hub", "component_id", "kept", "score", "lang_pred", "found", "key", "piece", "slice"]


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text) rows, with other columns of clashing names."""

    def make(rows, lang=None, source=None):
        full = [
            (i, text, lang[n] if lang else None, source[n] if source else None, *["x"] * len(CLASHING))
            for n, (i, text) in enumerate(rows)
        ]
        columns = ", ".join(f"{name} string" for name in CLASHING)
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, {columns}")

    return make
