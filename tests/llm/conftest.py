import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts (or (doc_id, text) pairs), with a column whose name clashes."""

    def make(texts, source=None):
        rows = [(t[0] if isinstance(t, tuple) else i, t[1] if isinstance(t, tuple) else t) for i, t in enumerate(texts)]
        full = [(d, t, "en", source(d) if source else "s", 0, "x", 1) for d, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, shard string, score int"
        )

    return make
