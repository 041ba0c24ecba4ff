import pytest


@pytest.fixture
def make(spark):
    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    return table


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EDGES = [None, "", " ", "a", "…", "é Ü ß", "x" * 50_000, "word " * 30_000, "1 2 3", "\n\n", "same text twice", "same text twice"]


@pytest.fixture
def edge_docs(make):
    """Nulls in every column, empty and very long texts, a repeated row, a repeated id."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", len(t) if t else None) for i, t in enumerate(EDGES)]
    rows += [rows[3], (4, "another text at a used id", None, None, None), (None, "no id at all", None, None, None)]
    return make(rows, DOCS)


@pytest.fixture
def no_docs(make):
    return make([], DOCS)
