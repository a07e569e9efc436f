import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASH = "doc_id long, text string, id string, h string, code int, component string, bin int, part string, score string"


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text) as documents."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    return make


@pytest.fixture
def odd(spark):
    """Nulls, empty and blank texts, repeated rows, a long text, one id with two
    texts, and further columns with clashing names."""
    long = "the thing of it and " * 3000
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a b c d e"), (4, "a b c d e"), (None, "a b c d e"), (None, None),
            (5, long), (6, "x" * 20000), (7, "é" * 60), (8, "one"), (8, "two words")]
    return spark.createDataFrame([(i, t, "x", "y", 1, "z", 2, "p", "q") for i, t in rows], CLASH)
