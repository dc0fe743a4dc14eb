import pytest
from made_texts import LONG, PROSE, SCHEMA, numbered


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, short and very long texts, null ids and columns, repeated rows, columns of other names."""
    texts = [None, "", " \n\t ", "a", "two words", LONG, PROSE * 3, PROSE * 3, "\x00 \x1c ß漢字 😀 İ", numbered(60, "k")]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, None, "x", 1, 0.5, "r", "c", 2, 3, "k") for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, PROSE * 3, None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def some_labels(spark):
    rows = [(0, 1, 0), (1, 0, 1), (4, 1, None), (6, 1, 0), (6, 0, 0), (9, 1, 0), (None, 1, 0), (99, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
