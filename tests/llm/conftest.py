"""Rows that every operator has to cope with."""

import pytest

LONG = "very long text of many words " * 20_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, slot string, _row_key string, node int, size string"


def clashing(*rows):
    return [(*r, len(r[1]) if r[1] is not None else None, 1, "x", "k", 2, "big") for r in rows]


EDGES = clashing(
    (1, "Same text for two rows, five words at least.", "en", "a"),
    (1, "Same text for two rows, five words at least.", "en", "a"),
    (2, "Same text for two rows, five words at least.", None, "b"),
    (None, "A row without an id but with words of its own.", "en", None),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \n\t ", "de", "b"),
    (6, LONG, "en", "a"),
    (7, "!!! ... ???", "fr", "a"),
    (8, "İstanbul und \U0001f600 ééé \u0000 null sign", "de", "c"),
)


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
