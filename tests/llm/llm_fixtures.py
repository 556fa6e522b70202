"""Rows that every operator must take, and fixtures over them."""

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that the operators use for their own columns
          "n_words long, shard int, slot long, kept boolean, id long, mark long, start long, label int, tag string, curve int")
LONG = "Lorem ipsum dolor sit amet " * 6000


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), 1, 2, 3, True, 4, 5, 6, 1, "t", 7)


#: Nulls in any column, empty and blank texts, a very long text, ties and repeated rows.
EDGES = [
    row(1, "one two three four five six seven"), row(2, "one two three four five six seven"), row(3, ""), row(4, None), row(5, " \t\n"),
    row(None, "one two three four five six seven"), row(6, "short text"), row(6, "short text"), row(7, LONG), row(7, LONG), row(8, LONG, None),
    row(9, "x" * 100_000), row(10, "mail a.b@c.example.org or +1 (555) 010-9999 from 10.0.0.1, card 4111 1111 1111 1111."),
    (11, "no language", None, None, None, None, None, None, None, None, None, None, None, None, None), row(12, "\x0b\x0cone\rtwo three"), row(13, 'set password="abc123def456" here'),
]


@pytest.fixture(scope="session", autouse=True)
def _workers(spark):
    from govlake.llm.stage import importable

    importable(spark)


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
