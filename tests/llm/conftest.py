import pytest

LONG = " ".join(f"wort{k % 977} naht{k % 31}" for k in range(30_000))
PROSE = " ".join(f"alpha{k} beta{k % 7}" for k in range(60))

#: Nulls, empty and very long texts, ties, repeated rows; an extra column with a clashing name.
ROWS = [
    (1, PROSE, "x"), (2, PROSE, "x"), (2, PROSE, "x"), (3, PROSE + " gamma", None), (4, "", "x"), (5, None, "y"),
    (None, PROSE, "x"), (6, " \t\n ", "x"), (7, LONG, "x"), (8, "tail " + LONG, None), (9, "one", "x"),
    (9, "a different text under the same id with some more words in it", "x"),
    (10, "mail bob@example.com or call +1 (555) 555-0123 from 10.0.0.1, card 4111 1111 1111 1111", "x"),
    (11, "Released under the MIT License. a # b | c\na # b | c\na # b | c\n", "x"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string, code string").repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, code string")
