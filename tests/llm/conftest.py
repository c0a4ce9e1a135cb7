import pytest

from tableferry.llm.common import ship

LONG = "lorem ipsum dolor sit amet " * 6000

#: Rows that every operator on documents must take: nulls, empties, ties, repeats, a long text.
ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, "   \n\t ", "en", "a"),
    (4, "One two three four five six seven", "en", "a"),
    (4, "One two three four five six seven", "en", "a"),
    (5, "one TWO three four five six seven", "en", None),
    (6, LONG, None, "b"),
    (7, "é ñ 日本 !!", "fr", "b"),
    (None, "a row without an id", "en", "b"),
    (8, "1234 !?", "de", "b"),
]

#: Names that operators use themselves, as further columns of the input.
CLASH = ["key", "n", "hash", "sha", "owner", "size", "a", "b", "root", "label", "score", "line", "words", "path"]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with clashing further columns."""
    from pyspark.sql import functions as F

    ship(spark)
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    return docs.withColumns({name: F.lit("x") for name in CLASH})


@pytest.fixture(scope="session")
def none(spark):
    """No documents at all."""
    ship(spark)
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def some_labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 9)] + [(None, 1, 1), (4, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
