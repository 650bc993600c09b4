import pytest


@pytest.fixture(scope="session")
def awkward(spark):
    """Null, empty, blank and very long texts, repeated rows and ids, null ids and sources, and columns with names that operators use."""
    words = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, words, "b"), (4, words, "b"), (5, "x" * 200_000, "b"),
        (None, "one two three four five six", None), (6, "one two three four five six", "c"), (7, "ONE two three four five six", "c"), (7, "other words here", "c"),
    ]
    return spark.createDataFrame([(*r, "x", 0, 0, "y") for r in rows], "doc_id long, text string, source string, node string, size int, n int, _text string")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
