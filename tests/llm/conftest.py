import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row int, _copies string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and clashing column names."""
    long_text = "\n".join(f"Line {i} of a long text that goes on and on." for i in range(3000))
    shared = "This is one passage that many texts share word for word here.\nAnd this is its second line of words."
    rows = [
        (1, "plain text with a few words", "en", "a", 27, "k", 1, "x"),
        (1, "plain text with a few words", "en", "a", 27, "k", 1, "x"),
        (2, "plain text with a few words", "en", "b", 27, None, None, None),
        (None, "plain text with a few words", None, None, None, "k", 2, "y"),
        (None, None, None, None, None, None, None, None),
        (3, None, "en", "a", None, "k", 3, "z"),
        (4, "", "en", "a", 0, "k", 3, "z"),
        (5, " \n\t ", "en", None, 4, "k", 3, "z"),
        (6, long_text, "en", "c", len(long_text), "k", 3, "z"),
        (7, long_text + "\nand an end", "en", "c", 0, "k", 3, "z"),
        (8, shared, "en", "a", 0, "k", 3, "z"),
        (9, "Before it.\n" + shared + "\nAfter it.", "en", "a", 0, "k", 3, "z"),
        (10, "Ünïcödé ☃ 日本語 \U0001F600 text", "xx", "é", 0, "k", 3, "z"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def text_table(spark, texts, sources=None):
    rows = [(i, t, (sources or ["s"] * len(texts))[i]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")
