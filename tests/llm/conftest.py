import pytest

#: Rows that every operator must take: nulls, empty and repeated rows, no words, equal texts, a long one.
TEXTS = [
    (1, "Released under the MIT License. The quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (2, "released under the mit license. the QUICK brown fox jumps over the lazy dog again and again", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, "!!! ...", "de", "b"),
    (6, "one two", "en", None),
    (6, "one two", "en", None),
    (7, "été à la plage avec les enfants et le chien du voisin " * 40, "fr", "a"),
    (8, "z" * 70_000 + " <|endoftext|> 漢字 'til " + "ab1!" * 20_000 + "   \n\n x", "en", "c"),
    (None, "a text without an identifier", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture()
def docs(spark):
    """The rows above, with columns whose names clash with those that operators make."""
    extra = "sha binary, slot int, row string, score string, n int, copy_no string, chunk string, keep_id string"
    rows = [(*t, b"x", 1, "r", "s", 2, "c", "k", "i") for t in TEXTS]
    return spark.createDataFrame(rows, f"{SCHEMA}, {extra}")


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
