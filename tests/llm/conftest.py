import pytest
from llm_helpers import DOC, words


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and wordless texts, repeated rows and ids, a long text, and columns named like results."""
    long_text = words(9, 60_000)
    rows = [
        (1, words(1, 120), "en", "a", 1), (1, words(1, 120), "en", "a", 1), (1, words(2, 40), "en", None, None),
        (2, None, "en", "a", 0), (3, "", None, "b", 0), (4, " .,!? ", "de", "b", 6), (None, words(3, 30), None, None, None),
        (None, None, None, None, None), (5, long_text, "fr", "c", len(long_text)), (6, "élan Straße 東京 ñ", "fr", "c", 18), (7, "one two", "en", "c", 7),
    ]
    docs = spark.createDataFrame(rows, DOC)
    extra = ["score", "SIZE", "items", "n_hit", "slot", "class_id", "spans", "node", "target", "repeats", "predicted", "lang_pred", "held_out"]
    for name in extra:
        docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)
