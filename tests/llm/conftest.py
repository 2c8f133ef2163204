import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and very long texts, repeated rows and columns whose names operators use."""
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again. " * 3, "en", "a", 5, 1.0, 7),
        (1, "the quick brown fox jumps over the lazy dog again and again. " * 3, "en", "a", 5, 1.0, 7),
        (2, None, None, None, None, None, None),
        (3, "", "en", "b", 0, None, 1),
        (4, " \t\n\r ", "de", "b", 5, 0.0, 1),
        (5, long, "en", "b", None, 0.0, 1),
        (6, "!!! ... 123 — \U0001f4a5", None, "b", 3, 0.0, 1),
        (None, "a text of a document without any id at all", "en", None, 3, 0.0, 1),
        (8, "AÉß 中文 é İstanbul", "de", "c", 3, 0.0, 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, row long")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
