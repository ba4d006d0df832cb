import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, kept boolean"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text, source) rows, with extra columns whose names operators use."""

    def make(rows, parts=2):
        full = [(i, t, "en", s, len(t or ""), 0.5, "k", None) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every place, empty and very long texts, ties, repeated rows."""
    long_text = " ".join(f"word{i % 997} line{i % 13}" for i in range(30_000))
    plain = "one two three four five six seven eight nine ten eleven twelve"
    return [
        (1, plain, "a"), (1, plain, "a"), (2, plain, "b"), (3, None, "a"), (4, "", "a"), (5, " \t\n", None), (6, "solo", "c"),
        (None, plain, "a"), (None, "text without an id", "b"), (7, long_text, "c"), (8, long_text + " more", "c"), (9, "Ünïcödé ß 😀 é", "d"),
        (10, "x" * 50_000, "d"), (11, "a\x1cb \x85 　 c", "e"),
    ]
