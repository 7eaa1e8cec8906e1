import pytest

SF = "/root/testdata/sf0.001"


LONG = " ".join(f"word{i % 977} and{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, white and very long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [
        (1, None, "en", None),
        (2, "", None, "b"),
        (3, " \n\t ", "en", "b"),
        (4, "one two", "en", "b"),
        (5, "one\n two", "en", "b"),
        (6, LONG, "en", "a"),
        (7, LONG, "en", "a"),
        (8, "α β γ Σ δ <|endoftext|> ok 123", "el", "a"),
        (8, "α β γ Σ δ <|endoftext|> ok 123", "el", "a"),
        (9, "12 34 !!", "en", "a"),
        (None, "no id at all", "en", "a"),
    ]
    rows = [(*r, i, "x", 0.5, 7) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, TEXT string, score double, row int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
