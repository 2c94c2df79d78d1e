import pytest

LONG = "wort und mehr text, number 12 " * 20_000
EXTRA = "print string, row string, block long, score double, _id long, _kept long, which int, value string, packed binary, key string"


def extra(i):
    return (str(i), "r", i, 0.5, i, i, i, "v", b"p", "k")


@pytest.fixture(scope="session")
def hard_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns with names that operators use."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs away.", "en", "src0", 57),
        (2, "The quick brown fox jumps over the lazy dog and runs away.", "en", "src1", 57),
        (2, "The quick brown fox jumps over the lazy dog and runs away.", "en", "src1", 57),
        (3, None, "en", "src0", None),
        (4, "", "de", None, 0),
        (5, " \n\t ", None, "src2", 4),
        (6, LONG, "de", "src0", len(LONG)),
        (7, LONG + "x", "de", "src0", len(LONG) + 1),
        (None, "No id, but mail a.b@example.com or +1 (555) 010-9999.", "en", "src0", 50),
        (None, None, None, None, None),
        (8, "12345 67890 !!! ***", "fr", "src3", 19),
        (9, "日本語の文 🙂 é ﬁ \u0000 <|endoftext|> <s> ▁ x", None, "srcé", 30),
        (-10, "w" * 5000, "en", "src0", 5000),
    ]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    return spark.createDataFrame([(*r, *extra(i)) for i, r in enumerate(rows)], schema).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(hard_docs):
    return hard_docs.limit(0)


@pytest.fixture(scope="session")
def some_docs(spark):
    """The smallest of the given tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
