import pytest

from weekcast.llm.common import table

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "word " * 30_000), (6, "same text of five words here"),
    (7, "same text of five words here"), (7, "same text of five words here"), (8, "Ünï çødé \U0001f600 … 日本語"),
    (None, "a row without an id"), (9, "<|endoftext|> </s>[INST] 's 't"), (10, "q" * 5000),
]


@pytest.fixture
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names clash with those of the operators."""
    rows = [(i, t, None, None, None, 1, 2, 3, 4, 5) for i, t in ODD]
    return spark.createDataFrame(rows, DOCUMENT + ", score long, row long, label long, key long, `order` long")


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def small(spark):
    return lambda name: table(spark, "/root/testdata/sf0.001", name)
