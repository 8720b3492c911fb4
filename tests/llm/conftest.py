import pytest

from daybook.llm.ship import ship

#: Rows that every operator over documents must stand: nulls, empty and long texts, repeated rows, a clashing column.
ODD = [(1, None, None), (None, "The first line has no id, and is a sentence of some length.", "x"), (3, "", "y"), (4, "   \n\t ", "z"),
       (5, "word " * 30000 + "end.", "long"), (6, "unbroken" * 4000, "long"), (7, "Twice the same row.", "r"), (7, "Twice the same row.", "r"),
       (8, "日本語のテキスト 😀 \u0000 <|endoftext|> mixed", "u"), (9, "Other text, same id.", "a"), (9, "Same id, other text.", "b")]


@pytest.fixture(scope="session")
def odd(spark):
    """(doc_id, text, h): h clashes with names that operators use."""
    ship(spark)
    return spark.createDataFrame(ODD, "doc_id long, text string, h string").cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    ship(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
