"""Fixtures of the tests of this folder."""
import pytest

SF0001 = "/root/testdata/sf0.001"
LONG = "Ein sehr langer Satz the of and " * 6000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, and columns named like the operators' own."""
    rows = [(1, None, "en"), (2, "", None), (3, "   \n\t ", "en"), (4, LONG, "de"), (5, "one two three", None), (None, "no id here", "en"),
            (6, "repeated row", "fr"), (6, "repeated row", "fr"), (7, "\U0001F600 émoji ß ſ K", "xx"), (8, "12 34 ! ?", "en"),
            (None, None, None)]
    schema = "doc_id long, text string, lang string"
    df = spark.createDataFrame(rows, schema)
    extra = ("id", "n", "t", "words", "blob", "spans", "n_tokens", "n_bytes", "kept", "k", "class_id", "bucket", "found", "kept_id", "row", "lead", "item_id", "n_chars")
    from pyspark.sql import functions as F
    return df.withColumns({name: F.lit("x") for name in extra})


@pytest.fixture
def empty_docs(edge_docs):
    return edge_docs.where("false")
