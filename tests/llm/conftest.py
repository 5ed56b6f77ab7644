import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()), ("size", T.StringType()), ("_row", T.StringType()), ("n_tokens", T.StringType()), ("lang_pred", T.StringType()), ("kept", T.StringType()), ("node", T.StringType()), ("c0", T.StringType()), ("target", T.StringType()))])


def document(i, text, lang="en", source="a"):
    return (i, text, lang, source, len(text or ""), *["x"] * 8)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty, white and very long texts, ties, repeated rows, clashing names."""
    long = " ".join(f"word{i % 997} and{i}" for i in range(60_000))
    rows = [
        document(1, "The quick brown fox jumps over the lazy dog"), document(2, "The  quick\tbrown fox jumps over the lazy dog"), document(2, "The  quick\tbrown fox jumps over the lazy dog"),
        document(3, None, None, None), document(4, ""), document(5, " \t\n"), document(None, "a row without an id, and some words more"), document(None, None), document(6, long), document(7, long, "fr", "b"),
        document(8, "один два 三四 ✨ é\x0b\x0cü 1234 !!!", "de", "é"), document(9, "123 456", "es", "b"), tuple([None] * 13),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
